"""Many months in one plan, holdings carried on, salted joins and runtime filters past the bounds."""

import datetime as dt
import os
import statistics
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import backfill as BF
from cohortkit.operators import cohort as C
from cohortkit.operators.common import materialize, salted_join
from cohortkit.params import RunParams
from cohortkit.plans.leads import build_stages
from cohortkit.sources.fixtures import FIXTURE_PARAMS, build_fixture_tables
from tests.test_bucketed import nodes
from tests.test_hot_owner import _roles as hot_roles
from tests.units import make_roles

SF = "/root/testdata/sf0.01"
P = RunParams(month_end=dt.date(2023, 2, 28), run_date=dt.date(2023, 4, 1), tenure_years=1)


def month(y, m, **k):
    from cohortkit.params import last_day
    return P.with_(month_end=last_day(dt.date(y, m, 1)), **k)


def roles(spark, status="1", mode=12, prem=("10.00",), owner="C1"):
    """Two policies of one owner; the second one varies."""
    pol = [dict(pol_num="A", pmt_mode=12, pol_iss_dt=dt.date(2022, 1, 5), pol_stat_cd="1", wa_cd_1="W", agt_code="S"),
           dict(pol_num="B", pmt_mode=mode, pol_iss_dt=dt.date(2023, 1, 20), pol_stat_cd=status, wa_cd_1="W", agt_code="S")]
    cvg = [dict(pol_num="A", cvg_prem=Decimal("5.00"), cvg_iss_dt=dt.date(2022, 2, 10), vers_num="1")]
    cvg += [dict(pol_num="B", cvg_prem=Decimal(x) if x else None, cvg_iss_dt=dt.date(2023, 1, 20), vers_num=str(i)) for i, x in enumerate(prem)]
    links = [dict(pol_num="A", cli_num="C1", link_typ="O"), dict(pol_num="B", cli_num=owner, link_typ="O")]
    return make_roles(spark, policy=pol, coverage=cvg, links=links, agents=[dict(agt_code=a, comp_prvd_num="01") for a in "WS"])


def totals(state):
    return {r.po_num: (r.total_ape, r.pol_cnt, r["10yr_pol_cnt"]) for r in state.totals.collect()}


@pytest.mark.parametrize("change", [dict(), dict(status="9"), dict(mode=6), dict(prem=("10.00", "7.00")), dict(prem=(None,)), dict(prem=()),
                                    dict(owner="C2"), dict(mode=0)])
def test_carried_holdings_equal_the_full_sum(spark, change):
    """From each variant to each other: lapsed, another pay mode, more or no premiums, another owner; and time alone."""
    for was, now in ((roles(spark), roles(spark, **change)), (roles(spark, **change), roles(spark))):
        first = BF.first_holdings(was, month(2023, 1))
        state, changed = BF.next_holdings(now, month(2023, 3), first)
        assert totals(state) == totals(BF.first_holdings(now, month(2023, 3)))
        again, still = BF.next_holdings(now, month(2023, 3), state)
        assert still.count() == 0 and totals(again) == totals(state)


def test_time_alone_changes_the_long_held(spark):
    t = roles(spark)
    first = BF.first_holdings(t, month(2023, 1))
    state, changed = BF.next_holdings(t, month(2023, 2), first)
    assert [r.pol_num for r in changed.collect()] == ["A"]  # A has its year in February
    assert totals(first)["C1"][2] == 0 and totals(state)["C1"][2] == 1
    late, changed = BF.next_holdings(t, month(2022, 12), state)  # B is not issued yet
    assert totals(late) == {"C1": (Decimal("5.000000"), 1, 0)} and changed.count() == 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_months_equal_single_runs(spark):
    t = build_fixture_tables(spark, SF, FIXTURE_PARAMS)
    months = [FIXTURE_PARAMS.with_(month_end=d) for d in (dt.date(1998, 9, 30), dt.date(1998, 12, 31))]  # not neighbours
    got = BF.cohort_months(t, months)
    single = C.active_cohort(t, months[0]).unionByName(C.active_cohort(t, months[1]))
    assert got.count() == single.count() > 0 and got.exceptAll(single).count() == 0
    every = BF.holdings_months(t, months)
    for p in months:
        want = C.holdings_summary(C.holdings(t, p, None), p)
        mine = every.where(F.col("onb_mth_yr") == p.month_key).select(*want.columns)
        assert want.count() == mine.count() and want.exceptAll(mine).count() == 0
    assert BF.holdings_months(t, months, got.select("po_num", "onb_mth_yr").where("false")).count() == 0


# ---- salted joins ------------------------------------------------------------

@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, how):
    big = spark.createDataFrame([("hot", i) for i in range(300)] + [(f"k{i % 40}", i) for i in range(200)] + [(None, 1), (None, 2)], "k string, n int")
    small = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k1", "c"), ("none", "d"), (None, "e")], "k string, v string")
    want = big.join(small, "k", how)
    got = salted_join(big, small, "k", how, rows=20).select(*want.columns)
    assert want.count() == got.count() and want.exceptAll(got).count() == got.exceptAll(want).count() == 0
    with pytest.raises(ValueError):
        salted_join(big, small, "k", "right")


def _partition_rows(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_no_task_of_a_salted_join_holds_the_hot_owner(spark):
    """A third of the rows are one owner's: on the shuffle path the largest task reads at most three times the median."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    n = 60_000
    big = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000).cast("bigint").alias("po_num"), F.col("id").alias("pol_num"))
    small = spark.range(-1, 5000).select(F.col("id").alias("po_num"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plain = _partition_rows(big.join(small, "po_num", "left_semi"))
        salted = _partition_rows(salted_join(big, small, "po_num", "left_semi", rows=500))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(plain) == sum(salted) == n
    assert plain[-1] > 5 * statistics.median(plain)
    assert salted[-1] <= 3 * statistics.median(salted)


def test_hot_owner_past_every_bound(spark):
    t = hot_roles(spark)
    p = RunParams(month_end=dt.date(2023, 2, 28), scorecard_month_end="2023-03-31", lifestage_month="2023-03", run_date=dt.date(2023, 4, 1))
    want = build_stages(t, p).leads
    past = p.with_(extra={"month_policy_max_rows": 0, "holding_policy_max_rows": 0, "owner_link_max_rows": 0, "owner_max_rows": 0, "salt_rows": 25})
    got = build_stages(t, past).leads
    assert want.count() == got.count() == 601 and want.exceptAll(got).count() == 0


# ---- runtime filters ---------------------------------------------------------

@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_runtime_filters_reach_the_large_scans(spark, tmp_path):
    """Past the bound, the month's policies filter coverage and links by a Bloom filter before their shuffle."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    past = FIXTURE_PARAMS.with_(extra={"month_policy_max_rows": 0, "owner_link_max_rows": 0})
    t = build_fixture_tables(spark, SF, past)
    t.links.write.parquet(str(tmp_path / "links"))  # links as files of their own, as a deployment has them
    t = replace(t, links=spark.read.parquet(str(tmp_path / "links")))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        base, _ = C.cohort_base(t, past, reuse=None, insured_only=False)
        filtered = {}
        for n in nodes(base._jdf.queryExecution().executedPlan()):
            if n.nodeName() == "Filter" and "might_contain" in n.simpleString(10_000):
                scans = [m.simpleString(10_000) for m in nodes(n) if m.nodeName().startswith("Scan")]
                for s in scans:
                    filtered["coverage" if "l_orderkey" in s else "links" if "link_typ" in s else s] = True
        assert {"coverage", "links"} <= set(filtered)
        plain = materialize(C.with_insured(*C.cohort_base(t, FIXTURE_PARAMS, insured_only=False)), "table")
        assert C.with_insured(*C.cohort_base(t, past, reuse=None, insured_only=False)).exceptAll(plain).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
