"""Decisions on doubtful behaviours: clamped vs snapped window end (Q6), zero pay mode (Q7)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cohortkit.operators import flags as FL
from cohortkit.operators.common import annualized
from cohortkit.params import RunParams
from tests.units import make_roles

P = RunParams(month_end=dt.date(2023, 2, 28), run_date=dt.date(2023, 4, 1))


def _roles(spark):
    pols = [dict(pol_num="P1", pmt_mode=12, pol_iss_dt=dt.date(2023, 2, 10), pol_stat_cd="1", wa_cd_1="W",
                 agt_code="A"),
            dict(pol_num="P2", pmt_mode=12, pol_iss_dt=dt.date(2023, 4, 29), pol_stat_cd="1", wa_cd_1="W",
                 agt_code="A")]
    links = [dict(pol_num="P1", cli_num="C1", link_typ="O"), dict(pol_num="P2", cli_num="C1", link_typ="O")]
    agents = [dict(agt_code="W", comp_prvd_num="01"), dict(agt_code="A", comp_prvd_num="01")]
    return make_roles(spark, policy=pols, links=links, agents=agents)


def test_repurchase_window_end_is_clamped_by_default(spark):
    t = _roles(spark)
    clamped = {r.po_num: r.last_pol_iss for r in FL.last_issue_dates(t, P).collect()}
    assert clamped["C1"] == dt.date(2023, 2, 10)            # 29 Apr is after 28 Apr
    snapped = {r.po_num: r.last_pol_iss for r in FL.last_issue_dates(t, P.with_(snap_month_end=True)).collect()}
    assert snapped["C1"] == dt.date(2023, 4, 29)            # window ends 30 Apr when snapped


def test_zero_pay_mode_gives_null_not_an_error(spark):
    df = spark.createDataFrame([(Decimal("100.00"), 12), (Decimal("100.00"), 0), (Decimal("100.00"), None),
                                (Decimal("100.00"), 5)], "prem decimal(18,2), mode int")
    got = [r.ape for r in df.select(annualized("prem", "mode").alias("ape")).collect()]
    assert got == [Decimal("100.000000"), None, None, Decimal("240.000000")]


def test_month_window_is_half_open(spark):
    from cohortkit.functions.dates import in_month
    days = [dt.date(2023, 1, 31), dt.date(2023, 2, 1), dt.date(2023, 2, 28), dt.date(2023, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.d for r in df.where(in_month("d", P.month_start, P.next_month_start)).collect()]
    assert got == [dt.date(2023, 2, 1), dt.date(2023, 2, 28)]
    same = [r.d for r in df.where((F.year("d") == 2023) & (F.month("d") == 2)).collect()]
    assert got == same
