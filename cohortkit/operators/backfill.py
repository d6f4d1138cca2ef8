"""Many months in one plan, and holdings carried from one month to the next.

:func:`cohort_months` and :func:`holdings_months` make the month a key of the rows, so that a backfill of a year
scans coverage, policies and links once instead of twelve times.  :func:`next_holdings` takes last month's state
and touches only what differs: policies are compared by digests, changed ones are retracted and added again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.dates import month_key_of, tenure_years
from cohortkit.operators.cohort import (
    COHORT_COLUMNS,
    agent_roles,
    cohort_base,
    policy_history,
    with_agents,
    with_insured,
)
from cohortkit.operators.common import TOTAL_TYPE, annualized, dense_rank_within, links_of
from cohortkit.params import RunParams
from cohortkit.sources.tables import RoleTables

SUMMARY = ["total_ape", "pol_cnt", "10yr_pol_cnt"]


def _in_months(months: Sequence[RunParams], date: str) -> Column:
    """The date lies in one of the months; the whole range first, which is pushed to the scan."""
    first, end = min(m.month_start for m in months), max(m.next_month_start for m in months)
    return (F.col(date) >= F.lit(first)) & (F.col(date) < F.lit(end)) & month_key_of(date).isin(*[m.month_key for m in months])


def cohort_months(t: RoleTables, months: Sequence[RunParams], rank: str | None = "split", reuse: str | None = "table") -> DataFrame:
    """The active cohort of several months: equal to the union of their single runs, from one scan of each table.

    The months share all parameters but the month itself; ``onb_mth_yr`` is the
    month of the policy's issue, and the rank counts within owner and month.
    """
    base, insureds = cohort_base(t, months[0], reuse, insured_only=False, issued=_in_months(months, "pol_iss_dt"))
    df = with_insured(base.withColumn("onb_mth_yr", month_key_of("pol_iss_dt")), insureds)
    if rank is None:
        return df
    df = dense_rank_within(df, ["po_num", "onb_mth_yr"], ["pol_iss_dt", "pol_num"], "purchase_order_base", method=rank)
    return df.select(*COHORT_COLUMNS)


def _months_frame(df: DataFrame, months: Sequence[RunParams], date: Column) -> Column:
    """The first of the months whose end is not before ``date`` (NULL: none)."""
    out = F.lit(None).cast("string")
    for m in sorted(months, key=lambda m: m.month_end, reverse=True):
        out = F.when(date <= F.lit(m.month_end), F.lit(m.month_key)).otherwise(out)
    return out


def holdings_months(t: RoleTables, months: Sequence[RunParams], owner_months: DataFrame | None = None) -> DataFrame:
    """(po_num, onb_mth_yr, total_ape, pol_cnt, 10yr_pol_cnt): holdings of each owner up to each month end.

    A policy counts from the first month end after its issue, and as long held
    from the first one at which a coverage has the tenure; both are events, and
    the totals are running sums over an owner's months (a few rows for each
    owner, whatever the policies).  ``owner_months`` (po_num, onb_mth_yr) are
    the rows wanted; None: all months of every owner, from the first with a policy.
    """
    months = sorted(months, key=lambda m: m.month_end)
    last = months[-1]
    rows, _ = policy_history(t, last)
    pol = rows.where((F.col("pol_iss_dt") <= F.lit(last.month_end)) & F.col("pol_stat_cd").isin(*last.inforce_status) & with_agents())
    cvg = t.coverage.join(pol.select("pol_num", "po_num", "pmt_mode", "pol_iss_dt"), "pol_num", "inner")
    reached = F.lit(None).cast("string")
    for m in reversed(months):  # the first month end at which the coverage has the tenure
        reached = F.when(tenure_years(m.month_end, "cvg_iss_dt") >= m.tenure_years, F.lit(m.month_key)).otherwise(reached)
    held = cvg.groupBy("po_num", "pol_num").agg(
        F.sum(annualized("cvg_prem", "pmt_mode")).alias("ape"), F.min("pol_iss_dt").alias("issued"), F.min(reached).alias("tenured"))
    held = held.withColumn("from_month", _months_frame(held, months, F.col("issued")))
    none = F.lit(0).cast("bigint")
    entered = held.groupBy("po_num", F.col("from_month").alias("onb_mth_yr")).agg(
        F.sum("ape").cast(TOTAL_TYPE).alias("ape"), F.count(F.lit(1)).alias("n"), none.alias("long"))
    long_held = held.where("tenured is not null").groupBy("po_num", F.greatest("tenured", "from_month").alias("onb_mth_yr")).agg(
        F.lit(None).cast(TOTAL_TYPE).alias("ape"), none.alias("n"), F.count(F.lit(1)).alias("long"))
    events = entered.unionByName(long_held)
    if owner_months is not None:
        wanted = owner_months.select("po_num", "onb_mth_yr").distinct()
    else:
        keys = F.explode(F.array(*[F.lit(m.month_key) for m in months]))
        wanted = events.groupBy("po_num").agg(F.min("onb_mth_yr").alias("since")).select("po_num", "since", keys.alias("onb_mth_yr")).where(
            "onb_mth_yr >= since").drop("since")
    marks = wanted.select("po_num", "onb_mth_yr", F.lit(None).cast(TOTAL_TYPE).alias("ape"), none.alias("n"), none.alias("long"), F.lit(1).alias("asked"))
    per_month = events.withColumn("asked", F.lit(0)).unionByName(marks).groupBy("po_num", "onb_mth_yr").agg(
        F.sum("ape").alias("ape"), F.sum("n").alias("n"), F.sum("long").alias("long"), F.max("asked").alias("asked"))
    so_far = Window.partitionBy("po_num").orderBy("onb_mth_yr").rowsBetween(Window.unboundedPreceding, 0)
    return (per_month.select("po_num", "onb_mth_yr", F.sum("ape").over(so_far).cast(TOTAL_TYPE).alias("total_ape"),
                             F.sum("n").over(so_far).cast("bigint").alias("pol_cnt"),
                             F.sum("long").over(so_far).cast("bigint").alias("10yr_pol_cnt"), "asked")
            .where("asked = 1 and pol_cnt > 0").drop("asked"))


@dataclass
class HoldingsState:
    """What one month leaves to the next."""

    digests: DataFrame   # (pol_num, digest) of every policy that counts
    policies: DataFrame  # (po_num, pol_num, ape, long): what each policy adds to its owners
    totals: DataFrame    # (po_num, total_ape, pol_cnt, 10yr_pol_cnt, paid: policies with a premium)


def policy_digests(t: RoleTables, p: RunParams) -> DataFrame:
    """(pol_num, digest): of each policy that counts at the month end, a digest of all that its holdings follow from.

    Sums of hashes over its rows, so no order or gathering is involved: pay
    mode, owners, and each coverage's premium and whether it has the tenure
    (which time alone can change).
    """
    wa, sa = agent_roles(t, p)
    live = (t.policy.where((F.col("pol_iss_dt") <= F.lit(p.month_end)) & F.col("pol_stat_cd").isin(*p.inforce_status))
            .join(wa.select("wa_agt_code"), F.col("wa_cd_1") == F.col("wa_agt_code"), "inner")
            .join(sa.select("sa_agt_code"), F.col("agt_code") == F.col("sa_agt_code"), "inner"))
    total = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(38,0)"))
    pol = live.groupBy("pol_num").agg(total("pmt_mode").alias("a"))
    tenured = F.coalesce(tenure_years(p.month_end, "cvg_iss_dt") >= p.tenure_years, F.lit(False))
    cvg = t.coverage.groupBy("pol_num").agg(total("cvg_prem", tenured).alias("b"))
    own = links_of(t.links, "O", "po_num").groupBy("pol_num").agg(total("po_num").alias("c"))
    return pol.join(cvg, "pol_num", "inner").join(own, "pol_num", "inner").select("pol_num", F.xxhash64("a", "b", "c").alias("digest"))


def policy_holdings(t: RoleTables, p: RunParams, policies: DataFrame | None = None) -> DataFrame:
    """(po_num, pol_num, ape, long): what each policy (of ``policies``) adds to its owners at the month end."""
    if policies is not None:
        t = _cut(t, policies)
    rows, _ = policy_history(t, p)
    pol = rows.where((F.col("pol_iss_dt") <= F.lit(p.month_end)) & F.col("pol_stat_cd").isin(*p.inforce_status) & with_agents())
    cvg = t.coverage.join(pol.select("pol_num", "po_num", "pmt_mode"), "pol_num", "inner")
    tenured = tenure_years(p.month_end, "cvg_iss_dt") >= p.tenure_years
    return cvg.groupBy("po_num", "pol_num").agg(F.sum(annualized("cvg_prem", "pmt_mode")).cast(TOTAL_TYPE).alias("ape"),
                                                F.coalesce(F.max(tenured.cast("bigint")), F.lit(0).cast("bigint")).alias("long"))


def _cut(t: RoleTables, policies: DataFrame) -> RoleTables:
    """The policy-keyed roles cut to some policies."""
    from dataclasses import replace
    keys = policies.select("pol_num")
    return replace(t, **{r: getattr(t, r).join(keys, "pol_num", "left_semi") for r in ("coverage", "policy", "links")})


def _summed(policies: DataFrame) -> DataFrame:
    return policies.groupBy("po_num").agg(F.sum("ape").cast(TOTAL_TYPE).alias("total_ape"), F.count(F.lit(1)).alias("pol_cnt"),
                                          F.sum("long").alias("10yr_pol_cnt"), F.count("ape").alias("paid"))


def first_holdings(t: RoleTables, p: RunParams) -> HoldingsState:
    """The state of a first month, computed in full."""
    policies = policy_holdings(t, p)
    return HoldingsState(policy_digests(t, p), policies, _summed(policies))


def changed_policies(old: DataFrame, new: DataFrame) -> DataFrame:
    """(pol_num) of policies that came, went, or differ between two months' digests."""
    a, b = old.select("pol_num", F.col("digest").alias("was")), new.select("pol_num", F.col("digest").alias("is"))
    return a.join(b, "pol_num", "full").where(~F.col("was").eqNullSafe(F.col("is"))).select("pol_num")


def next_holdings(t: RoleTables, p: RunParams, last: HoldingsState) -> tuple[HoldingsState, DataFrame]:
    """The state of the next month, and the policies that changed.

    Changed policies' old contributions are retracted and their new ones added
    as signed rows; owners without any are carried over as they are, and owners
    whose last policy went leave.  Stage the state (and the changed policies)
    before it is read several times.
    """
    digests = policy_digests(t, p)
    changed = changed_policies(last.digests, digests)
    gone = last.policies.join(changed, "pol_num", "left_semi")
    came = policy_holdings(t, p, changed)
    signed = gone.select("po_num", (-F.col("ape")).alias("ape"), F.lit(-1).alias("n"), (-F.col("long")).alias("long")).unionByName(
        came.select("po_num", "ape", F.lit(1).alias("n"), "long"))
    delta = signed.groupBy("po_num").agg(F.sum("ape").cast(TOTAL_TYPE).alias("d_ape"), F.sum("n").alias("d_n"), F.sum("long").alias("d_long"),
                                         F.sum(F.when(F.col("ape").isNotNull(), F.col("n"))).alias("d_paid"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    joined = last.totals.join(delta, "po_num", "full")
    totals = joined.select(
        "po_num", F.when(zero("paid") + zero("d_paid") > 0, zero("total_ape") + zero("d_ape")).cast(TOTAL_TYPE).alias("total_ape"), (zero("pol_cnt") + zero("d_n")).cast("bigint").alias("pol_cnt"),
        (zero("10yr_pol_cnt") + zero("d_long")).cast("bigint").alias("10yr_pol_cnt"),
        (zero("paid") + zero("d_paid")).cast("bigint").alias("paid")).where("pol_cnt > 0")
    policies = last.policies.join(changed, "pol_num", "left_anti").unionByName(came)
    return HoldingsState(digests, policies, totals), changed
