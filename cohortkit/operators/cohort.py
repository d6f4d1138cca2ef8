"""Cohort operators: in-force coverages of the month, first contract, holdings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.dates import in_month, tenure_years
from cohortkit.functions.tiers import agent_relationship
from cohortkit.operators.common import (
    TOTAL_TYPE,
    agents_in,
    annualized,
    bounded_broadcast,
    dense_rank_within,
    SALT_ROWS,
    links_of,
    salted_join,
    stage_table,
    staged_broadcast,
)
from cohortkit.params import RunParams
from cohortkit.sources.tables import RoleTables

# Upper bounds (rows) for the broadcast paths: one month's new policies, and
# all in-force policies of the month's owners.
MONTH_POLICY_MAX_ROWS = 5_000_000
HOLDING_POLICY_MAX_ROWS = 5_000_000
OWNER_LINK_MAX_ROWS = 10_000_000

COHORT_COLUMNS = [
    "pol_num", "po_num", "ins_num", "plan_code", "vers_num", "cvg_stat_cd", "cvg_typ", "cvg_reasn",
    "cvg_prem", "pmt_mode", "inforce_ape", "cvg_iss_dt", "pol_iss_dt", "purchase_order_base",
    "wagt_cd", "wagt_comp_prvd_num", "sagt_cd", "sagt_comp_prvd_num", "cus_agt_rltnshp", "onb_mth_yr",
]


def agent_roles(t: RoleTables, p: RunParams):
    """Writing- and servicing-agent lookups, size-checked once per role-table set."""
    memo = t.__dict__.setdefault("_memo", {})
    key = ("agent_roles", p.writing_channels, p.servicing_channels)
    if key not in memo:
        wa = bounded_broadcast(agents_in(t.agents, p.writing_channels, "wa_"))
        sa = bounded_broadcast(agents_in(t.agents, p.servicing_channels, "sa_", extra=("trmn_dt",)))
        memo[key] = (wa, sa)
    return memo[key]


def month_policies(t: RoleTables, p: RunParams, issued: Column | None = None) -> DataFrame:
    """In-force policies issued in the target month (or as ``issued`` says), with qualifying agents.

    Policy-grain work (filters, agent lookups, relationship class) happens
    before the coverage join, on the far smaller policy side.
    """
    wa, sa = agent_roles(t, p)
    issued = issued if issued is not None else in_month("pol_iss_dt", p.month_start, p.next_month_start)
    pol = t.policy.where(issued & F.col("pol_stat_cd").isin(*p.inforce_status))
    pol = (pol.join(wa, pol.wa_cd_1 == wa.wa_agt_code, "inner")
              .join(sa, pol.agt_code == sa.sa_agt_code, "inner"))
    return pol.select(
        "pol_num", "pmt_mode", "pol_iss_dt",
        F.col("wa_cd_1").alias("wagt_cd"), F.col("wa_comp_prvd_num").alias("wagt_comp_prvd_num"),
        F.col("agt_code").alias("sagt_cd"), F.col("sa_comp_prvd_num").alias("sagt_comp_prvd_num"),
        agent_relationship("sa_comp_prvd_num", "sa_trmn_dt", "agt_code", "wa_cd_1", "wa_cd_2")
        .alias("cus_agt_rltnshp"),
    )


def cohort_base(t: RoleTables, p: RunParams, reuse: str | None = "table",
                insured_only: bool = True, issued: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Step 1 before the insured link, and the month's insured links.

    Grain: coverage × owner link.  ``insured_only`` keeps the policies that
    have an insured (a semi-join); a caller that joins the insureds at once
    can leave it out.  A group policy with many insureds costs one row per
    coverage here: :func:`with_insured` multiplies only the rows it is given.
    """
    # One month of new business: size-checked, then broadcast to every join that
    # needs it.  Coverage and the links (both roles in one scan) are cut to the
    # month's policies map-side, so neither large table is shuffled.  Past the
    # bounds the joins fall back to shuffles (AQE, runtime bloom filters).
    pol = staged_broadcast(month_policies(t, p, issued), p.extra.get("month_policy_max_rows", MONTH_POLICY_MAX_ROWS),
                           reuse, "month_policies")
    links = t.links.where(F.col("link_typ").isin("O", "I")).join(pol.select("pol_num"), "pol_num", "left_semi")
    links = links.select("pol_num", "cli_num", "link_typ")
    if reuse is not None:
        links = staged_broadcast(links, p.extra.get("owner_link_max_rows", OWNER_LINK_MAX_ROWS), reuse, "month_links")
    insureds = links_of(links, "I", "ins_num")
    cvg = t.coverage.join(pol, "pol_num", "inner").join(links_of(links, "O", "po_num"), "pol_num", "inner")
    if insured_only:
        cvg = cvg.join(insureds.select("pol_num"), "pol_num", "left_semi")
    base = cvg.select(
        "pol_num", "po_num", "plan_code", "vers_num", "cvg_stat_cd", "cvg_typ", "cvg_reasn",
        F.col("cvg_prem").cast("int").alias("cvg_prem"),
        "pmt_mode",
        annualized("cvg_prem", "pmt_mode").alias("inforce_ape"),
        "cvg_iss_dt", "pol_iss_dt",
        "wagt_cd", "wagt_comp_prvd_num", "sagt_cd", "sagt_comp_prvd_num", "cus_agt_rltnshp",
        F.lit(p.month_key).alias("onb_mth_yr"),
    )
    return base, insureds


def with_insured(base: DataFrame, insureds: DataFrame) -> DataFrame:
    """One row per insured link of each row of ``base``."""
    return base.join(insureds, "pol_num", "inner").select(*[c for c in COHORT_COLUMNS if c != "purchase_order_base"])


def active_cohort(t: RoleTables, p: RunParams, rank: str | None = "split", reuse: str | None = "table") -> DataFrame:
    """Step 1: in-force coverages of policies issued in the target month.

    Grain: coverage × owner link × insured link (a policy with two insureds
    yields two rows per coverage).  ``purchase_order_base`` is the dense rank
    of the policy among the owner's policies of the month by (issue date,
    policy number).  ``rank=None`` omits it (first-contract selection does not
    need the full rank, see :func:`first_contract`).
    """
    df = with_insured(*cohort_base(t, p, reuse, insured_only=False))
    if rank is None:
        return df
    df = dense_rank_within(df, ["po_num"], ["pol_iss_dt", "pol_num"], "purchase_order_base", method=rank)
    return df.select(*COHORT_COLUMNS)


def first_contract(cohort: DataFrame, base_only: bool = True) -> DataFrame:
    """Rows of each owner's first policy of the month (rank 1), base coverages only.

    Rank 1 is "equal to the owner's minimum (issue date, policy)", found with a
    grouped ``min`` — partial aggregation keeps a hot owner cheap — and a join
    on (owner, policy).  Ties stay: every coverage and insured row of that
    policy is kept.
    """
    firsts = (cohort.groupBy("po_num")
              .agg(F.min(F.struct("pol_iss_dt", "pol_num")).alias("_m"))
              .select("po_num", F.col("_m.pol_num").alias("pol_num")))
    out = cohort.join(firsts, ["po_num", "pol_num"], "left_semi")
    if base_only:
        out = out.where((F.col("cvg_typ") == "B") & (F.col("cvg_reasn") == "O"))
    return out


def cohort_owners(cohort: DataFrame) -> DataFrame:
    return cohort.select("po_num").distinct()


def owner_policy_links(t: RoleTables, p: RunParams, owners: DataFrame, reuse: str | None = None,
                       salted: bool = False) -> DataFrame:
    """(policy, owner) links of every policy of the cohort owners, any status.

    Written once and size-checked: when bounded it is broadcast, and the scan
    of the full policy history (:func:`policy_history`) becomes a map-side
    join instead of a shuffle of the policy table.
    """
    links = links_of(t.links, "O", "po_num")
    if salted:  # the owners are past their bound: a shuffle, in which no owner is one task
        own = salted_join(links, owners.select("po_num"), "po_num", "left_semi", p.extra.get("salt_rows", SALT_ROWS))
    else:
        own = links.join(owners.select("po_num"), "po_num", "left_semi")
    return staged_broadcast(own, p.extra.get("owner_link_max_rows", OWNER_LINK_MAX_ROWS), reuse, "owner_links")


def policy_history(t: RoleTables, p: RunParams, own_links: DataFrame | None = None,
                   reuse: str | None = None) -> tuple[DataFrame, int | None]:
    """(policy, owner) rows of all issued or in-force policies, and their number if they were staged.

    The one scan of the policy history: holdings, first join dates and
    repurchases are filters and conditional aggregates over this table.  The
    channel of the writing and of the servicing agent is set where that agent
    qualifies, else NULL (left lookups), so a row of two qualifying agents is
    a row of the inner joins.  ``own_links`` cuts it to some owners (map-side
    when they are broadcast); None takes every owner.
    """
    wa, sa = agent_roles(t, p)
    own = own_links if own_links is not None else links_of(t.links, "O", "po_num")
    pol = t.policy.where(F.col("pol_stat_cd").isin(*sorted({*p.inforce_status, *p.issued_status})))
    rows = (pol.join(own, "pol_num", "inner")
               .join(wa, pol.wa_cd_1 == wa.wa_agt_code, "left")
               .join(sa, pol.agt_code == sa.sa_agt_code, "left")
               .select("pol_num", "po_num", "pmt_mode", "pol_iss_dt", "frst_iss_dt", "pol_eff_dt", "pol_stat_cd",
                       F.col("wa_cd_1").alias("wagt_cd"), F.col("wa_comp_prvd_num").alias("wagt_comp_prvd_num"),
                       F.col("agt_code").alias("sagt_cd"), F.col("sa_comp_prvd_num").alias("sagt_comp_prvd_num")))
    return (rows, None) if reuse is None else stage_table(rows, "policy_history")


def with_agents() -> Column:
    """Rows of :func:`policy_history` whose writing and servicing agents both qualify."""
    return F.col("wagt_comp_prvd_num").isNotNull() & F.col("sagt_comp_prvd_num").isNotNull()


def owner_facts(history: DataFrame, p: RunParams) -> DataFrame:
    """Per owner of :func:`policy_history`: first join date and latest repurchase date, in one grouped pass.

    ``frst_join_dt`` is ``COALESCE(MIN(first issue), MIN(issue), MIN(effective))`` over issued policies;
    ``last_pol_iss`` the latest issue date in [month start, month end + N months] over issued policies whose
    agents both qualify.  Owners without an issued policy have no row.
    """
    window = F.col("pol_iss_dt").between(F.lit(p.month_start), F.lit(p.repurchase_end)) & with_agents()
    return (history.where(F.col("pol_stat_cd").isin(*p.issued_status)).groupBy("po_num").agg(
        F.coalesce(F.min("frst_iss_dt"), F.min("pol_iss_dt"), F.min("pol_eff_dt")).alias("frst_join_dt"),
        F.max(F.when(window, F.col("pol_iss_dt"))).alias("last_pol_iss")))


HOLDINGS_COLUMNS = [
    "pol_num", "po_num", "plan_code", "vers_num", "cvg_stat_cd", "cvg_typ", "cvg_reasn", "cvg_prem",
    "pmt_mode", "inforce_ape", "cvg_iss_dt", "pol_iss_dt", "inforce_year", "purchase_order_base",
    "wagt_cd", "wagt_comp_prvd_num", "sagt_cd", "sagt_comp_prvd_num", "onb_mth_yr",
]


def holdings(t: RoleTables, p: RunParams, owners: DataFrame | None, rank: str | None = None,
             reuse: str | None = "table", history: tuple[DataFrame, int | None] | None = None) -> DataFrame:
    """Step 2: all in-force coverages, up to month end, of the cohort owners.

    The owner restriction (a semi-join) is applied on the policy side first,
    before the coverage join, so the largest table is joined only with the
    cohort's policies.  No insured join here (no fan-out).  ``owners=None``
    keeps every owner; ``history`` is a prepared :func:`policy_history` of the
    owners.
    """
    if history is None:
        own = None if owners is None else owner_policy_links(t, p, owners, reuse)
        history = policy_history(t, p, own, None if owners is None else reuse)
    rows, n = history
    pol = rows.where((F.col("pol_iss_dt") <= F.lit(p.month_end)) & F.col("pol_stat_cd").isin(*p.inforce_status)
                     & with_agents()).select("pol_num", "po_num", "pmt_mode", "pol_iss_dt", "wagt_cd",
                                             "wagt_comp_prvd_num", "sagt_cd", "sagt_comp_prvd_num")
    if owners is not None and n is not None:
        # The cohort owners' policies: a filter of the staged history, whose rows
        # bound them; broadcast to the coverage join when bounded (a hot owner can
        # push it past the bound; then the join shuffles, keyed by policy, which a
        # hot owner does not skew).
        pol = bounded_broadcast(pol, p.extra.get("holding_policy_max_rows", HOLDING_POLICY_MAX_ROWS), n)
    df = t.coverage.join(pol, "pol_num", "inner").select(
        "pol_num", "po_num", "plan_code", "vers_num", "cvg_stat_cd", "cvg_typ", "cvg_reasn", "cvg_prem",
        "pmt_mode", annualized("cvg_prem", "pmt_mode").alias("inforce_ape"), "cvg_iss_dt", "pol_iss_dt",
        tenure_years(p.month_end, "cvg_iss_dt").alias("inforce_year"),
        "wagt_cd", "wagt_comp_prvd_num", "sagt_cd", "sagt_comp_prvd_num",
        F.lit(p.month_key).alias("onb_mth_yr"),
    )
    if rank is None:
        return df.withColumn("purchase_order_base", F.lit(None).cast("int")).select(*HOLDINGS_COLUMNS)
    df = dense_rank_within(df, ["po_num"], ["pol_iss_dt"], "purchase_order_base", method=rank)
    return df.select(*HOLDINGS_COLUMNS)


def holdings_summary(hold: DataFrame, p: RunParams) -> DataFrame:
    """Per owner: total annualised premium, policy count, long-tenure policy count.

    Two-phase: first one row per (owner, policy) — the coverage sum and
    whether any coverage reached the tenure — then plain sums per owner.  Both
    phases are partial (map-side) aggregations, so a hot owner costs one row
    per map task, and no distinct-count ``Expand`` is needed.
    """
    per_policy = hold.groupBy("po_num", "pol_num").agg(
        F.sum("inforce_ape").alias("_ape"),
        F.max((F.col("inforce_year") >= p.tenure_years).cast("int")).alias("_long"),
    )
    return per_policy.groupBy("po_num").agg(
        F.sum("_ape").cast(TOTAL_TYPE).alias("total_ape"),
        F.count(F.col("pol_num")).cast("bigint").alias("pol_cnt"),
        F.coalesce(F.sum("_long"), F.lit(0)).cast("bigint").alias("10yr_pol_cnt"),
    )
