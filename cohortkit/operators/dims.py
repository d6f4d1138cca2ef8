"""Agent dimension (Step 3): agent + candidate + place + head + scorecard + manager."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions import rulebook as R
from cohortkit.functions.rules import lower_equals_flag
from cohortkit.functions.tiers import status_decode
from cohortkit.operators.common import DEFAULT_BROADCAST_ROWS, bounded_broadcast, stage_table
from cohortkit.params import RunParams
from cohortkit.sources.tables import RoleTables

AGENT_DIM_COLUMNS = [
    "agt_code", "agt_nm", "cntrct_eff_dt", "trmn_dt", "agt_status", "comp_prvd_num", "loc_code", "city",
    "region", "mobl_phon_num", "email_addr", "agt_id_num", "mgr_cd", "mgr_nm", "mdrt_ind", "fc_ind",
    "1maa_ind", "3maa_ind", "agent_tier", "agent_cluster", "agent_rh", "onb_mth_yr",
]


def scorecard_snapshot(scorecard: DataFrame, month_end: str) -> DataFrame:
    """One snapshot of the scorecard (the constant of the join's ON clause, pushed down)."""
    return (scorecard.where(F.col("monthend_dt") == F.lit(month_end))
            .select("agt_code", "agent_tier", "agent_cluster"))


def location_managers(structure: DataFrame, agents: DataFrame) -> DataFrame:
    """Distinct (location, manager code, manager name) from the sales structure."""
    mgr = agents.select(F.col("agt_code").alias("loc_mrg"), F.col("agt_nm").alias("mgr_nm"))
    return (structure.where(F.col("loc_code").isNotNull())
            .join(mgr, "loc_mrg", "inner")
            .select("loc_code", "loc_mrg", "mgr_nm").distinct())


def as_of(df: DataFrame, keys: Sequence[str], effective: str | None = None, at: object = None) -> DataFrame:
    """One row for each key: that with the latest ``effective`` value up to ``at`` (no date or limit: of all rows).

    Ties go to the greatest of the remaining columns, in their order, NULL below
    any value; so the row depends on the data alone, not on how it is read.
    One grouped pass with map-side combine (``max_by``); keys stay columns.
    """
    rest = [c for c in df.columns if c not in keys and c != effective]
    if effective is not None and at is not None:
        df = df.where(F.col(effective) <= F.lit(at))
    # a flag before each value: max() of a struct orders NULL first anyway, the flag states it
    order = F.struct(*([F.col(effective)] if effective else []), *[x for c in rest for x in (F.col(c).isNotNull(), F.col(c))])
    kept = ([effective] if effective else []) + rest
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*kept), order).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in kept]).select(*df.columns)


def _of_agents(df: DataFrame, agents: DataFrame, key: str, rows: int, p: RunParams) -> DataFrame:
    """The rows of ``df`` whose ``key`` one of the (counted) agents has."""
    keys = bounded_broadcast(agents.select(key), p.extra.get("agent_max_rows", DEFAULT_BROADCAST_ROWS), rows)
    return df.join(keys, key, "left_semi")


def agent_dimension(t: RoleTables, p: RunParams, unique: bool = False, codes: DataFrame | None = None,
                    reuse: str | None = None) -> DataFrame:
    """Servicing-channel agents with their descriptive attributes, DISTINCT.

    All right sides are dimensions keyed by agent or location; the agent table
    itself drives the joins.  Duplicate right-side keys multiply rows exactly
    as in SQL; DISTINCT then removes only identical rows.  With ``unique``
    each right side has one row for each key (:func:`as_of`), the scorecard
    its last snapshot up to the run's, so no lead is multiplied.

    ``codes`` (a frame with ``agt_code``) cuts the agents to those that a run
    needs, and the scorecards, candidates and sales structure to those of these
    agents, before any join; None takes every agent.  With ``reuse="table"`` the
    cut agents are written once, and their counted rows decide whether their
    keys are broadcast, so that the other tables are cut where they are read.
    """
    sa, scorecard = t.agents.where(F.col("comp_prvd_num").isin(*p.servicing_channels)), t.scorecard
    candidates, structure = t.candidates, t.structure
    if codes is not None:
        sa, scorecard = sa.join(codes, "agt_code", "left_semi"), scorecard.join(codes, "agt_code", "left_semi")
        if reuse is not None:
            sa, rows = stage_table(sa, "cohort_agent_rows")
            candidates, structure = _of_agents(candidates, sa, "can_num", rows, p), _of_agents(structure, sa, "loc_code", rows, p)
    can = candidates.select("can_num", "email_addr", F.col("id_num").alias("agt_id_num"))
    loc = t.locations.select("loc_code", "city", "region")
    rh = t.regional_heads.select(F.col("loc_cd").alias("loc_code"), F.col("rh_name").alias("agent_rh"))
    mgr = location_managers(structure, t.agents).select(
        "loc_code", F.col("loc_mrg").alias("mgr_cd"), "mgr_nm")
    if unique:
        can, loc, rh, mgr = as_of(can, ["can_num"]), as_of(loc, ["loc_code"]), as_of(rh, ["loc_code"]), as_of(mgr, ["loc_code"])
        sc = as_of(scorecard.select("agt_code", "monthend_dt", "agent_tier", "agent_cluster"), ["agt_code"],
                   "monthend_dt", p.scorecard_month_end).drop("monthend_dt")
    else:
        sc = scorecard_snapshot(scorecard, p.scorecard_month_end)
    df = (sa.join(can, "can_num", "left")
            .join(loc, "loc_code", "left")
            .join(rh, "loc_code", "left")
            .join(sc, "agt_code", "left")
            .join(mgr, "loc_code", "left"))
    return df.select(
        "agt_code", "agt_nm", F.to_date("cntrct_eff_dt").alias("cntrct_eff_dt"),
        F.to_date("trmn_dt").alias("trmn_dt"), status_decode("stat_cd").alias("agt_status"),
        "comp_prvd_num", "loc_code", "city", "region", "mobl_phon_num", "email_addr", "agt_id_num",
        "mgr_cd", "mgr_nm",
        *[lower_equals_flag("agent_tier", v).alias(name) for name, v in R.TIER_INDICATORS],
        "agent_tier", "agent_cluster", "agent_rh", F.lit(p.month_key).alias("onb_mth_yr"),
    ).distinct()


def key_multiplicity(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key where a key occurs more than once (dimension uniqueness check)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > 1))
