"""The monthly lead plan: every stage composed from the operators.

``build_stages`` returns each stage's DataFrame, so a caller (or a test) can
inspect any step; it writes the reduced sides that several stages share (cohort,
owners, links, policies) and checks their sizes, the rest is lazy.
``run_month`` is the job: it builds the stages, replaces the month's partition,
counts what was written and removes the staged folders.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.operators import cohort as C
from cohortkit.operators import combine as M
from cohortkit.operators import dims as D
from cohortkit.operators import flags as FL
from cohortkit.operators import profile as P
from cohortkit.operators import publish as PB
from cohortkit.operators import scoring as S
from cohortkit.operators.common import (  # noqa: F401 (materialize re-exported)
    DEFAULT_BROADCAST_ROWS,
    dense_rank_within,
    materialize,
    stage_table,
    staged_broadcast,
    within_bounds,
)
from cohortkit.params import RunParams
from cohortkit.session import remove_staged, staging_scope
from cohortkit.sources.tables import RoleTables, read_roles


# Upper bound on distinct cohort owners for the broadcast path (rows).
OWNER_MAX_ROWS = 5_000_000


@dataclass
class LeadStages:
    cohort: DataFrame        # Step 1 (without the full rank; see first_contract)
    owners: DataFrame        # distinct cohort owners (size-checked broadcast)
    first: DataFrame         # first-contract base rows
    holdings: DataFrame      # Step 2
    summary: DataFrame       # holdings aggregate per owner
    agent_dim: DataFrame     # Step 3
    profile: DataFrame       # Step 4
    party_pairs: DataFrame   # Step 5 as (policy, id) rows
    owner_flags: DataFrame   # contact / channel / repurchase flags per owner
    combined: DataFrame      # Step 6
    final: DataFrame         # Step 7
    need: DataFrame
    new_need: DataFrame
    params: RunParams
    mode: str = "in_place"

    staged: list[str] = field(default_factory=list)  # folders to remove with close()

    @cached_property
    def ranked_cohort(self) -> DataFrame:    # Step 1 with its rank column
        return dense_rank_within(self.cohort, ["po_num"], ["pol_iss_dt", "pol_num"], "purchase_order_base").select(*C.COHORT_COLUMNS)

    @cached_property
    def ranked_holdings(self) -> DataFrame:  # Step 2 with its rank column
        return dense_rank_within(self.holdings.drop("purchase_order_base"), ["po_num"], ["pol_iss_dt"],
                                 "purchase_order_base").select(*C.HOLDINGS_COLUMNS)

    @cached_property
    def scoring(self) -> DataFrame:   # Step 8 (built on first use)
        return S.score_leads(self.final, self.need, self.new_need, self.params, self.owners)

    @cached_property
    def leads(self) -> DataFrame:     # Step 9 (built on first use)
        return PB.lead_table(self.final, self.need, self.new_need, self.params, mode=self.mode, owners=self.owners)

    def close(self) -> int:
        """Remove the staged folders; the frames can't be read afterwards."""
        return remove_staged(self.final.sparkSession, self.staged)


def build_stages(t: RoleTables, p: RunParams, mode: str = "in_place", reuse: str | None = "table",
                 insured_keys: tuple[str, str] = ("tgt_cust_id", "pol_num")) -> LeadStages:
    """All stages of one month; runs the staging writes and size checks, the rest is lazy."""
    with staging_scope() as made:
        try:
            stages = _build_stages(t, p, mode, reuse, insured_keys)
        except BaseException:
            remove_staged(t.policy.sparkSession, made)
            raise
    stages.staged = made
    return stages


def _build_stages(t: RoleTables, p: RunParams, mode: str = "in_place", reuse: str | None = "table",
                 insured_keys: tuple[str, str] = ("tgt_cust_id", "pol_num")) -> LeadStages:
    """All stages of one month.

    The cohort is read by five later stages (owners, first contract, holdings,
    party IDs, flags); with ``reuse="table"`` it is computed once, at coverage ×
    owner grain, and written to the shared checkpoint folder, so the coverage
    scan and its joins run once instead of once per consumer.  The insured link
    is joined to the first-contract rows alone; ``cohort`` joins it on demand.  In ``rejoin`` mode the tagged
    leads are read twice (directly and through scoring) and are materialised
    the same way.
    """
    base_df, insureds = C.cohort_base(t, p, reuse=reuse)
    # Owners are at most the month's policies: size-checked once, then every
    # owner semi-join (holdings, first dates, flags, profile) is map-side.  A
    # staged cohort bounds its distinct owners by its own size on disk.
    if reuse == "table":
        base = stage_table(base_df, "cohort")[0]
        owners, n_owners = stage_table(C.cohort_owners(base), "owners")
    else:  # nothing is written, so no size is known: the joins are left to the planner
        base, n_owners = materialize(base_df, reuse, "cohort"), None
        owners = C.cohort_owners(base)
    owner_rows = p.extra.get("owner_max_rows", OWNER_MAX_ROWS)
    owners_bounded = n_owners is not None and within_bounds(owners, n_owners, owner_rows)
    owners = F.broadcast(owners) if owners_bounded else owners

    def per_owner(df: DataFrame) -> DataFrame:
        # Grouped by owner after the semi-join to the owner set: at most one row
        # per owner, so its size is bounded by the owners times its own width.
        return F.broadcast(df) if n_owners is not None and within_bounds(df, n_owners, owner_rows) else df

    cohort = C.with_insured(base, insureds)
    first = C.with_insured(C.first_contract(base), insureds)
    own_links = C.owner_policy_links(t, p, owners, reuse, salted=n_owners is not None and not owners_bounded)
    history = C.policy_history(t, p, own_links, reuse)
    hold = C.holdings(t, p, owners, reuse=reuse, history=history)
    facts = C.owner_facts(history[0], p)
    if reuse is not None:  # one grouped pass, read by the profile and by the flags
        facts = stage_table(facts, "owner_facts")[0]
    summary = per_owner(C.holdings_summary(hold, p))
    # Only the cohort's servicing agents meet the other dimensions.  The dimension is written once, so that its counted
    # rows (duplicate keys included) decide whether the leads meet it without a shuffle of their own.
    agent_rows = p.extra.get("agent_max_rows", DEFAULT_BROADCAST_ROWS)
    codes = staged_broadcast(base.select(F.col("sagt_cd").alias("agt_code")).distinct(), agent_rows, reuse, "cohort_agents")
    agent_dim = staged_broadcast(D.agent_dimension(t, p, codes=codes, reuse=reuse), agent_rows, reuse, "agent_dim")
    first_dates = per_owner(P.first_join_dates(t, p, facts=facts))
    profile = P.customer_profile(t, p, owners, summary, first_dates)
    policies = base.select("pol_num").distinct()
    if reuse is not None:
        policies = staged_broadcast(policies, OWNER_MAX_ROWS, reuse, "cohort_policies")
    pairs = FL.party_ids(t, p, policies=policies, reuse=reuse)
    oflags = per_owner(FL.owner_flags(t, p, owners, insured_keys=insured_keys, facts=facts))
    combined = M.combine(first, profile, agent_dim, oflags, pairs)
    final = M.tag_exclusions(combined)
    if mode == "rejoin":
        final = materialize(final, reuse, "tagged_leads")
    return LeadStages(cohort, owners, first, hold, summary, agent_dim, profile, pairs, oflags,
                      combined, final, t.need, t.new_need, p, mode)


def run_month(spark: SparkSession, t: RoleTables, p: RunParams, out_path: str,
              mode: str = "in_place", reuse: str | None = "table") -> int:
    """The monthly job: build, write the month's partition once, count it.

    The staged intermediate tables are removed once the month is published.
    """
    with staging_scope() as made:
        try:
            return PB.publish(spark, build_stages(t, p, mode=mode, reuse=reuse).leads, out_path, p)
        finally:
            remove_staged(spark, made)


def run(spark: SparkSession, sources: dict[str, str | DataFrame], p: RunParams, out_path: str,
        propensity: str = "orc", mode: str = "in_place") -> int:
    """One monthly run from its sources: the parameters choose the month, the snapshots and the propensity month."""
    return run_month(spark, read_roles(spark, sources, p, propensity), p, out_path, mode=mode)
