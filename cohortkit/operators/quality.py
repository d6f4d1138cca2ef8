"""Data-quality counts: joined dimensions that must be unique per key, and rows that the joins drop.

A duplicate key in a dimension (location, regional head, scorecard snapshot,
manager, life stage, propensity) multiplies lead rows silently, and the
profile's inner join drops owners who are not individual customers.  These
counts make both visible; each is one grouped aggregation, and the report is
a handful of rows.  The ledger gives every coverage row its first reason for
leaving the run, so that reasons and kept rows add up to the input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.dates import in_month
from cohortkit.operators.cohort import agent_roles, cohort_base, first_contract
from cohortkit.operators.dims import key_multiplicity, location_managers, scorecard_snapshot
from cohortkit.operators.profile import lifestage_snapshot
from cohortkit.operators.scoring import new_model_month
from cohortkit.params import RunParams
from cohortkit.sources.tables import RoleTables


def _count_row(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("check"), "value")


def dimension_key_report(t: RoleTables, p: RunParams) -> DataFrame:
    """Number of keys occurring more than once, per dimension used by a join."""
    checks = [
        ("candidates:can_num", key_multiplicity(t.candidates, ["can_num"])),
        ("locations:loc_code", key_multiplicity(t.locations, ["loc_code"])),
        ("regional_heads:loc_cd", key_multiplicity(t.regional_heads, ["loc_cd"])),
        ("scorecard:agt_code@snapshot",
         key_multiplicity(scorecard_snapshot(t.scorecard, p.scorecard_month_end), ["agt_code"])),
        ("managers:loc_code", key_multiplicity(location_managers(t.structure, t.agents), ["loc_code"])),
        ("lifestage:client_number@snapshot",
         key_multiplicity(lifestage_snapshot(t.lifestage, p.lifestage_month), ["po_num"])),
        ("agent_mart:agt_code", key_multiplicity(t.agent_mart, ["agt_code"])),
        ("need:cli_num", key_multiplicity(t.need, ["cli_num"])),
        ("new_need:po_num@month", key_multiplicity(new_model_month(t.new_need, p.month_key), ["po_num"])),
    ]
    return reduce(DataFrame.unionByName, [_count_row(n, df) for n, df in checks])


def dropped_owner_report(t: RoleTables, owners: DataFrame) -> DataFrame:
    """Cohort owners that the profile's inner join drops (no individual customer row)."""
    ind = t.customers.where(F.col("cli_typ") == F.lit("Individual")).select(F.col("cli_num").alias("po_num"))
    dropped = owners.select("po_num").join(ind, "po_num", "left_anti")
    return reduce(DataFrame.unionByName, [
        _count_row("cohort_owners", owners.select("po_num")),
        _count_row("owners_without_individual_profile", dropped),
    ])


#: Reasons for leaving a run, in the order in which its joins and filters apply.
DROP_REASONS = ("no policy", "issued outside the month", "not in force", "writing agent does not qualify",
                "servicing agent does not qualify", "no owner", "no insured", "not the first contract of an owner",
                "not a base coverage", "first owner is no individual customer", "kept")


def dropped_row_ledger(t: RoleTables, p: RunParams, reuse: str | None = "table") -> DataFrame:
    """(reason, coverages): the first reason of each coverage row for not being a lead, or 'kept'.

    Everything but the coverage type is a property of the policy, so coverage rows are counted by policy and
    type first (map-side), and only these counts meet the policies: one grouped pass over each large table, outer
    joins on the policy number.  A policy that occurs more than once counts with its row that gets furthest.
    """
    wa, sa = agent_roles(t, p)
    steps = (t.policy.join(wa, t.policy.wa_cd_1 == wa.wa_agt_code, "left").join(sa, t.policy.agt_code == sa.sa_agt_code, "left")
             .select("pol_num", F.when(~F.coalesce(in_month("pol_iss_dt", p.month_start, p.next_month_start), F.lit(False)), 1)
                     .when(~F.coalesce(F.col("pol_stat_cd").isin(*p.inforce_status), F.lit(False)), 2)
                     .when(F.col("wa_agt_code").isNull(), 3).when(F.col("sa_agt_code").isNull(), 4).otherwise(5).alias("step"))
             .groupBy("pol_num").agg(F.max("step").alias("step")))
    # the links matter for policies that got so far only
    far = steps.where("step = 5").select("pol_num")
    parties = (t.links.where(F.col("link_typ").isin("O", "I")).join(far, "pol_num", "left_semi").groupBy("pol_num")
               .agg(F.max(F.col("link_typ") == "O").alias("owned"), F.max(F.col("link_typ") == "I").alias("insured")))
    base = cohort_base(t, p, reuse)[0]
    individual = t.customers.where(F.col("cli_typ") == F.lit("Individual")).select(
        F.col("cli_num").alias("po_num"), F.lit(True).alias("individual")).join(base.select("po_num"), "po_num", "left_semi")
    firsts = (first_contract(base, base_only=False).select("pol_num", "po_num").distinct()
              .join(individual, "po_num", "left").groupBy("pol_num").agg(
                  F.max(F.coalesce("individual", F.lit(False))).alias("individual"), F.lit(True).alias("is_first")))
    is_base = F.coalesce((F.col("cvg_typ") == "B") & (F.col("cvg_reasn") == "O"), F.lit(False))
    counted = t.coverage.groupBy("pol_num", is_base.alias("is_base")).agg(F.count(F.lit(1)).alias("n"))
    df = counted.join(steps, "pol_num", "left").join(parties, "pol_num", "left").join(firsts, "pol_num", "left")
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    place = (F.when(F.col("step").isNull(), 0).when(F.col("step") < 5, F.col("step")).when(no("owned"), 5).when(no("insured"), 6)
             .when(no("is_first"), 7).when(~F.col("is_base"), 8).when(no("individual"), 9).otherwise(10))
    reason = F.element_at(F.array(*[F.lit(r) for r in DROP_REASONS]), place + 1)
    return df.groupBy(reason.alias("reason")).agg(F.sum("n").cast("bigint").alias("coverages"))
