"""Customer profile (Step 4): bands, first join date, holdings tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions import rulebook as R
from cohortkit.functions.rules import present_flag, typed_null
from cohortkit.functions.tiers import (
    age_band,
    city_category,
    income_band,
    near_tier,
    new_or_existing,
    policy_count_band,
    premium_band,
    value_tier,
)
from cohortkit.operators.cohort import owner_facts, policy_history
from cohortkit.operators.common import links_of
from cohortkit.params import RunParams
from cohortkit.sources.tables import RoleTables

PROFILE_COLUMNS = [
    "po_num", "po_name", "po_id_num", "po_sex_code", "po_birth_dt", "po_age_curr", "po_age_curr_grp",
    "po_prim_phon_num", "po_mobl_phon_num", "po_othr_phon_num", "mobile_ind", "opt_sms_ind",
    "po_email_addr", "email_ind", "opt_email_ind", "po_full_addr", "customer_city", "cust_city_cat",
    "lifestage_segment", "max_no_dpnd", "occp_code", "mthly_incm", "mthly_incm_cat", "annual_incm",
    "frst_join_dt", "cus_type", "pol_cnt", "10yr_pol_cnt", "total_ape", "pol_cnt_cat", "total_ape_cat",
    "vip_cat", "near_vip_cat", "hml_propensity_grp", "no_high_prop", "hl_propensity_grp", "hml_acc_med",
    "hml_inv", "hml_term", "hml_ul", "1h_high_prop", "onb_mth_yr",
]

PLACEHOLDERS = ["hml_propensity_grp", "no_high_prop", "hl_propensity_grp", "hml_acc_med", "hml_inv",
                "hml_term", "hml_ul", "1h_high_prop"]


def first_join_dates(t: RoleTables, p: RunParams, owners: DataFrame | None = None,
                     facts: DataFrame | None = None) -> DataFrame:
    """Per owner: ``COALESCE(MIN(first issue), MIN(issue), MIN(effective))``.

    Read from ``facts`` (:func:`cohortkit.operators.cohort.owner_facts`), or
    from the policy history of ``owners`` (None: of every owner).
    """
    if facts is None:
        own = None if owners is None else links_of(t.links, "O", "po_num").join(owners.select("po_num"), "po_num", "left_semi")
        facts = owner_facts(policy_history(t, p, own)[0], p)
    return facts.select(F.col("po_num").alias("cli_num"), "frst_join_dt")


def lifestage_snapshot(lifestage: DataFrame, month: str) -> DataFrame:
    return (lifestage.where(F.col("monthend_dt") == F.lit(month))
            .select(F.col("client_number").alias("po_num"), "customer_segment"))


def customer_profile(t: RoleTables, p: RunParams, owners: DataFrame, summary: DataFrame,
                     first_dates: DataFrame | None = None) -> DataFrame:
    """One row per cohort owner who is an individual customer (DISTINCT).

    Starts from the distinct cohort owners rather than every cohort row: every
    output column depends on the owner only, so the DISTINCT result is the
    same and the joins see one row per owner.
    """
    if first_dates is None:
        first_dates = first_join_dates(t, p, owners)
    keys = owners.select("po_num")
    # customers ⋈ (distinct owners) is the customers' rows of those owners: a
    # semi-join, which is a map-side filter when the owner set is broadcast.
    cli = (t.customers.where(F.col("cli_typ") == F.lit("Individual"))
           .withColumnRenamed("cli_num", "po_num")
           .join(keys, "po_num", "left_semi"))
    seg = lifestage_snapshot(t.lifestage, p.lifestage_month).join(keys, "po_num", "left_semi")
    fj = first_dates.select(F.col("cli_num").alias("po_num"), "frst_join_dt")
    df = (cli.join(seg, "po_num", "left")
             .join(fj, "po_num", "left")
             .join(summary, "po_num", "left"))
    total, long_cnt = F.col("total_ape"), F.col("10yr_pol_cnt")
    return df.select(
        "po_num",
        F.col("cli_nm").alias("po_name"),
        F.col("id_num").alias("po_id_num"),
        F.col("sex_code").alias("po_sex_code"),
        F.to_date("birth_dt").alias("po_birth_dt"),
        F.col("cur_age").alias("po_age_curr"),
        age_band("cur_age").alias("po_age_curr_grp"),
        F.col("prim_phon_num").alias("po_prim_phon_num"),
        F.col("mobl_phon_num").alias("po_mobl_phon_num"),
        F.col("othr_phon_num").alias("po_othr_phon_num"),
        present_flag("mobl_phon_num").alias("mobile_ind"),
        F.col("sms_ind").alias("opt_sms_ind"),
        F.col("email_addr").alias("po_email_addr"),
        present_flag("email_addr").alias("email_ind"),
        F.col("sms_eservice_ind").alias("opt_email_ind"),
        F.col("full_address").alias("po_full_addr"),
        F.col("city").alias("customer_city"),
        city_category("city").alias("cust_city_cat"),
        F.coalesce(F.col("customer_segment"), F.lit(R.LIFESTAGE_DEFAULT)).alias("lifestage_segment"),
        F.col("no_dpnd").alias("max_no_dpnd"),
        "occp_code",
        "mthly_incm",
        income_band("mthly_incm").alias("mthly_incm_cat"),
        (F.col("mthly_incm") * F.lit(12)).cast("decimal(20,2)").alias("annual_incm"),
        F.to_date("frst_join_dt").alias("frst_join_dt"),
        new_or_existing("frst_join_dt", p.new_window_start, p.month_end).alias("cus_type"),
        "pol_cnt", "10yr_pol_cnt", "total_ape",
        policy_count_band("pol_cnt").alias("pol_cnt_cat"),
        premium_band(total).alias("total_ape_cat"),
        value_tier(total, long_cnt).alias("vip_cat"),
        near_tier(total, long_cnt).alias("near_vip_cat"),
        *[typed_null("string").alias(c) for c in PLACEHOLDERS],
        F.lit(p.month_key).alias("onb_mth_yr"),
    ).select(*PROFILE_COLUMNS).distinct()
