"""Combine (Step 6) and exclusion tagging (Step 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions import rulebook as R
from cohortkit.functions.rules import any_flag, first_reason
from cohortkit.functions.tiers import lead_segment
from cohortkit.operators.flags import related_party_flag, repurchased_flag, unassigned_flag

PROFILE_PART = [
    "po_num", "po_name", "po_id_num", "po_sex_code", "po_birth_dt", "po_age_curr", "po_age_curr_grp",
    "po_prim_phon_num", "po_mobl_phon_num", "po_othr_phon_num", "mobile_ind", "opt_sms_ind",
    "po_email_addr", "email_ind", "opt_email_ind", "po_full_addr", "customer_city", "cust_city_cat",
    "lifestage_segment", "max_no_dpnd", "occp_code", "mthly_incm", "mthly_incm_cat", "annual_incm",
    "frst_join_dt", "cus_type", "pol_cnt", "10yr_pol_cnt", "total_ape", "pol_cnt_cat", "total_ape_cat",
    "vip_cat", "near_vip_cat", "lead_segment", "hml_propensity_grp", "hl_propensity_grp", "no_high_prop",
    "hml_acc_med", "hml_inv", "hml_term", "hml_ul", "1h_high_prop",
]
FLAG_PART = ["in_onb_po", "in_onb_ins", "in_onb", "in_banca", "in_dmtm", "sagt_rltv", "repurchased", "unassigned"]
POLICY_PART = [
    "pol_num", "plan_code", "vers_num", "insrd_num", "base_ape", "pol_iss_dt", "sagt_cd", "sagt_name",
    "sagt_status", "sagt_mobl_phon", "sagt_email_addr", "sagt_id_num", "sagt_comp_prvd_num", "sagt_city",
    "sagt_loc_code", "sagt_region", "sagt_mgr_cd", "sagt_mgr_nm", "cus_agt_rltnshp", "sagt_tier",
    "sagt_cluster", "sagt_rh",
]
COMBINED_COLUMNS = PROFILE_PART + FLAG_PART + POLICY_PART + ["onb_mth_yr"]
FINAL_COLUMNS = PROFILE_PART + FLAG_PART + POLICY_PART + ["excluded", "excluded_grp", "onb_mth_yr"]

AGENT_RENAMES = {
    "agt_nm": "sagt_name", "agt_status": "sagt_status", "mobl_phon_num": "sagt_mobl_phon",
    "email_addr": "sagt_email_addr", "agt_id_num": "sagt_id_num", "city": "sagt_city",
    "loc_code": "sagt_loc_code", "region": "sagt_region", "mgr_cd": "sagt_mgr_cd", "mgr_nm": "sagt_mgr_nm",
    "agent_tier": "sagt_tier", "agent_cluster": "sagt_cluster", "agent_rh": "sagt_rh",
}


def combine(first: DataFrame, profile: DataFrame, agent_dim: DataFrame, owner_flags: DataFrame,
            party_pairs: DataFrame) -> DataFrame:
    """Leads at first-contract grain with profile, servicing agent and flags, DISTINCT.

    ``first`` are the first-contract base-coverage rows of the cohort.  The
    profile join is inner (non-individual owners leave), the agent join is
    inner on the servicing agent, flags are left joins.
    """
    agt = agent_dim.select(
        F.col("agt_code").alias("sagt_cd"),
        F.col("comp_prvd_num").alias("_agt_comp_prvd_num"),
        *[F.col(k).alias(v) for k, v in AGENT_RENAMES.items()])
    base = (first.drop("sagt_comp_prvd_num", "onb_mth_yr")
            .withColumnRenamed("ins_num", "insrd_num")
            .withColumnRenamed("inforce_ape", "base_ape"))
    df = (base.join(profile, "po_num", "inner")
              .join(agt, "sagt_cd", "inner")
              .join(owner_flags, "po_num", "left"))
    df = related_party_flag(df, party_pairs)
    df = df.select(
        *[c for c in PROFILE_PART if c != "lead_segment"],
        lead_segment("near_vip_cat", "vip_cat", "cus_type", "mthly_incm").alias("lead_segment"),
        *[F.coalesce(F.col(c), F.lit("N")).alias(c) for c in ("in_onb_po", "in_onb_ins", "in_onb",
                                                               "in_banca", "in_dmtm")],
        "sagt_rltv",
        repurchased_flag().alias("repurchased"),
        unassigned_flag().alias("unassigned"),
        *[c for c in POLICY_PART if c != "sagt_comp_prvd_num"],
        F.col("_agt_comp_prvd_num").alias("sagt_comp_prvd_num"),
        "onb_mth_yr",
    )
    return df.select(*COMBINED_COLUMNS).distinct()


def tag_exclusions(combined: DataFrame) -> DataFrame:
    """Add ``excluded`` (any flag) and ``excluded_grp`` (first reason by priority).

    Rows are tagged, never dropped.
    """
    return combined.select(
        *PROFILE_PART, *FLAG_PART, *POLICY_PART,
        any_flag(R.EXCLUSION_FLAGS).alias("excluded"),
        first_reason(R.EXCLUSION_REASONS, R.NOT_EXCLUDED).alias("excluded_grp"),
        "onb_mth_yr",
    )
