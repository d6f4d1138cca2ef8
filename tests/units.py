"""Hand-made role tables for unit tests (string identifiers, as in the contract)."""

from __future__ import annotations

import re

from cohortkit.sources.tables import RoleTables

SCHEMAS = {
    "coverage": "pol_num string, plan_code string, vers_num string, cvg_stat_cd string, cvg_typ string, "
                "cvg_reasn string, cvg_prem decimal(18,2), cvg_iss_dt date",
    "policy": "pol_num string, pmt_mode int, pol_iss_dt date, frst_iss_dt date, pol_eff_dt date, "
              "pol_stat_cd string, wa_cd_1 string, wa_cd_2 string, agt_code string",
    "links": "pol_num string, cli_num string, link_typ string",
    "agents": "agt_code string, agt_nm string, cntrct_eff_dt date, trmn_dt date, stat_cd string, "
              "comp_prvd_num string, loc_code string, mobl_phon_num string, can_num string",
    "candidates": "can_num string, email_addr string, id_num string",
    "locations": "loc_code string, city string, region string",
    "regional_heads": "loc_cd string, rh_name string",
    "scorecard": "agt_code string, monthend_dt string, agent_tier string, agent_cluster string",
    "structure": "loc_code string, loc_mrg string",
    "customers": "cli_num string, cli_nm string, id_num string, sex_code string, birth_dt date, cur_age int, "
                 "prim_phon_num string, mobl_phon_num string, othr_phon_num string, sms_ind string, "
                 "email_addr string, sms_eservice_ind string, full_address string, city string, no_dpnd int, "
                 "occp_code string, mthly_incm decimal(18,2), cli_typ string",
    "policy_mart": "po_num string, wa_code string, sa_code string",
    "agent_mart": "agt_code string, channel string, loc_cd string",
    "lifestage": "client_number string, monthend_dt string, customer_segment string",
    "client_details": "cli_num string, id_num string",
    "targets": "tgt_cust_id string, batch_start_date date",
    "need": "cli_num string, decile_acc int, decile_ci int, decile_med int, decile_inv int, decile_lp int, "
            "decile_lt int, hml_acc string, hml_ci string, hml_med string, hml_inv string, hml_lp string, "
            "hml_lt string",
    "new_need": "po_num string, month string, ci_decile int, invst_decile int, lt_decile int",
}


def _names(schema: str) -> list[str]:
    parts = re.split(r",(?![^(]*\))", schema)   # commas outside parentheses
    return [part.strip().split(" ")[0] for part in parts]


def make_roles(spark, **rows) -> RoleTables:
    """RoleTables from lists of dicts; missing columns are NULL, missing roles empty."""
    frames = {}
    for role, schema in SCHEMAS.items():
        cols = _names(schema)
        data = [tuple(r.get(c) for c in cols) for r in rows.get(role, [])]
        frames[role] = spark.createDataFrame(data, schema)
    return RoleTables(**frames)
