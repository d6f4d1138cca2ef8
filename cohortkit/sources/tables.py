"""Role tables: the inputs of one lead run, and contract-checked readers.

A deployment points each role at its own Parquet directory; the reader selects
only the columns the operators use (so column pruning reaches the scan) and
casts date-like columns to DATE once at ingest, so later comparisons are
between dates, never between a timestamp and date text.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cohortkit.params import RunParams
from cohortkit.sources.orc import read_orc_snapshot, read_partition_union, unwrap_struct

# Columns each role must provide, and which of them are dates.
ROLE_COLUMNS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "coverage": (("pol_num", "plan_code", "vers_num", "cvg_stat_cd", "cvg_typ", "cvg_reasn",
                  "cvg_prem", "cvg_iss_dt"), ("cvg_iss_dt",)),
    "policy": (("pol_num", "pmt_mode", "pol_iss_dt", "frst_iss_dt", "pol_eff_dt", "pol_stat_cd",
                "wa_cd_1", "wa_cd_2", "agt_code"), ("pol_iss_dt", "frst_iss_dt", "pol_eff_dt")),
    "links": (("pol_num", "cli_num", "link_typ"), ()),
    "agents": (("agt_code", "agt_nm", "cntrct_eff_dt", "trmn_dt", "stat_cd", "comp_prvd_num",
                "loc_code", "mobl_phon_num", "can_num"), ("cntrct_eff_dt", "trmn_dt")),
    "candidates": (("can_num", "email_addr", "id_num"), ()),
    "locations": (("loc_code", "city", "region"), ()),
    "regional_heads": (("loc_cd", "rh_name"), ()),
    "scorecard": (("agt_code", "monthend_dt", "agent_tier", "agent_cluster"), ()),
    "structure": (("loc_code", "loc_mrg"), ()),
    "customers": (("cli_num", "cli_nm", "id_num", "sex_code", "birth_dt", "cur_age", "prim_phon_num",
                   "mobl_phon_num", "othr_phon_num", "sms_ind", "email_addr", "sms_eservice_ind",
                   "full_address", "city", "no_dpnd", "occp_code", "mthly_incm", "cli_typ"),
                  ("birth_dt",)),
    "policy_mart": (("po_num", "wa_code", "sa_code"), ()),
    "agent_mart": (("agt_code", "channel", "loc_cd"), ()),
    "lifestage": (("client_number", "monthend_dt", "customer_segment"), ()),
    "client_details": (("cli_num", "id_num"), ()),
    "targets": (("tgt_cust_id", "batch_start_date"), ("batch_start_date",)),
    "need": (("cli_num", "decile_acc", "decile_ci", "decile_med", "decile_inv", "decile_lp",
              "decile_lt", "hml_acc", "hml_ci", "hml_med", "hml_inv", "hml_lp", "hml_lt"), ()),
    "new_need": (("po_num", "month", "ci_decile", "invst_decile", "lt_decile"), ()),
}


# Columns that rules compare or add as numbers: text in their place is refused
# ('10' sorts before '2').
ROLE_NUMBERS: dict[str, tuple[str, ...]] = {
    "coverage": ("cvg_prem",),
    "policy": ("pmt_mode",),
    "customers": ("cur_age", "mthly_incm"),
    "need": ("decile_acc", "decile_ci", "decile_med", "decile_inv", "decile_lp", "decile_lt"),
    "new_need": ("ci_decile", "invst_decile", "lt_decile"),
}


@dataclass
class RoleTables:
    """All inputs of one run, as DataFrames (no catalog, no temp views)."""

    coverage: DataFrame
    policy: DataFrame
    links: DataFrame
    agents: DataFrame
    candidates: DataFrame
    locations: DataFrame
    regional_heads: DataFrame
    scorecard: DataFrame
    structure: DataFrame
    customers: DataFrame
    policy_mart: DataFrame
    agent_mart: DataFrame
    lifestage: DataFrame
    client_details: DataFrame
    targets: DataFrame
    need: DataFrame
    new_need: DataFrame

    @classmethod
    def role_names(cls) -> list[str]:
        return [f.name for f in fields(cls)]


class ContractError(ValueError):
    pass


def conform(df: DataFrame, role: str) -> DataFrame:
    """Select the role's columns (pruning) and cast its dates to DATE; numbers must be numbers."""
    cols, dates = ROLE_COLUMNS[role]
    present = {f.name.lower(): f.dataType for f in df.schema}
    missing = [c for c in cols if c.lower() not in present]
    if missing:
        raise ContractError(f"{role}: missing columns {missing}")
    texts = [c for c in ROLE_NUMBERS.get(role, ()) if isinstance(present[c.lower()], StringType)]
    if texts:
        raise ContractError(f"{role}: text where numbers are compared {texts}")
    return df.select(*[F.col(c).try_cast("date").alias(c) if c in dates else F.col(c) for c in cols])


def read_parquet(spark: SparkSession, path: str, role: str | None = None) -> DataFrame:
    """Parquet scan (schema from the footers); conformed when a role is given."""
    df = spark.read.parquet(path)
    return conform(df, role) if role else df


def read_roles(spark: SparkSession, sources: dict[str, str | DataFrame], params: RunParams | None = None,
               propensity: str = "parquet") -> RoleTables:
    """Read every role from its own Parquet directory (or take it from a frame), by its contract.

    With ``propensity="orc"`` the two propensity models are read from their ORC layouts: ``need`` is the
    snapshot of ``params.needs_month`` in a table of structs (``monthend_dt`` partitions, struct column
    ``row``), ``new_need`` a family of directories whose schemas drift.
    """
    if propensity not in ("parquet", "orc"):
        raise ValueError(f"unknown propensity layout {propensity!r}")
    if propensity == "orc" and params is None:
        raise ValueError("the ORC snapshot is chosen by the run parameters (needs_month)")

    def role(name: str) -> DataFrame:
        source = sources[name]
        if not isinstance(source, str):
            return conform(source, name)
        if propensity == "orc" and name == "need":
            return conform(unwrap_struct(read_orc_snapshot(spark, source, "monthend_dt", params.needs_month)), name)
        if propensity == "orc" and name == "new_need":
            return conform(read_partition_union(spark, source, required=ROLE_COLUMNS[name][0]), name)
        return read_parquet(spark, source, name)

    return RoleTables(**{r: role(r) for r in RoleTables.role_names()})
