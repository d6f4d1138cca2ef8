"""Publish (Steps 9–10): the 79-column lead table, versioned month write with its counts."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortkit.functions.rules import typed_null, yn
from cohortkit.functions.tiers import publish_segment
from cohortkit.operators.combine import FLAG_PART, POLICY_PART
from cohortkit.operators.scoring import NEED_DECILES, NEED_HML, score_leads, scoring_columns, with_propensity
from cohortkit.params import RunParams
from cohortkit.session import children, read_text, remove_staged, replace_text

OWNER_PART = [
    "po_num", "po_name", "po_id_num", "po_sex_code", "po_birth_dt", "po_age_curr", "po_age_curr_grp",
    "po_prim_phon_num", "po_mobl_phon_num", "po_othr_phon_num", "mobile_ind", "opt_sms_ind",
    "po_email_addr", "email_ind", "opt_email_ind", "po_full_addr", "customer_city", "cust_city_cat",
    "lifestage_segment", "max_no_dpnd", "occp_code", "mthly_incm", "mthly_incm_cat", "annual_incm",
    "frst_join_dt", "cus_type", "pol_cnt", "10yr_pol_cnt", "total_ape", "pol_cnt_cat", "total_ape_cat",
    "vip_cat", "near_vip_cat",
]
PUBLISHED_HML = ["hml_acc", "hml_ci", "hml_med", "hml_inv", "hml_lt", "hml_lp"]
LEAD_COLUMNS = (OWNER_PART + ["lead_segment", "hml_propensity_grp", "hl_propensity_grp", "no_high_prop"]
                + PUBLISHED_HML + ["1h_high_prop", "high_prop_model", "high_prop_rules"]
                + FLAG_PART + POLICY_PART + ["excluded", "excluded_grp", "onb_mth_yr"])


def _lead_select(seg_src: Column, cus_type: Column, top2: Column, rules: Column, hml) -> list[Column]:
    return [
        *[F.col(c) for c in OWNER_PART],
        publish_segment(seg_src, cus_type, top2, rules).alias("lead_segment"),
        typed_null("string").alias("hml_propensity_grp"),
        typed_null("string").alias("hl_propensity_grp"),
        typed_null("string").alias("no_high_prop"),
        *[hml(c).alias(c) for c in PUBLISHED_HML],
        typed_null("string").alias("1h_high_prop"),
        yn(top2 == 1).alias("high_prop_model"),
        yn(rules == 1).alias("high_prop_rules"),
        *[F.col(c) for c in FLAG_PART + POLICY_PART],
        F.col("excluded"), F.col("excluded_grp"), F.col("onb_mth_yr"),
    ]


def lead_table(final: DataFrame, need: DataFrame, new_need: DataFrame, p: RunParams,
               mode: str = "in_place", owners: DataFrame | None = None) -> DataFrame:
    """Step 9: the published lead table.

    ``in_place`` (default): the scoring columns are computed on the tagged rows
    themselves — one pass, no self-join; each tagged row appears once per
    propensity match.  ``rejoin`` reproduces the original self-join of the
    tagged rows with their own scoring on (owner, policy, month), which
    multiplies a key with N rows into N² rows.
    """
    base = final.drop(*[c for c in NEED_DECILES + NEED_HML if c in final.columns])
    if mode == "in_place":
        sc = scoring_columns()
        df = with_propensity(base, need, new_need, p, owners)
        scored = df.select("*", sc["top2_hp_model"].alias("top2_hp_model"), sc["hp_rules"].alias("hp_rules"))
        return scored.select(*_lead_select(F.col("lead_segment"), F.col("cus_type"), F.col("top2_hp_model"),
                                           F.col("hp_rules"), F.col))
    if mode == "rejoin":
        sco = score_leads(final, need, new_need, p, owners)
        sco = sco.select(*[F.col(c).alias(f"sco_{c}") for c in sco.columns])
        on = ((base.po_num == sco.sco_po_num) & (base.pol_num == sco.sco_pol_num)
              & (base.onb_mth_yr == sco.sco_onb_mth_yr))
        df = base.join(sco, on, "left")
        return df.select(*_lead_select(F.col("lead_segment"), F.col("sco_cus_type"), F.col("sco_top2_hp_model"),
                                       F.col("sco_hp_rules"), lambda c: F.col(f"sco_{c}")))
    raise ValueError(f"unknown mode {mode!r}")


def write_month(df: DataFrame, path: str, partition_col: str = "onb_mth_yr") -> None:
    """Overwrite only the months present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))


POINTERS = "_published"  # Spark's readers skip names that begin with an underscore


@dataclass(frozen=True)
class Version:
    """One published month: the folder of its rows and what was counted while they were written."""

    month: str
    version: str
    rows: int
    null_keys: int | None       # rows whose key is NULL (None: no such column)
    keys: int | None            # distinct keys, approximate (a mergeable sketch)
    schema: str                 # of the rows, as JSON
    previous: tuple[str, ...] = ()  # versions kept for readers that are still on them


def _pointer(path: str, month_key: str) -> str:
    return f"{path.rstrip('/')}/{POINTERS}/{month_key}.json"


def _folder(path: str, month_key: str, version: str, partition_col: str) -> str:
    return f"{path.rstrip('/')}/{partition_col}={month_key}/version={version}"


def published_versions(spark: SparkSession, path: str) -> list[Version]:
    """The current version of each published month, by month."""
    names = [n for n in children(spark, f"{path.rstrip('/')}/{POINTERS}") if n.endswith(".json")]
    found = [json.loads(read_text(spark, _pointer(path, n.removesuffix(".json")))) for n in names]
    return sorted((Version(**{**f, "previous": tuple(f["previous"])}) for f in found), key=lambda v: v.month)


def publish_month(df: DataFrame, path: str, month_key: str, partition_col: str = "onb_mth_yr", key: str = "po_num",
                  keep: int = 1) -> Version:
    """Write one month's rows as a new version, then switch the month's pointer to it.

    Until the switch (the rename of one small file) readers see the old
    version, so a lost job or a failed write leaves the month as it was; an
    empty frame clears the month in the same way.  Rows, rows without a key
    and distinct keys are counted by the write.  ``keep`` older versions stay
    for readers that have begun; older ones are removed.
    """
    spark = df.sparkSession
    rows = df.where(F.col(partition_col) == F.lit(month_key)).drop(partition_col)
    seen = Observation(f"published-{month_key}")
    counts = [F.count(F.lit(1)).alias("rows")]
    if key in rows.columns:
        counts += [F.count_if(F.col(key).isNull()).alias("null_keys"), F.approx_count_distinct(key).alias("keys")]
    version = uuid.uuid4().hex[:16]
    folder = _folder(path, month_key, version, partition_col)
    try:
        rows.observe(seen, *counts).write.mode("errorifexists").parquet(folder)
    except BaseException:
        remove_staged(spark, [folder])
        raise
    old = next((v for v in published_versions(spark, path) if v.month == month_key), None)
    chain = ((old.version, *old.previous) if old else ())
    got = seen.get
    new = Version(month_key, version, int(got["rows"]), got.get("null_keys"), got.get("keys"), rows.schema.json(), chain[:keep])
    replace_text(spark, _pointer(path, month_key), json.dumps(asdict(new)))
    remove_staged(spark, [_folder(path, month_key, v, partition_col) for v in chain[keep:]])
    return new


def read_published(spark: SparkSession, path: str, partition_col: str = "onb_mth_yr",
                   schema=None) -> DataFrame:
    """Read the published table; the month key stays text (no partition type inference).

    Of months written by :func:`publish_month` their current versions are
    read; a table of :func:`write_month` is read as it lies.  The columns are
    those of ``schema``, or of the last month.  A table whose months are all
    empty reads as an empty frame.
    """
    current = published_versions(spark, path)
    if not current:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(path)
        return df.withColumn(partition_col, F.col(partition_col).cast("string"))
    if schema is None:
        schema = StructType.fromJson(json.loads(current[-1].schema)).add(partition_col, "string")
    folders = [_folder(path, v.month, v.version, partition_col) for v in current if v.rows]
    if not folders:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return df.select(*[f.name for f in schema.fields])


def read_month(spark: SparkSession, path: str, month_key: str, partition_col: str = "onb_mth_yr",
               schema=None) -> DataFrame:
    """Read back one month (partition pruning on the month key)."""
    return read_published(spark, path, partition_col, schema).where(F.col(partition_col) == F.lit(month_key))


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row frame (``agg(count(1))``)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def publish(spark: SparkSession, leads: DataFrame, path: str, p: RunParams) -> int:
    """Publish the month (:func:`publish_month`); its rows, as counted by the write."""
    return publish_month(leads, path, p.month_key).rows
