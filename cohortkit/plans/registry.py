"""Query registry: one Spark query and one DuckDB oracle per operator key.

Every query reads the synthetic tables of ``sf_dir`` (through the fixture
adapter) and runs over the whole tables; nothing is sampled or capped.
Queries that exercise sinks and file sources write to a fresh folder under
the session's checkpoint directory and read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions import rulebook as R
from cohortkit.functions import tiers as T
from cohortkit.functions.dates import in_month, month_key_from_text, month_key_of, tenure_years
from cohortkit.functions.rules import least_in, present_flag, typed_null, yn
from cohortkit.operators import backfill as BF
from cohortkit.operators import cohort as C
from cohortkit.operators import dims as D
from cohortkit.operators import flags as FL
from cohortkit.operators import profile as P
from cohortkit.operators import publish as PB
from cohortkit.operators import scoring as S
from cohortkit.operators.common import annualized, links_of, materialize, staged_broadcast
from cohortkit.params import RunParams, add_months, last_day
from cohortkit.plans import oracle as O
from cohortkit.plans.leads import OWNER_MAX_ROWS, build_stages, run
from cohortkit.session import staging_path
from cohortkit.sources import orc as ORC
from cohortkit.sources.bucketed import with_bucketed, write_bucketed
from cohortkit.sources.fixtures import FIXTURE_PARAMS, build_fixture_tables, need_struct_frame
from cohortkit.sources.tables import RoleTables, conform, read_parquet

PR: RunParams = FIXTURE_PARAMS
Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None):
    def deco(fn):
        _QUERIES[key] = fn
        if sql is not None:
            _ORACLES[key] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def roles(spark: SparkSession, sf: str) -> RoleTables:
    return build_fixture_tables(spark, sf, PR)


def stages(spark: SparkSession, sf: str, mode: str = "in_place"):
    return build_stages(roles(spark, sf), PR, mode=mode)



def _owners(t: RoleTables) -> DataFrame:
    """The distinct cohort owners, staged once and broadcast within their bound."""
    return staged_broadcast(C.cohort_owners(C.active_cohort(t, PR, rank=None)), OWNER_MAX_ROWS, "table", "owners")


RQ, SQ = O.roles_query, O.stage_query
L = O.Lit(PR)
ME = L.me

# Per-owner holdings of *every* owner (not only the cohort) for the band/tier keys.
def _all_hld_query(select: str) -> str:
    held = O.holdings_sum_sql(f"({O.held_rows_sql(L)})", PR.tenure_years)
    return O.roles_query(select, PR, (("all_hld", held),))


# ===========================================================================
# 2.1 Scans, sources, sinks
# ===========================================================================


@register("src_parquet_scan", RQ("SELECT * FROM r_policy"))
def src_parquet_scan(spark, sf):
    """Parquet scan through the policy contract (only its columns are read)."""
    from cohortkit.sources.fixtures import policy_cols, spark_dialect, table_rows
    n_cust = table_rows(spark, f"{sf}/customer.parquet")
    n_supp = table_rows(spark, f"{sf}/supplier.parquet")
    orders = read_parquet(spark, f"{sf}/orders.parquet")
    r_policy = orders.selectExpr(*[f"{e} AS `{n}`" for n, e in policy_cols(spark_dialect(n_cust, n_supp))])
    return conform(r_policy, "policy")


OLD_NEEDS_MONTH = "1998-12"


def _write_need_snapshots(spark, sf) -> str:
    """Two monthly snapshots of the existing-customer model as Hive-style ORC."""
    root = staging_path(spark, "need_orc")
    cur = need_struct_frame(spark, sf).withColumn("monthend_dt", F.lit(PR.needs_month))
    cust = spark.read.parquet(f"{sf}/customer.parquet").where("c_custkey % 4 = 0")
    old = cust.select(F.struct(F.col("c_custkey").alias("cli_num")).alias("row"),
                      F.lit(OLD_NEEDS_MONTH).alias("monthend_dt"))
    cur.write.partitionBy("monthend_dt").orc(root)
    # The older snapshot has a narrower struct: a file schema that drifted over time.
    old.write.mode("append").partitionBy("monthend_dt").orc(root)
    return root


@register("src_orc_snapshot", RQ(f"SELECT {O.q(PR.needs_month)} AS monthend_dt, cli_num FROM r_need"))
def src_orc_snapshot(spark, sf):
    root = _write_need_snapshots(spark, sf)
    snap = ORC.read_orc_snapshot(spark, root, "monthend_dt", PR.needs_month)
    return snap.select("monthend_dt", F.col("row.cli_num").alias("cli_num"))


@register("src_bucketed_roles", SQ("SELECT * FROM m_cohort"))
def src_bucketed_roles(spark, sf):
    """The cohort from coverage, policy and links stored bucketed by policy number."""
    prefix = f"roles_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(roles(spark, sf), prefix, buckets, staging_path(spark, prefix))
    return C.active_cohort(with_bucketed(spark, roles(spark, sf), prefix), PR)


@register("src_struct_unwrap", RQ("SELECT * FROM r_need"))
def src_struct_unwrap(spark, sf):
    root = _write_need_snapshots(spark, sf)
    return ORC.unwrap_struct(ORC.read_orc_snapshot(spark, root, "monthend_dt", PR.needs_month))


# Partition-family variants by month number: 0 → too few columns (gated out),
# 1 → columns in another order, 2 → one extra column, 3 → as is.
NEW_NEED_NARROW = ["po_num", "month", "ci_decile", "invst_decile", "lt_decile", "model_version"]


def _write_new_need_family(spark, sf) -> str:
    root = staging_path(spark, "new_need_parts")
    nn = roles(spark, sf).new_need
    variant = (F.substring("month", 6, 2).cast("int") % 4)
    full = nn.columns
    groups = {
        0: nn.where(variant == 0).select(*NEW_NEED_NARROW),
        1: nn.where(variant == 1).select(*reversed(full)),
        2: nn.where(variant == 2).withColumn("extra_note", F.lit("x")),
        3: nn.where(variant == 3),
    }
    for i, g in groups.items():
        # one directory per month; ``month`` stays a data column in the files
        (g.withColumn("part", F.col("month")).write.mode("append" if i else "overwrite")
         .partitionBy("part").orc(root))
    return root


_NEW_NEED_COLS = ("po_num, month, ci_decile, invst_decile, lt_decile, ci_hml, invst_hml, lt_hml, model_version")


@register("src_partition_union", RQ(
    f"SELECT {_NEW_NEED_COLS}, CASE WHEN CAST(SUBSTR(month, 6, 2) AS INTEGER) % 4 = 2 THEN 'x' END AS extra_note "
    "FROM r_new_need WHERE CAST(SUBSTR(month, 6, 2) AS INTEGER) % 4 <> 0"))
def src_partition_union(spark, sf):
    root = _write_new_need_family(spark, sf)
    df = ORC.read_partition_union(spark, root, "orc", min_columns=8)
    return df.select(*[c.strip() for c in _NEW_NEED_COLS.split(",")], "extra_note")


@register("src_partition_union_widened", RQ(
    "SELECT pol_num, 7::BIGINT AS n, CAST(pol_num % 1000 * 0.25 AS DECIMAL(14,4)) AS amount, CAST(pol_num % 90 AS DECIMAL(13,3)) AS fee, "
    "CAST(pol_iss_dt AS TIMESTAMP) AS issued FROM r_policy"))
def src_partition_union_widened(spark, sf):
    """Directories whose columns differ in type (integers, decimals, dates) and order; a third lacks a required name."""
    root = staging_path(spark, "widened")
    pol = roles(spark, sf).policy.select("pol_num", "pol_iss_dt")
    even = F.pmod(F.xxhash64("pol_num"), F.lit(2)) == 0
    amount, fee = F.col("pol_num") % 1000 * F.lit("0.25").cast("decimal(3,2)"), F.col("pol_num") % 90
    pol.where(even).select("pol_num", F.lit(7).alias("n"), amount.cast("decimal(10,2)").alias("amount"), fee.cast("int").alias("fee"),
                           F.col("pol_iss_dt").alias("issued")).write.orc(f"{root}/part=a")
    pol.where(~even).select(F.lit(7).cast("bigint").alias("n"), amount.cast("decimal(14,4)").alias("amount"),
                            F.col("pol_iss_dt").cast("timestamp").alias("issued"), fee.cast("decimal(5,3)").alias("fee"),
                            "pol_num").write.orc(f"{root}/part=b")
    pol.select("pol_num").write.orc(f"{root}/part=c")
    refused: list[str] = []
    df = ORC.read_partition_union(spark, root, required=["pol_num", "n"], refused=refused)
    if len(refused) != 1:
        raise ValueError(f"refused: {refused}")
    return df


@register("src_roles_orc", SQ(O.leads_sql(PR, "in_place")))
def src_roles_orc(spark, sf):
    """The published leads of a run whose parameters choose the ORC snapshot of the propensity model."""
    sources = dict(vars(roles(spark, sf)))
    sources["need"] = _write_need_snapshots(spark, sf)
    root = staging_path(spark, "new_need_full")
    sources["new_need"].withColumn("part", F.col("month")).write.partitionBy("part").orc(root)
    sources["new_need"] = root
    out = staging_path(spark, "leads_from_orc")
    run(spark, {r: sources[r] for r in RoleTables.role_names()}, PR, out)
    return PB.read_published(spark, out)


@register("set_union_all", RQ(
    "SELECT pol_num, cli_num FROM r_link WHERE link_typ = 'O' UNION ALL "
    "SELECT pol_num, cli_num FROM r_link WHERE link_typ = 'I'"))
def set_union_all(spark, sf):
    t = roles(spark, sf)
    owners = links_of(t.links, "O", "cli_num")
    insureds = links_of(t.links, "I", "cli_num").select("cli_num", "pol_num")  # other column order
    return owners.unionByName(insureds)


@register("snk_parquet_overwrite", None)
def snk_parquet_overwrite(spark, sf):
    """Write two months, re-write one; the other month must survive, none duplicated."""
    t = roles(spark, sf)
    path = staging_path(spark, "leads_out")
    prev = PR.with_(month_end=PR.month_end.replace(month=11, day=30))
    for p in (prev, PR, PR):
        PB.write_month(C.active_cohort(t, p, rank=None), path)
    return PB.read_published(spark, path)


@register("snk_empty_rerun", None)
def snk_empty_rerun(spark, sf):
    """Publish two months, then the second again without rows: it is cleared, the first stays."""
    t = roles(spark, sf)
    path = staging_path(spark, "leads_rerun")
    prev = PR.with_(month_end=PR.month_end.replace(month=11, day=30))
    for p in (prev, PR):
        PB.publish(spark, C.active_cohort(t, p, rank=None), path, p)
    empty = C.active_cohort(t, PR, rank=None).where("false")
    if PB.publish(spark, empty, path, PR) != 0:
        raise ValueError("the month was not cleared")
    return PB.read_published(spark, path)


@register("snk_row_count", SQ("SELECT COUNT(*) AS row_count FROM m_cohort"))
def snk_row_count(spark, sf):
    return PB.row_count(C.active_cohort(roles(spark, sf), PR, rank=None))


@register("snk_published_counts", SQ(
    "SELECT onb_mth_yr AS month, COUNT(*) AS rows, COUNT(*) FILTER (po_num IS NULL) AS null_keys FROM m_cohort GROUP BY ALL"))
def snk_published_counts(spark, sf):
    """What the write of a month counted, from its pointer: no second read of the rows."""
    path = staging_path(spark, "leads_counts")
    PB.publish(spark, C.active_cohort(roles(spark, sf), PR, rank=None), path, PR)
    found = [(v.month, v.rows, v.null_keys) for v in PB.published_versions(spark, path)]
    return spark.createDataFrame(found, "month string, rows long, null_keys long")


@register("agg_count_distinct_global", RQ("SELECT COUNT(DISTINCT cli_num) AS unique_cli_num_count FROM r_need"))
def agg_count_distinct_global(spark, sf):
    root = _write_need_snapshots(spark, sf)
    r_need = ORC.unwrap_struct(ORC.read_orc_snapshot(spark, root, "monthend_dt", PR.needs_month))
    return r_need.agg(F.countDistinct("cli_num").alias("unique_cli_num_count"))


@register("agg_count_distinct_grouped", RQ(
    "SELECT month, COUNT(DISTINCT po_num) AS unique_po_num_count FROM r_new_need "
    "WHERE CAST(SUBSTR(month, 6, 2) AS INTEGER) % 4 <> 0 GROUP BY month"))
def agg_count_distinct_grouped(spark, sf):
    root = _write_new_need_family(spark, sf)
    df = ORC.read_partition_union(spark, root, "orc", min_columns=8)
    return df.groupBy("month").agg(F.countDistinct("po_num").alias("unique_po_num_count"))


# ===========================================================================
# Run parameters and scalar functions
# ===========================================================================


@register("param_month_window", RQ(
    f"SELECT pol_num, {L.key} AS onb_mth_yr, {L.month_start} AS month_start, {ME} AS month_end, "
    f"{L.new_start} AS new_window_start, {L.rep_end} AS repurchase_end, {L.cutoff} AS recency_cutoff "
    f"FROM r_policy WHERE YEAR(pol_iss_dt) = {L.year} AND MONTH(pol_iss_dt) = {L.month}"))
def param_month_window(spark, sf):
    t = roles(spark, sf)
    r_policy = t.policy.where(in_month("pol_iss_dt", PR.month_start, PR.next_month_start))
    return r_policy.select(
        "pol_num", F.lit(PR.month_key).alias("onb_mth_yr"), F.lit(PR.month_start).alias("month_start"),
        F.lit(PR.month_end).alias("month_end"), F.lit(PR.new_window_start).alias("new_window_start"),
        F.lit(PR.repurchase_end).alias("repurchase_end"), F.lit(PR.recency_cutoff).alias("recency_cutoff"))


@register("scl_month_key", RQ(
    "SELECT pol_num, strftime(pol_iss_dt, '%Y%m') AS month_key, "
    "CONCAT(SUBSTR(CAST(pol_iss_dt AS VARCHAR), 1, 4), SUBSTR(CAST(pol_iss_dt AS VARCHAR), 6, 2)) AS month_key_text "
    "FROM r_policy"))
def scl_month_key(spark, sf):
    r_policy = roles(spark, sf).policy
    return r_policy.select("pol_num", month_key_of("pol_iss_dt").alias("month_key"),
                      month_key_from_text(F.col("pol_iss_dt").cast("string")).alias("month_key_text"))


@register("scl_month_arith", RQ(
    "SELECT pol_num, CAST(DATE_TRUNC('month', pol_iss_dt) AS DATE) AS month_start, "
    "CAST(pol_iss_dt + INTERVAL 2 MONTH AS DATE) AS plus_2m, "
    "CAST(DATE_TRUNC('month', pol_iss_dt) - INTERVAL 6 MONTH AS DATE) AS start_minus_6m, "
    "LAST_DAY(pol_iss_dt) AS month_last_day FROM r_policy"))
def scl_month_arith(spark, sf):
    r_policy = roles(spark, sf).policy
    start = F.trunc("pol_iss_dt", "month")
    return r_policy.select("pol_num", start.alias("month_start"), F.add_months("pol_iss_dt", 2).alias("plus_2m"),
                      F.add_months(start, -6).alias("start_minus_6m"),
                      F.last_day("pol_iss_dt").alias("month_last_day"))


@register("scl_to_date", (
    "SELECT o_orderkey AS pol_num, CAST(o_orderdate AS DATE) AS iss_dt, "
    "TRY_CAST(CASE WHEN o_orderkey % 11 = 0 THEN 'not-a-date' "
    "ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS DATE) AS iss_dt_from_text FROM orders"))
def scl_to_date(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    text = F.when(F.col("o_orderkey") % 11 == 0, F.lit("not-a-date")).otherwise(
        F.to_date("o_orderdate").cast("string"))
    return o.select(F.col("o_orderkey").alias("pol_num"), F.to_date("o_orderdate").alias("iss_dt"),
                    F.try_to_date(text).alias("iss_dt_from_text"))


@register("scl_tenure_years", RQ(
    f"SELECT pol_num, vers_num, plan_code, cvg_iss_dt, "
    f"CAST(FLOOR(DATEDIFF('day', cvg_iss_dt, {ME}) / 365.25) AS INTEGER) AS inforce_year FROM r_coverage"))
def scl_tenure_years(spark, sf):
    r_coverage = roles(spark, sf).coverage
    return r_coverage.select("pol_num", "vers_num", "plan_code", "cvg_iss_dt",
                      tenure_years(PR.month_end, "cvg_iss_dt").alias("inforce_year"))


# ===========================================================================
# 2.2 Projections
# ===========================================================================


@register("prj_rename", RQ(
    "SELECT cli_num AS po_num, cli_nm AS po_name, id_num AS po_id_num, sex_code AS po_sex_code, "
    "full_address AS po_full_addr, city AS customer_city FROM r_customer"))
def prj_rename(spark, sf):
    c = roles(spark, sf).customers
    return c.select("cli_num", "cli_nm", "id_num", "sex_code", "full_address", "city").withColumnsRenamed({
        "cli_num": "po_num", "cli_nm": "po_name", "id_num": "po_id_num", "sex_code": "po_sex_code",
        "full_address": "po_full_addr", "city": "customer_city"})


@register("prj_cast_truncate", RQ(
    "SELECT pol_num, vers_num, plan_code, CAST(TRUNC(cvg_prem) AS INTEGER) AS cvg_prem, "
    "CAST(TRUNC(-cvg_prem) AS INTEGER) AS neg_prem FROM r_coverage"))
def prj_cast_truncate(spark, sf):
    r_coverage = roles(spark, sf).coverage
    return r_coverage.select("pol_num", "vers_num", "plan_code", F.col("cvg_prem").cast("int").alias("cvg_prem"),
                      (-F.col("cvg_prem")).cast("int").alias("neg_prem"))


@register("prj_annualize", RQ(
    "SELECT r_coverage.pol_num, r_coverage.vers_num, r_coverage.plan_code, "
    f"{O.ape_sql('r_coverage.cvg_prem', 'r_policy.pmt_mode')} AS inforce_ape, "
    f"{O.ape_sql('r_coverage.cvg_prem', 'CASE WHEN r_policy.pmt_mode = 5 THEN 0 ELSE r_policy.pmt_mode END')} AS inforce_ape_zero_mode "
    "FROM r_coverage JOIN r_policy ON r_coverage.pol_num = r_policy.pol_num"))
def prj_annualize(spark, sf):
    t = roles(spark, sf)
    df = t.coverage.join(t.policy, "pol_num", "inner")
    zero_mode = F.when(F.col("pmt_mode") == 5, F.lit(0)).otherwise(F.col("pmt_mode"))
    return df.select("pol_num", "vers_num", "plan_code", annualized("cvg_prem", "pmt_mode").alias("inforce_ape"),
                     annualized("cvg_prem", zero_mode).alias("inforce_ape_zero_mode"))


@register("prj_typed_null", RQ(
    "SELECT pol_num, CAST(NULL AS VARCHAR) AS hml_propensity_grp, CAST(NULL AS INTEGER) AS offer_acc FROM r_policy"))
def prj_typed_null(spark, sf):
    r_policy = roles(spark, sf).policy
    return r_policy.select("pol_num", typed_null("string").alias("hml_propensity_grp"),
                      typed_null("int").alias("offer_acc"))


@register("prj_distinct_wide", RQ(
    "SELECT DISTINCT pol_num, vers_num, cvg_stat_cd, cvg_typ, cvg_reasn, cvg_iss_dt FROM r_coverage"))
def prj_distinct_wide(spark, sf):
    r_coverage = roles(spark, sf).coverage
    return r_coverage.select("pol_num", "vers_num", "cvg_stat_cd", "cvg_typ", "cvg_reasn", "cvg_iss_dt").distinct()


# ===========================================================================
# 2.3 Filters
# ===========================================================================


@register("flt_month_window", RQ(
    f"SELECT pol_num, pol_iss_dt FROM r_policy WHERE YEAR(pol_iss_dt) = {L.year} AND MONTH(pol_iss_dt) = {L.month}"))
def flt_month_window(spark, sf):
    r_policy = roles(spark, sf).policy
    return r_policy.where(in_month("pol_iss_dt", PR.month_start, PR.next_month_start)).select("pol_num", "pol_iss_dt")


@register("flt_code_membership", RQ(
    f"SELECT pol_num, pol_stat_cd FROM r_policy WHERE pol_stat_cd IN {O.in_list(PR.inforce_status)}"))
def flt_code_membership(spark, sf):
    r_policy = roles(spark, sf).policy
    return r_policy.where(F.col("pol_stat_cd").isin(*PR.inforce_status)).select("pol_num", "pol_stat_cd")


@register("flt_date_bound", RQ(f"SELECT pol_num, pol_iss_dt FROM r_policy WHERE pol_iss_dt <= {ME}"))
def flt_date_bound(spark, sf):
    r_policy = roles(spark, sf).policy
    return r_policy.where(F.col("pol_iss_dt") <= F.lit(PR.month_end)).select("pol_num", "pol_iss_dt")


@register("flt_date_between", RQ(
    f"SELECT pol_num, pol_iss_dt FROM r_policy WHERE pol_iss_dt BETWEEN {L.month_start} AND {L.rep_end}"))
def flt_date_between(spark, sf):
    r_policy = roles(spark, sf).policy
    return (r_policy.where(F.col("pol_iss_dt").between(F.lit(PR.month_start), F.lit(PR.repurchase_end)))
            .select("pol_num", "pol_iss_dt"))


@register("flt_recency_cutoff", RQ(
    f"SELECT tgt_cust_id, batch_start_date FROM r_target WHERE batch_start_date > {L.cutoff}"))
def flt_recency_cutoff(spark, sf):
    return FL.recent_targets(roles(spark, sf).targets, PR).select("tgt_cust_id", "batch_start_date")


@register("flt_prefix_like", RQ(
    "SELECT agt_code, loc_cd FROM r_agent_mart WHERE " + " OR ".join(f"loc_cd LIKE '{x}%'" for x in PR.dmtm_prefixes)))
def flt_prefix_like(spark, sf):
    am = roles(spark, sf).agent_mart
    cond = None
    for x in PR.dmtm_prefixes:
        c = F.col("loc_cd").startswith(x)
        cond = c if cond is None else cond | c
    return am.where(cond).select("agt_code", "loc_cd")


@register("flt_null_tests", RQ(
    "SELECT cli_num, mobl_phon_num, email_addr FROM r_customer WHERE mobl_phon_num IS NULL OR email_addr IS NOT NULL"))
def flt_null_tests(spark, sf):
    c = roles(spark, sf).customers
    return (c.where(F.col("mobl_phon_num").isNull() | F.col("email_addr").isNotNull())
            .select("cli_num", "mobl_phon_num", "email_addr"))


# ===========================================================================
# 2.4 Joins
# ===========================================================================


@register("join_semi_cohort", SQ(
    "SELECT pol_num, cli_num FROM r_link WHERE link_typ = 'O' AND cli_num IN "
    f"(SELECT DISTINCT po_num FROM m_cohort WHERE onb_mth_yr = {L.key})"))
def join_semi_cohort(spark, sf):
    t = roles(spark, sf)
    owners = C.cohort_owners(C.active_cohort(t, PR, rank=None)).withColumnRenamed("po_num", "cli_num")
    return links_of(t.links, "O", "cli_num").join(owners, "cli_num", "left_semi")


@register("join_role_alias", SQ("SELECT DISTINCT pol_num, po_num, ins_num FROM m_cohort"))
def join_role_alias(spark, sf):
    return C.active_cohort(roles(spark, sf), PR, rank=None).select("pol_num", "po_num", "ins_num").distinct()


@register("join_left_snapshot", RQ(
    "SELECT a.agt_code, r_scorecard.agent_tier, r_scorecard.agent_cluster FROM r_agent a LEFT JOIN r_scorecard ON r_scorecard.agt_code = a.agt_code "
    f"AND r_scorecard.monthend_dt = {O.q(PR.scorecard_month_end)}"))
def join_left_snapshot(spark, sf):
    t = roles(spark, sf)
    return t.agents.select("agt_code").join(D.scorecard_snapshot(t.scorecard, PR.scorecard_month_end),
                                            "agt_code", "left")


@register("join_left_then_filter", SQ(
    "SELECT DISTINCT ld.po_num, r_customer.cli_nm FROM m_cohort ld LEFT JOIN r_customer ON ld.po_num = r_customer.cli_num "
    "WHERE r_customer.cli_typ = 'Individual'"))
def join_left_then_filter(spark, sf):
    t = roles(spark, sf)
    owners = C.cohort_owners(C.active_cohort(t, PR, rank=None))
    pf = t.customers.where(F.col("cli_typ") == "Individual").select(F.col("cli_num").alias("po_num"), "cli_nm")
    return owners.join(pf, "po_num", "inner")


@register("join_computed_key", SQ(
    "SELECT ld.po_num, ld.pol_num, r_new_need.ci_decile, r_new_need.invst_decile, r_new_need.lt_decile "
    "FROM m_tagged ld LEFT JOIN r_new_need ON ld.po_num = r_new_need.po_num "
    "AND ld.onb_mth_yr = CONCAT(SUBSTR(r_new_need.month, 1, 4), SUBSTR(r_new_need.month, 6, 2))"))
def join_computed_key(spark, sf):
    st = stages(spark, sf)
    nn = S.new_model_month(roles(spark, sf).new_need, PR.month_key).select(
        "po_num", "ci_decile", "invst_decile", "lt_decile")
    return st.final.select("po_num", "pol_num").join(nn, "po_num", "left")


# ===========================================================================
# 2.5 Aggregations
# ===========================================================================


@register("agg_first_date", SQ("SELECT cli_num, frst_join_dt FROM m_first_join"))
def agg_first_date(spark, sf):
    return P.first_join_dates(roles(spark, sf), PR)


@register("agg_holdings", SQ('SELECT po_num, total_ape, pol_cnt, "10yr_pol_cnt" FROM m_holding_sum'))
def agg_holdings(spark, sf):
    t = roles(spark, sf)
    owners = _owners(t)
    return C.holdings_summary(C.holdings(t, PR, owners), PR)


@register("agg_collect_party_ids", SQ(
    "SELECT DISTINCT pol_num, UNNEST(dpdnt_id_list) AS id_num FROM m_party_sets"))
def agg_collect_party_ids(spark, sf):
    t = roles(spark, sf)
    cohort = C.active_cohort(t, PR, rank=None)
    return FL.party_ids(t, PR, policies=cohort.select("pol_num").distinct())


@register("agg_party_id_sets", SQ("SELECT pol_num, array_to_string(dpdnt_id_list, ',') AS dpdnt_ids FROM m_party_sets"))
def agg_party_id_sets(spark, sf):
    t = roles(spark, sf)
    cohort = C.active_cohort(t, PR, rank=None)
    pairs = FL.party_ids(t, PR, policies=cohort.select("pol_num").distinct())
    return FL.party_id_sets(pairs).select("pol_num", F.array_join("dpdnt_id_list", ",").alias("dpdnt_ids"))


# ===========================================================================
# 2.6 Windows and the cohort
# ===========================================================================


@register("win_dense_rank_contract", SQ(
    "SELECT DISTINCT po_num, pol_num, pol_iss_dt, purchase_order_base FROM m_cohort"))
def win_dense_rank_contract(spark, sf):
    df = C.active_cohort(roles(spark, sf), PR, rank="split")
    return df.select("po_num", "pol_num", "pol_iss_dt", "purchase_order_base").distinct()


@register("win_dense_rank_date", SQ("SELECT DISTINCT po_num, pol_iss_dt, purchase_order_base FROM m_holdings"))
def win_dense_rank_date(spark, sf):
    t = roles(spark, sf)
    owners = _owners(t)
    return C.holdings(t, PR, owners, rank="split").select("po_num", "pol_iss_dt", "purchase_order_base").distinct()


_FIRST_COLS = [c for c in C.COHORT_COLUMNS if c != "purchase_order_base"]


@register("cohort_first_contract", SQ(
    f"SELECT {', '.join(_FIRST_COLS)} FROM m_cohort "
    "WHERE purchase_order_base = 1 AND cvg_typ = 'B' AND cvg_reasn = 'O'"))
def cohort_first_contract(spark, sf):
    return C.first_contract(C.active_cohort(roles(spark, sf), PR, rank=None)).select(*_FIRST_COLS)


@register("cohort_active", SQ("SELECT * FROM m_cohort"))
def cohort_active(spark, sf):
    return C.active_cohort(roles(spark, sf), PR, rank="split")


def _before(months: int) -> RunParams:
    """The fixture run of some months earlier."""
    start = add_months(PR.month_start, -months)
    return PR.with_(month_end=last_day(start))


_MONTHS = [_before(2), _before(1), PR]
_MONTH_COHORTS = tuple((f"cohort_{p.month_key}", O.cohort_sql(p)) for p in _MONTHS)


@register("cohort_backfill", O.roles_query(" UNION ALL BY NAME ".join(f"SELECT * FROM {n}" for n, _ in _MONTH_COHORTS), PR, _MONTH_COHORTS))
def cohort_backfill(spark, sf):
    """The cohorts of three months from one scan of each table."""
    return BF.cohort_months(roles(spark, sf), _MONTHS)


def _month_totals(p: RunParams) -> str:
    held = O.held_rows_sql(O.Lit(p), f"EXISTS (FROM cohort_{p.month_key} k WHERE k.po_num = m.owner)")
    return f"SELECT '{p.month_key}' AS onb_mth_yr, x.* FROM ({O.holdings_sum_sql(f'({held})', p.tenure_years)}) x"


@register("holdings_backfill", O.roles_query(" UNION ALL BY NAME ".join(_month_totals(p) for p in _MONTHS), PR, _MONTH_COHORTS))
def holdings_backfill(spark, sf):
    """Holdings of each month's cohort owners up to that month's end, as running totals."""
    t = roles(spark, sf)
    owners = staged_broadcast(BF.cohort_months(t, _MONTHS, rank=None).select("po_num", "onb_mth_yr").distinct(), OWNER_MAX_ROWS, "table", "owners")
    return BF.holdings_months(t, _MONTHS, owners)


@register("agg_holdings_incremental", _all_hld_query('SELECT po_num, total_ape, pol_cnt, "10yr_pol_cnt" FROM all_hld'))
def agg_holdings_incremental(spark, sf):
    """Last month's holdings carried on: the earlier month had other statuses, pay modes, premiums, owners and coverages."""
    from dataclasses import replace
    t = roles(spark, sf)
    k = F.col("pol_num")
    was = replace(
        t, policy=t.policy.withColumn("pol_stat_cd", F.when(k % 7 == 0, F.lit("7")).when(k % 7 == 1, F.lit("1")).otherwise(F.col("pol_stat_cd")))
        .withColumn("pmt_mode", F.when(k % 11 == 0, 0).otherwise(F.col("pmt_mode"))),
        coverage=t.coverage.where(k % 13 != 0).withColumn("cvg_prem", F.when(k % 5 == 0, F.col("cvg_prem") + 1).otherwise(F.col("cvg_prem"))),
        links=t.links.withColumn("cli_num", F.when(k % 17 == 0, F.col("cli_num") + 1).otherwise(F.col("cli_num"))))
    first = BF.first_holdings(was, _before(1))
    first = BF.HoldingsState(*[materialize(getattr(first, f), "table", f"holdings_{f}") for f in ("digests", "policies", "totals")])
    return BF.next_holdings(t, PR, first)[0].totals.select("po_num", *BF.SUMMARY)


@register("holdings_all", SQ("SELECT * FROM m_holdings"))
def holdings_all(spark, sf):
    t = roles(spark, sf)
    owners = _owners(t)
    return C.holdings(t, PR, owners, rank="split")


# ===========================================================================
# 2.10 Classifications, bands, tiers
# ===========================================================================


@register("class_agent_relationship", RQ(
    f"SELECT x.pol_num, {O.relationship_sql('s.comp_prvd_num', 's.trmn_dt', 'x.agt_code', 'x.wa_cd_1, x.wa_cd_2')} AS cus_agt_rltnshp "
    "FROM r_policy x JOIN r_agent s USING (agt_code)"))
def class_agent_relationship(spark, sf):
    t = roles(spark, sf)
    sv_ag = t.agents.select(F.col("agt_code").alias("sa_code"), "comp_prvd_num", "trmn_dt")
    df = t.policy.join(sv_ag, t.policy.agt_code == sv_ag.sa_code, "inner")
    return df.select("pol_num", T.agent_relationship("comp_prvd_num", "trmn_dt", "agt_code", "wa_cd_1", "wa_cd_2")
                     .alias("cus_agt_rltnshp"))


@register("class_status_decode", RQ(
    "SELECT agt_code, CASE WHEN stat_cd = '01' THEN 'Active' WHEN stat_cd = '99' THEN 'Terminated' "
    "ELSE 'Unknown' END AS agt_status FROM r_agent"))
def class_status_decode(spark, sf):
    a = roles(spark, sf).agents
    return a.select("agt_code", T.status_decode("stat_cd").alias("agt_status"))


@register("class_city", RQ(
    f"SELECT cli_num, {O.city_sql('city')} AS cust_city_cat FROM r_customer"))
def class_city(spark, sf):
    c = roles(spark, sf).customers
    return c.select("cli_num", T.city_category("city").alias("cust_city_cat"))


@register("class_new_existing", SQ(
    f"SELECT cli_num, CASE WHEN frst_join_dt BETWEEN {L.new_start} AND {ME} THEN 'New' ELSE 'Existing' END "
    "AS cus_type FROM m_first_join"))
def class_new_existing(spark, sf):
    fj = P.first_join_dates(roles(spark, sf), PR)
    return fj.select("cli_num", T.new_or_existing("frst_join_dt", PR.new_window_start, PR.month_end).alias("cus_type"))


@register("scl_band_age", RQ(
    f"SELECT cli_num, cur_age, {O.band_sql('age', 'cur_age')} AS po_age_curr_grp FROM r_customer"))
def scl_band_age(spark, sf):
    c = roles(spark, sf).customers
    return c.select("cli_num", "cur_age", T.age_band("cur_age").alias("po_age_curr_grp"))


@register("scl_band_income", RQ(
    f"SELECT cli_num, mthly_incm, {O.band_sql('income', 'mthly_incm')} AS mthly_incm_cat "
    "FROM r_customer"))
def scl_band_income(spark, sf):
    c = roles(spark, sf).customers
    return c.select("cli_num", "mthly_incm", T.income_band("mthly_incm").alias("mthly_incm_cat"))


def _all_holdings(spark, sf) -> DataFrame:
    return C.holdings_summary(C.holdings(roles(spark, sf), PR, None), PR)


@register("scl_band_premium", _all_hld_query(
    f"SELECT po_num, total_ape, {O.band_sql('premium', 'total_ape')} AS total_ape_cat "
    "FROM all_hld"))
def scl_band_premium(spark, sf):
    return _all_holdings(spark, sf).select("po_num", "total_ape", T.premium_band("total_ape").alias("total_ape_cat"))


@register("scl_band_count", _all_hld_query(
    f"SELECT po_num, pol_cnt, {O.band_sql('policies', 'pol_cnt')} AS pol_cnt_cat "
    "FROM all_hld"))
def scl_band_count(spark, sf):
    return _all_holdings(spark, sf).select("po_num", "pol_cnt", T.policy_count_band("pol_cnt").alias("pol_cnt_cat"))


@register("tier_value", _all_hld_query(
    f"SELECT po_num, {O.band_sql('value', 'total_ape', chr(34) + '10yr_pol_cnt' + chr(34))}"
    " AS vip_cat FROM all_hld"))
def tier_value(spark, sf):
    return _all_holdings(spark, sf).select("po_num", T.value_tier("total_ape", "10yr_pol_cnt").alias("vip_cat"))


@register("tier_near", _all_hld_query(
    f"SELECT po_num, {O.band_sql('near', 'total_ape', chr(34) + '10yr_pol_cnt' + chr(34))}"
    " AS near_vip_cat FROM all_hld"))
def tier_near(spark, sf):
    return _all_holdings(spark, sf).select("po_num", T.near_tier("total_ape", "10yr_pol_cnt").alias("near_vip_cat"))


@register("tier_lead_segment", SQ("SELECT DISTINCT po_num, lead_segment FROM m_combined"))
def tier_lead_segment(spark, sf):
    return stages(spark, sf).combined.select("po_num", "lead_segment").distinct()


@register("scl_default_label", RQ(
    f"SELECT cli_num, COALESCE(r_lifestage.customer_segment, 'Undefined Segmentation') AS lifestage_segment "
    f"FROM r_customer LEFT JOIN r_lifestage ON r_customer.cli_num = r_lifestage.client_number AND r_lifestage.monthend_dt = {O.q(PR.lifestage_month)}"))
def scl_default_label(spark, sf):
    t = roles(spark, sf)
    ls = P.lifestage_snapshot(t.lifestage, PR.lifestage_month).withColumnRenamed("po_num", "cli_num")
    return t.customers.select("cli_num").join(ls, "cli_num", "left").select(
        "cli_num", F.coalesce("customer_segment", F.lit(R.LIFESTAGE_DEFAULT)).alias("lifestage_segment"))


@register("scl_tier_indicators", RQ(
    f"SELECT a.agt_code, {O.tier_flags_sql('sc.agent_tier')} FROM r_agent a "
    f"LEFT JOIN (FROM r_scorecard WHERE monthend_dt = {O.q(PR.scorecard_month_end)}) sc USING (agt_code)"))
def scl_tier_indicators(spark, sf):
    from cohortkit.functions.rules import lower_equals_flag
    t = roles(spark, sf)
    df = t.agents.select("agt_code").join(D.scorecard_snapshot(t.scorecard, PR.scorecard_month_end), "agt_code", "left")
    return df.select("agt_code", *[lower_equals_flag("agent_tier", v).alias(n) for n, v in R.TIER_INDICATORS])


@register("scl_if_null_condition", RQ(
    "SELECT cli_num, cur_age, CASE WHEN cur_age > 40 THEN 'Y' ELSE 'N' END AS over_40 FROM r_customer"))
def scl_if_null_condition(spark, sf):
    c = roles(spark, sf).customers
    return c.select("cli_num", "cur_age", yn(F.col("cur_age") > 40).alias("over_40"))


# ===========================================================================
# Dimensions and profile
# ===========================================================================


@register("dim_agent", SQ("SELECT * FROM m_agent_dim"))
def dim_agent(spark, sf):
    return D.agent_dimension(roles(spark, sf), PR)


def _last(rows: str, key: str, order: str) -> str:
    """One row for each key: the last by ``order``."""
    return f"(SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"


def _descending(*columns: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in columns)


_PLANTED = (("p_location", "SELECT * FROM r_location UNION ALL SELECT * REPLACE ('Old ' || city AS city) FROM r_location UNION ALL FROM r_location"),
            ("p_candidate", "SELECT * FROM r_candidate UNION ALL SELECT * REPLACE (NULL AS email_addr) FROM r_candidate"),
            ("p_scorecard", "SELECT * FROM r_scorecard UNION ALL SELECT * REPLACE ('2999-12-31' AS monthend_dt, 'later' AS agent_tier) "
             "FROM r_scorecard UNION ALL SELECT * REPLACE ('zz' AS agent_cluster) FROM r_scorecard"))


@register("dim_agent_asof", O.roles_query(
    f"SELECT a.agt_code, lo.city, lo.region, ca.email_addr, ca.id_num AS agt_id_num, sc.agent_tier, sc.agent_cluster, "
    f"hd.rh_name AS agent_rh, mg.loc_mrg AS mgr_cd FROM r_agent a "
    f"LEFT JOIN {_last('p_location', 'loc_code', _descending('city', 'region'))} lo ON lo.loc_code = a.loc_code "
    f"LEFT JOIN {_last('p_candidate', 'can_num', _descending('email_addr', 'id_num'))} ca ON ca.can_num = a.can_num "
    f"LEFT JOIN {_last(f'(FROM p_scorecard WHERE monthend_dt <= {O.q(PR.scorecard_month_end)})', 'agt_code', _descending('monthend_dt', 'agent_tier', 'agent_cluster'))} sc "
    "ON sc.agt_code = a.agt_code "
    f"LEFT JOIN {_last('r_head', 'loc_cd', _descending('rh_name'))} hd ON hd.loc_cd = a.loc_code "
    f"LEFT JOIN {_last('m_managers', 'loc_code', _descending('loc_mrg', 'mgr_nm'))} mg ON mg.loc_code = a.loc_code "
    f"WHERE a.comp_prvd_num IN {O.in_list(PR.servicing_channels)}", PR, _PLANTED))
def dim_agent_asof(spark, sf):
    """The agent dimension over right sides with planted duplicates and later snapshots: one row for each agent."""
    from dataclasses import replace
    t = roles(spark, sf)
    loc, can, sc = t.locations, t.candidates, t.scorecard
    planted = replace(
        t, locations=loc.unionByName(loc.withColumn("city", F.concat(F.lit("Old "), "city"))).unionByName(loc),
        candidates=can.unionByName(can.withColumn("email_addr", F.lit(None).cast("string"))),
        scorecard=sc.unionByName(sc.withColumn("monthend_dt", F.lit("2999-12-31")).withColumn("agent_tier", F.lit("later")))
        .unionByName(sc.withColumn("agent_cluster", F.lit("zz"))))
    return D.agent_dimension(planted, PR, unique=True).select(
        "agt_code", "city", "region", "email_addr", "agt_id_num", "agent_tier", "agent_cluster", "agent_rh", "mgr_cd")


@register("dim_agent_manager", RQ(
    "FROM m_managers"))
def dim_agent_manager(spark, sf):
    t = roles(spark, sf)
    return D.location_managers(t.structure, t.agents)


@register("profile_customer", SQ("SELECT * FROM m_profile"))
def profile_customer(spark, sf):
    return stages(spark, sf).profile


# ===========================================================================
# 2.10 Flags
# ===========================================================================


@register("flag_reachability", RQ(
    "SELECT cli_num, CASE WHEN mobl_phon_num IS NOT NULL THEN 'Y' ELSE 'N' END AS mobile_ind, "
    "CASE WHEN email_addr IS NOT NULL THEN 'Y' ELSE 'N' END AS email_ind FROM r_customer"))
def flag_reachability(spark, sf):
    c = roles(spark, sf).customers
    return c.select("cli_num", present_flag("mobl_phon_num").alias("mobile_ind"),
                    present_flag("email_addr").alias("email_ind"))


def _combined_flag(cols: list[str]) -> str:
    return SQ(f"SELECT DISTINCT po_num, pol_num, {', '.join(cols)} FROM m_combined")


def _flag_query(spark, sf, cols):
    return stages(spark, sf).combined.select("po_num", "pol_num", *cols).distinct()


@register("flag_recent_contact", _combined_flag(["in_onb_po", "in_onb"]))
def flag_recent_contact(spark, sf):
    return _flag_query(spark, sf, ["in_onb_po", "in_onb"])


@register("flag_recent_contact_insured", _combined_flag(["in_onb_ins"]))
def flag_recent_contact_insured(spark, sf):
    return _flag_query(spark, sf, ["in_onb_ins"])


@register("flag_recent_contact_insured_by_client",
          O.stage_query("SELECT DISTINCT po_num, pol_num, in_onb_ins, in_onb FROM m_combined",
                        PR, insured_link_key="cli_num"))
def flag_recent_contact_insured_by_client(spark, sf):
    st = build_stages(roles(spark, sf), PR, insured_keys=("tgt_cust_id", "cli_num"))
    return st.combined.select("po_num", "pol_num", "in_onb_ins", "in_onb").distinct()


#: Of a customer's batches those of one month in six, so that the cut-off decides (all of them old, or all recent).
_ONE_MONTH = "(MONTH(batch_start_date) + 4) % 6 = CAST(tgt_cust_id AS BIGINT) % 6"
_RECENT = f"t.batch_start_date > {O.Lit(PR).cutoff}"


@register("flag_recent_contact_cutoff", O.roles_query(
    f"SELECT *, IF('Y' IN (in_onb_po, in_onb_ins), 'Y', 'N') AS in_onb FROM (SELECT c.cli_num AS po_num, "
    "EXISTS (FROM p_target t WHERE t.tgt_cust_id = c.cli_num) AS targeted, "
    f"IF(EXISTS (FROM p_target t WHERE t.tgt_cust_id = c.cli_num AND {_RECENT}), 'Y', 'N') AS in_onb_po, "
    f"IF(EXISTS (FROM p_target t JOIN r_link i ON i.pol_num = t.tgt_cust_id WHERE i.link_typ = 'I' AND i.cli_num = c.cli_num "
    f"AND {_RECENT}), 'Y', 'N') AS in_onb_ins FROM r_customer c)", PR,
    (("p_target", f"SELECT * FROM r_target WHERE {_ONE_MONTH}"),)))
def flag_recent_contact_cutoff(spark, sf):
    """Contact flags of every customer over targets whose batches are all old or all recent."""
    from dataclasses import replace
    t = roles(spark, sf)
    planted = replace(t, targets=t.targets.where(_ONE_MONTH))
    flags = FL.owner_flags(planted, PR)
    ever = planted.targets.select(F.col("tgt_cust_id").alias("po_num")).distinct().withColumn("targeted", F.lit(True))
    return (t.customers.select(F.col("cli_num").alias("po_num")).join(ever, "po_num", "left").join(flags, "po_num", "left")
            .select("po_num", F.coalesce("targeted", F.lit(False)).alias("targeted"),
                    *[F.coalesce(F.col(c), F.lit("N")).alias(c) for c in ("in_onb_po", "in_onb_ins", "in_onb")]))


@register("flag_channel_overlap", _combined_flag(["in_banca"]))
def flag_channel_overlap(spark, sf):
    return _flag_query(spark, sf, ["in_banca"])


@register("flag_channel_prefix", _combined_flag(["in_dmtm"]))
def flag_channel_prefix(spark, sf):
    return _flag_query(spark, sf, ["in_dmtm"])


@register("flag_related_party", _combined_flag(["sagt_cd", "sagt_id_num", "sagt_rltv"]))
def flag_related_party(spark, sf):
    return _flag_query(spark, sf, ["sagt_cd", "sagt_id_num", "sagt_rltv"])


@register("flag_repurchase", _combined_flag(["pol_iss_dt", "repurchased"]))
def flag_repurchase(spark, sf):
    return _flag_query(spark, sf, ["pol_iss_dt", "repurchased"])


@register("flag_unassigned", SQ(
    "SELECT DISTINCT pol_num, cus_agt_rltnshp, CASE WHEN cus_agt_rltnshp IN "
    "('Original Agent', 'Reassigned Agent') THEN 'N' ELSE 'Y' END AS unassigned FROM m_cohort"))
def flag_unassigned(spark, sf):
    cohort = C.active_cohort(roles(spark, sf), PR, rank=None)
    return cohort.select("pol_num", "cus_agt_rltnshp", FL.unassigned_flag().alias("unassigned")).distinct()


# ===========================================================================
# Combine, exclusions
# ===========================================================================


@register("combine_profile", SQ("SELECT * FROM m_combined"))
def combine_profile(spark, sf):
    return stages(spark, sf).combined


@register("excl_any", SQ(
    "SELECT po_num, pol_num, plan_code, vers_num, insrd_num, " + ", ".join(R.EXCLUSION_FLAGS)
    + ", excluded FROM m_tagged"))
def excl_any(spark, sf):
    return stages(spark, sf).final.select("po_num", "pol_num", "plan_code", "vers_num", "insrd_num",
                                          *R.EXCLUSION_FLAGS, "excluded")


@register("excl_reason_priority", SQ(
    "SELECT po_num, pol_num, plan_code, vers_num, insrd_num, excluded, excluded_grp FROM m_tagged"))
def excl_reason_priority(spark, sf):
    return stages(spark, sf).final.select("po_num", "pol_num", "plan_code", "vers_num", "insrd_num",
                                          "excluded", "excluded_grp")


@register("stage_tagged_leads", SQ("SELECT * FROM m_tagged"))
def stage_tagged_leads(spark, sf):
    return stages(spark, sf).final


# ===========================================================================
# Scoring and publish
# ===========================================================================


@register("score_least_decile", RQ(
    "SELECT cli_num, LEAST(decile_ci, decile_inv, decile_lt, decile_lp, decile_med) AS least_decile, "
    "CASE WHEN LEAST(decile_ci, decile_inv, decile_lt, decile_lp, decile_med) BETWEEN 1 AND 2 THEN 1 ELSE 0 END "
    "AS top2, CASE WHEN LEAST(decile_ci, decile_inv, decile_lt, decile_lp, decile_med) BETWEEN 1 AND 3 "
    "THEN 1 ELSE 0 END AS top3 FROM r_need"))
def score_least_decile(spark, sf):
    r_need = roles(spark, sf).need
    return r_need.select(
        "cli_num", F.least(*[F.col(c) for c in R.EXISTING_HIT_DECILES]).alias("least_decile"),
        F.when(least_in(R.EXISTING_HIT_DECILES, *R.TOP2), 1).otherwise(0).alias("top2"),
        F.when(least_in(R.EXISTING_HIT_DECILES, *R.TOP3), 1).otherwise(0).alias("top3"))


def _score_sql(cols: list[str]) -> str:
    return SQ(f"SELECT po_num, pol_num, {', '.join(cols)} FROM m_scored")


def _score_query(spark, sf, cols):
    return stages(spark, sf).scoring.select("po_num", "pol_num", *cols)


@register("score_existing_model", _score_sql(["decile_ci", "decile_inv", "decile_lt", "decile_lp", "decile_med",
                                              "top2_hp_model", "hp_model"]))
def score_existing_model(spark, sf):
    return _score_query(spark, sf, ["decile_ci", "decile_inv", "decile_lt", "decile_lp", "decile_med",
                                    "top2_hp_model", "hp_model"])


@register("score_new_model", _score_sql(["hp_rules"]))
def score_new_model(spark, sf):
    return _score_query(spark, sf, ["hp_rules"])


@register("score_offer_flags", _score_sql(["offer_acc", "offer_ci", "offer_edu", "offer_inv", "offer_term",
                                           "offer_ul", "offer_lt"]))
def score_offer_flags(spark, sf):
    return _score_query(spark, sf, ["offer_acc", "offer_ci", "offer_edu", "offer_inv", "offer_term",
                                    "offer_ul", "offer_lt"])


@register("score_final_segment", SQ("SELECT * FROM m_scored"))
def score_final_segment(spark, sf):
    return stages(spark, sf).scoring


@register("publish_segment", SQ(
    "SELECT po_num, pol_num, insrd_num, plan_code, vers_num, lead_segment, high_prop_model, high_prop_rules FROM ("
    + O.leads_sql(PR, "in_place") + ")"))
def publish_segment(spark, sf):
    return stages(spark, sf).leads.select("po_num", "pol_num", "insrd_num", "plan_code", "vers_num",
                                          "lead_segment", "high_prop_model", "high_prop_rules")


@register("publish_leads", SQ(O.leads_sql(PR, "in_place")))
def publish_leads(spark, sf):
    return stages(spark, sf).leads


@register("publish_leads_rejoin", SQ(O.leads_sql(PR, "rejoin")))
def publish_leads_rejoin(spark, sf):
    return stages(spark, sf, mode="rejoin").leads


# ===========================================================================
# Data quality (uniqueness of joined dimensions, owners dropped)
# ===========================================================================

def _dup(name: str, sql_from: str, key: str) -> str:
    return (f"SELECT {O.q(name)} AS \"check\", COUNT(*) AS value FROM "
            f"(SELECT {key} FROM {sql_from} GROUP BY {key} HAVING COUNT(*) > 1)")


_DQ_DIMS = " UNION ALL ".join([
    _dup("candidates:can_num", "r_candidate", "can_num"),
    _dup("locations:loc_code", "r_location", "loc_code"),
    _dup("regional_heads:loc_cd", "r_head", "loc_cd"),
    _dup("scorecard:agt_code@snapshot", f"(SELECT * FROM r_scorecard WHERE monthend_dt = {O.q(PR.scorecard_month_end)})",
         "agt_code"),
    _dup("managers:loc_code", "m_managers", "loc_code"),
    _dup("lifestage:client_number@snapshot",
         f"(SELECT * FROM r_lifestage WHERE monthend_dt = {O.q(PR.lifestage_month)})", "client_number"),
    _dup("agent_mart:agt_code", "r_agent_mart", "agt_code"),
    _dup("need:cli_num", "r_need", "cli_num"),
    _dup("new_need:po_num@month", f"(SELECT * FROM r_new_need WHERE CONCAT(SUBSTR(month, 1, 4), SUBSTR(month, 6, 2)) "
         f"= {L.key})", "po_num"),
])


@register("dq_dimension_keys", RQ(_DQ_DIMS))
def dq_dimension_keys(spark, sf):
    from cohortkit.operators.quality import dimension_key_report
    return dimension_key_report(roles(spark, sf), PR)


@register("dq_dropped_rows", SQ(f"""
SELECT CASE WHEN x.pol_num IS NULL THEN 'no policy'
            WHEN YEAR(x.pol_iss_dt) <> {L.year} OR MONTH(x.pol_iss_dt) <> {L.month} THEN 'issued outside the month'
            WHEN x.pol_stat_cd NOT IN {O.in_list(PR.inforce_status)} THEN 'not in force'
            WHEN NOT EXISTS (FROM r_agent w WHERE w.agt_code = x.wa_cd_1 AND w.comp_prvd_num IN {O.in_list(PR.writing_channels)})
              THEN 'writing agent does not qualify'
            WHEN NOT EXISTS (FROM r_agent s WHERE s.agt_code = x.agt_code AND s.comp_prvd_num IN {O.in_list(PR.servicing_channels)})
              THEN 'servicing agent does not qualify'
            WHEN NOT EXISTS (FROM r_link k WHERE k.pol_num = c.pol_num AND k.link_typ = 'O') THEN 'no owner'
            WHEN NOT EXISTS (FROM r_link k WHERE k.pol_num = c.pol_num AND k.link_typ = 'I') THEN 'no insured'
            WHEN NOT EXISTS (FROM m_cohort k WHERE k.pol_num = c.pol_num AND k.purchase_order_base = 1) THEN 'not the first contract of an owner'
            WHEN NOT (c.cvg_typ = 'B' AND c.cvg_reasn = 'O') THEN 'not a base coverage'
            WHEN NOT EXISTS (FROM m_cohort k JOIN r_customer u ON u.cli_num = k.po_num AND u.cli_typ = 'Individual'
                             WHERE k.pol_num = c.pol_num AND k.purchase_order_base = 1) THEN 'first owner is no individual customer'
            ELSE 'kept' END AS reason, COUNT(*) AS coverages
FROM r_coverage c LEFT JOIN r_policy x USING (pol_num) GROUP BY ALL"""))
def dq_dropped_rows(spark, sf):
    """Where the coverage rows of a run go: the first reason of each for leaving, or kept."""
    from cohortkit.operators.quality import dropped_row_ledger
    return dropped_row_ledger(roles(spark, sf), PR)


@register("dq_dropped_owners", SQ(
    "SELECT 'cohort_owners' AS \"check\", COUNT(DISTINCT po_num) AS value FROM m_cohort UNION ALL "
    "SELECT 'owners_without_individual_profile', COUNT(*) FROM (SELECT DISTINCT po_num FROM m_cohort) o "
    "WHERE NOT EXISTS (SELECT 1 FROM r_customer WHERE r_customer.cli_num = o.po_num AND r_customer.cli_typ = 'Individual')"))
def dq_dropped_owners(spark, sf):
    from cohortkit.operators.quality import dropped_owner_report
    t = roles(spark, sf)
    return dropped_owner_report(t, C.cohort_owners(C.active_cohort(t, PR, rank=None)))


def _two_month_oracle() -> str:
    prev = PR.with_(month_end=PR.month_end.replace(month=11, day=30))
    return O.roles_query("SELECT * EXCLUDE (purchase_order_base) FROM prev_cohort UNION ALL BY NAME "
                         "SELECT * EXCLUDE (purchase_order_base) FROM cur_cohort", PR,
                         (("prev_cohort", O.cohort_sql(prev)), ("cur_cohort", O.cohort_sql(PR))))


_ORACLES["snk_parquet_overwrite"] = _two_month_oracle()
_ORACLES["snk_empty_rerun"] = O.roles_query(
    "SELECT * EXCLUDE (purchase_order_base) FROM prev_cohort", PR,
    (("prev_cohort", O.cohort_sql(PR.with_(month_end=PR.month_end.replace(month=11, day=30)))),))
