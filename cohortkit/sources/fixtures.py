"""Test-table adapter: derive every role table from the synthetic star schema.

The synthetic tables (customer, orders, lineitem, supplier, nation, region,
events) stand in for the contract, coverage, party-link, agent and customer
tables.  Each role is a projection (plus, for two roles, a small aggregate) of
one synthetic table, written as SQL expressions with integer arithmetic only,
so the same text runs on Spark (``selectExpr``) and on DuckDB (the oracle).
``Dialect`` supplies the few functions whose spelling differs.

All derived work runs on Spark and grows with the input tables.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.params import RunParams
from cohortkit.sources.tables import RoleTables

# Fixture run parameters: the synthetic orders span 1995-01 … 2001-08 and the
# events January 2024, so the cohort month and run date are chosen inside them.
FIXTURE_PARAMS = RunParams(
    month_end=dt.date(1998, 12, 31),
    scorecard_month_end="1999-01-31",
    lifestage_month="1999-01",
    needs_month="1999-01",
    run_date=dt.date(2024, 2, 15),
    tenure_years=3,
)
SMOKE_PARAMS = FIXTURE_PARAMS.with_(month_end=dt.date(1995, 7, 31))

OTHER_SCORECARD_MONTH = "1998-12-31"
OTHER_LIFESTAGE_MONTH = "1998-12"


@dataclass(frozen=True)
class Dialect:
    name: str
    n_customers: str
    n_suppliers: str

    def date_add(self, d: str, n: str) -> str:
        if self.name == "spark":
            return f"date_add({d}, CAST({n} AS INT))"
        return f"CAST({d} + CAST({n} AS INTEGER) AS DATE)"

    def add_months(self, d: str, n: str) -> str:
        if self.name == "spark":
            return f"add_months({d}, CAST({n} AS INT))"
        return f"CAST({d} + to_months(CAST({n} AS INTEGER)) AS DATE)"

    def month_text(self, ts: str) -> str:
        if self.name == "spark":
            return f"date_format({ts}, 'yyyy-MM')"
        return f"strftime({ts}, '%Y-%m')"


def spark_dialect(n_customers: int, n_suppliers: int) -> Dialect:
    return Dialect("spark", str(int(n_customers)), str(int(n_suppliers)))


DUCKDB = Dialect("duckdb", "(SELECT COUNT(*) FROM customer)", "(SELECT COUNT(*) FROM supplier)")


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


# ---------------------------------------------------------------------------
# Role projections: (source table, [(column, expression)], optional WHERE).
# ---------------------------------------------------------------------------

def policy_cols(d: Dialect) -> list[tuple[str, str]]:
    S = d.n_suppliers
    iss = "CAST(o_orderdate AS DATE)"
    return [
        ("pol_num", "o_orderkey"),
        ("pmt_mode", "CAST(SUBSTR(o_orderpriority, 1, 1) AS INT)"),
        ("pol_iss_dt", iss),
        ("frst_iss_dt", f"CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE {d.date_add(iss, '-(o_orderkey % 20)')} END"),
        ("pol_eff_dt", f"CASE WHEN o_orderkey % 2 = 0 THEN {d.date_add(iss, '3')} ELSE NULL END"),
        ("pol_stat_cd", "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'P' THEN '3' ELSE '7' END"),
        ("wa_cd_1", f"o_orderkey % {S}"),
        ("wa_cd_2", f"CASE WHEN o_orderkey % 4 = 1 THEN (o_orderkey + 3) % {S} ELSE NULL END"),
        ("agt_code", f"(o_orderkey + (o_custkey % 2) * 3) % {S}"),
    ]


def coverage_cols(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("pol_num", "l_orderkey"),
        ("plan_code", "l_partkey"),
        ("vers_num", "l_linenumber"),
        ("cvg_stat_cd", "l_returnflag"),
        ("cvg_typ", "CASE WHEN l_linestatus = 'O' THEN 'B' ELSE 'R' END"),
        ("cvg_reasn", "CASE WHEN l_linenumber % 4 = 0 THEN 'X' ELSE 'O' END"),
        ("cvg_prem", "CAST(CAST(FLOOR(l_extendedprice) AS BIGINT) * 0.01 AS DECIMAL(18,2))"),
        ("cvg_iss_dt", "CAST(l_shipdate AS DATE)"),
    ]


# Party links per order: (cli_num expression, link type, condition or None).
def link_branches(d: Dialect) -> list[tuple[str, str, str | None]]:
    N = d.n_customers
    return [
        ("o_custkey", "O", None),
        (f"(o_custkey + o_orderkey % 3) % {N}", "I", None),
        (f"(o_custkey + o_orderkey % 3 + 1) % {N}", "I", "o_orderkey % 5 = 0"),
        (f"(o_custkey + 7) % {N}", "T", None),
        (f"(o_custkey + 11) % {N}", "B", None),
        (f"(o_custkey + 13) % {N}", "P", "o_orderkey % 3 = 0"),
    ]


def agent_cols(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("agt_code", "s_suppkey"),
        ("agt_nm", "s_name"),
        ("cntrct_eff_dt", d.date_add("DATE '1990-01-01'", "s_suppkey % 365")),
        ("trmn_dt", "CASE WHEN s_suppkey % 7 = 0 THEN DATE '1999-06-30' ELSE NULL END"),
        ("stat_cd", "CASE WHEN s_suppkey % 7 = 0 THEN '99' WHEN s_suppkey % 11 = 0 THEN '05' ELSE '01' END"),
        ("comp_prvd_num", "CASE s_suppkey % 5 WHEN 0 THEN '01' WHEN 1 THEN '04' WHEN 2 THEN '97' "
                          "WHEN 3 THEN '98' ELSE '02' END"),
        ("loc_code", "s_nationkey"),
        ("mobl_phon_num", f"CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE '09' || {_s('s_suppkey')} END"),
        ("can_num", "s_suppkey"),
    ]


def candidate_cols(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("can_num", "s_suppkey"),
        ("email_addr", f"'agent' || {_s('s_suppkey')} || '@example.com'"),
        ("id_num", f"'ID' || {_s('s_suppkey % ' + str(ID_SPACE))}"),
    ]


CANDIDATE_WHERE = "s_suppkey % 10 <> 9"
# Party and agent ID numbers share a small ID space, so an agent is sometimes
# one of the parties of a policy it services (the related-party exclusion).
ID_SPACE = 50


def tier_expr(shift: int) -> str:
    k = f"(s_suppkey + {shift}) % 6"
    return (f"CASE {k} WHEN 0 THEN 'MDRT' WHEN 1 THEN 'fc' WHEN 2 THEN '1MAA' "
            f"WHEN 3 THEN '3maa' WHEN 4 THEN 'Standard' ELSE NULL END")


def scorecard_branches(params: RunParams) -> list[tuple[str, int]]:
    return [(params.scorecard_month_end, 0), (OTHER_SCORECARD_MONTH, 1)]


def customer_cols(d: Dialect) -> list[tuple[str, str]]:
    key = _s("c_custkey")
    return [
        ("cli_num", "c_custkey"),
        ("cli_nm", "c_name"),
        ("id_num", key),
        ("sex_code", "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END"),
        ("birth_dt", d.date_add("DATE '1950-01-01'", "c_custkey % 18000")),
        ("cur_age", "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(10 + c_custkey % 70 AS INT) END"),
        ("prim_phon_num", f"'08' || {key}"),
        ("mobl_phon_num", f"CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE '09' || {key} END"),
        ("othr_phon_num", "CAST(NULL AS STRING)"),
        ("sms_ind", "CASE WHEN c_custkey % 3 = 0 THEN 'N' ELSE 'Y' END"),
        ("email_addr", f"CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'c' || {key} || '@example.com' END"),
        ("sms_eservice_ind", "CASE WHEN c_custkey % 4 = 0 THEN 'N' ELSE 'Y' END"),
        ("full_address", f"'Street ' || {key}"),
        ("city", "CASE c_nationkey % 5 WHEN 0 THEN 'Hà Nội' WHEN 1 THEN 'Hồ Chí Minh' WHEN 2 THEN NULL "
                 f"ELSE 'City ' || {_s('c_nationkey')} END"),
        ("no_dpnd", "CAST(c_custkey % 4 AS INT)"),
        ("occp_code", f"'OC' || {_s('c_custkey % 9')}"),
        ("mthly_incm", "CAST(CAST(FLOOR(c_acctbal) AS BIGINT) * 10 AS DECIMAL(18,2))"),
        ("cli_typ", "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Corporate' ELSE 'Individual' END"),
    ]


def lifestage_branches(params: RunParams) -> list[tuple[str, str, str]]:
    """(month text, segment expression, condition) per snapshot."""
    return [
        (params.lifestage_month, "c_mktsegment", "c_custkey % 2 = 0"),
        (OTHER_LIFESTAGE_MONTH, "'OLD ' || c_mktsegment", "c_custkey % 3 = 0"),
    ]


def client_detail_cols(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("cli_num", "c_custkey"),
        ("id_num", f"CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'ID' || {_s('c_custkey % ' + str(ID_SPACE))} END"),
    ]


def policy_mart_cols(d: Dialect) -> list[tuple[str, str]]:
    S = d.n_suppliers
    return [
        ("po_num", "o_custkey"),
        ("wa_code", f"o_orderkey % {S}"),
        ("sa_code", f"(o_orderkey + (o_custkey % 2) * 3) % {S}"),
    ]


def agent_mart_cols(d: Dialect) -> list[tuple[str, str]]:
    n = _s("s_nationkey")
    return [
        ("agt_code", "s_suppkey"),
        ("channel", "CASE WHEN s_suppkey % 97 = 5 THEN 'Banca' ELSE 'Agency' END"),
        ("loc_cd", f"CASE WHEN s_suppkey % 97 = 7 THEN 'DMO' || {n} WHEN s_suppkey % 97 = 9 THEN 'FPC' || {n} "
                   f"WHEN s_suppkey % 10 = 3 THEN NULL ELSE 'AGY' || {n} END"),
    ]


def target_cols(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("tgt_cust_id", "user_id"),
        ("batch_start_date", d.add_months("CAST(ts AS DATE)", "-(event_id % 6)")),
    ]


def _hml(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 3 THEN 'H' WHEN {x} <= 7 THEN 'M' ELSE 'L' END"


def _decile(key: str, p: int) -> str:
    return f"CAST(1 + ({key} * {p}) % 10 AS INT)"


# Existing-customer model fields (built from customer rows).
def need_fields(d: Dialect) -> list[tuple[str, str]]:
    k = "c_custkey"
    dec = {
        "decile_acc": _decile(k, 3),
        "decile_ci": _decile(k, 7),
        "decile_med": _decile(k, 11),
        "decile_inv": _decile(k, 13),
        "decile_lp": f"CASE WHEN {k} % 7 = 0 THEN NULL ELSE {_decile(k, 17)} END",
        "decile_lt": _decile(k, 19),
    }
    out = [("cli_num", k)] + list(dec.items())
    for name in ("acc", "ci", "med", "inv", "lp", "lt"):
        out.append((f"hml_{name}", _hml(dec[f"decile_{name}"])))
    return out


NEED_WHERE = "c_custkey % 4 <> 0"


# New-customer model: one row per (owner, month) from the month's first order.
def new_need_group(d: Dialect) -> tuple[list[tuple[str, str]], list[str]]:
    """(pre-aggregation projection, group keys)."""
    return [("po_num", "o_custkey"), ("month", d.month_text("o_orderdate")), ("k", "o_orderkey")], ["po_num", "month"]


def new_need_cols(d: Dialect) -> list[tuple[str, str]]:
    k = "k"
    ci, inv, lt = _decile(k, 3), f"CASE WHEN {k} % 7 = 0 THEN NULL ELSE {_decile(k, 7)} END", _decile(k, 11)
    return [
        ("po_num", "po_num"),
        ("month", "month"),
        ("ci_decile", ci),
        ("invst_decile", inv),
        ("lt_decile", lt),
        ("ci_hml", _hml(ci)),
        ("invst_hml", _hml(inv)),
        ("lt_hml", _hml(lt)),
        ("model_version", "'v1'"),
    ]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def _sel(df: DataFrame, cols: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS `{n}`" for n, e in cols])


def _struct_array(branches: list[str]) -> str:
    return "array(" + ", ".join(branches) + ")"


_COUNTS: dict[tuple, int] = {}


def table_rows(spark: SparkSession, path: str) -> int:
    """Row count of a Parquet table, memoised per (path, modification time)."""
    try:
        stamp = os.stat(path).st_mtime_ns
    except OSError:
        stamp = None
    key = (path, stamp)
    if key not in _COUNTS or stamp is None:
        _COUNTS[key] = spark.read.parquet(path).count()
    return _COUNTS[key]


_ROLE_CACHE: dict[tuple, RoleTables] = {}
_SOURCES = ("customer", "orders", "lineitem", "supplier", "nation", "region", "events")


def build_fixture_tables(spark: SparkSession, sf_dir: str, params: RunParams = FIXTURE_PARAMS) -> RoleTables:
    """All role tables (lazy plans), memoised per session, folder, parameters and file stamps."""
    stamps = []
    for t in _SOURCES:
        try:
            stamps.append(os.stat(f"{sf_dir}/{t}.parquet").st_mtime_ns)
        except OSError:
            stamps.append(None)
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, params, tuple(stamps))
    if key not in _ROLE_CACHE:
        _ROLE_CACHE[key] = _build_fixture_tables(spark, sf_dir, params)
    return _ROLE_CACHE[key]


def _build_fixture_tables(spark: SparkSession, sf_dir: str, params: RunParams) -> RoleTables:
    rd = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    customer, orders, lineitem = rd("customer"), rd("orders"), rd("lineitem")
    supplier, nation, region, events = rd("supplier"), rd("nation"), rd("region"), rd("events")
    # Two scalars of the mapping (table cardinalities; Parquet footers answer them).
    d = spark_dialect(table_rows(spark, f"{sf_dir}/customer.parquet"),
                      table_rows(spark, f"{sf_dir}/supplier.parquet"))

    # Links: one scan of orders, one output row per party via inline(array(struct)).
    link_structs = []
    for cli, typ, cond in link_branches(d):
        cli_e = cli if cond is None else f"CASE WHEN {cond} THEN {cli} END"
        link_structs.append(f"named_struct('pol_num', o_orderkey, 'cli_num', {cli_e}, 'link_typ', '{typ}')")
    links = (orders.selectExpr(f"inline({_struct_array(link_structs)})")
             .where(F.col("cli_num").isNotNull()))

    sc_structs = [
        f"named_struct('agt_code', s_suppkey, 'monthend_dt', '{m}', 'agent_tier', {tier_expr(shift)}, "
        f"'agent_cluster', 'C' || {_s('s_suppkey % 3')})"
        for m, shift in scorecard_branches(params)
    ]
    scorecard = supplier.selectExpr(f"inline({_struct_array(sc_structs)})")

    ls_structs = [
        f"named_struct('client_number', CASE WHEN {cond} THEN c_custkey END, 'monthend_dt', '{m}', "
        f"'customer_segment', {seg})"
        for m, seg, cond in lifestage_branches(params)
    ]
    lifestage = (customer.selectExpr(f"inline({_struct_array(ls_structs)})")
                 .where(F.col("client_number").isNotNull()))

    nation_region = nation.join(region, nation.n_regionkey == region.r_regionkey)
    locations = nation_region.select(F.col("n_nationkey").alias("loc_code"), F.col("n_name").alias("city"),
                                     F.col("r_name").alias("region"))
    regional_heads = (nation.where(F.col("n_nationkey") % 3 != 2)
                      .select(F.col("n_nationkey").alias("loc_cd"),
                              F.concat(F.lit("RH "), F.col("n_name")).alias("rh_name")))
    structure = (supplier.groupBy(F.col("s_nationkey").alias("loc_code"))
                 .agg(F.min("s_suppkey").alias("loc_mrg")))

    need = (_sel(customer.where(NEED_WHERE), need_fields(d))
            .select(F.struct(*[F.col(n) for n, _ in need_fields(d)]).alias("row")))

    pre, keys = new_need_group(d)
    new_need = _sel(_sel(orders, pre).groupBy(*keys).agg(F.min("k").alias("k")), new_need_cols(d))

    return RoleTables(
        coverage=_sel(lineitem, coverage_cols(d)),
        policy=_sel(orders, policy_cols(d)),
        links=links,
        agents=_sel(supplier, agent_cols(d)),
        candidates=_sel(supplier.where(CANDIDATE_WHERE), candidate_cols(d)),
        locations=locations,
        regional_heads=regional_heads,
        scorecard=scorecard,
        structure=structure,
        customers=_sel(customer, customer_cols(d)),
        policy_mart=_sel(orders, policy_mart_cols(d)),
        agent_mart=_sel(supplier, agent_mart_cols(d)),
        lifestage=lifestage,
        client_details=_sel(customer, client_detail_cols(d)),
        targets=_sel(events, target_cols(d)),
        need=need.select("row.*"),
        new_need=new_need,
    )


def need_struct_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The existing-customer model as stored: one struct column ``row``."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    d = spark_dialect(1, 1)  # the model fields do not use the cardinalities
    return (_sel(customer.where(NEED_WHERE), need_fields(d))
            .select(F.struct(*[F.col(n) for n, _ in need_fields(d)]).alias("row")))


# ---------------------------------------------------------------------------
# DuckDB side: the same roles as CTEs for the oracle SQL.
# ---------------------------------------------------------------------------

def _cte_select(cols: list[tuple[str, str]]) -> str:
    return ", ".join(f'{e} AS "{n}"' for n, e in cols)


def oracle_ctes(params: RunParams = FIXTURE_PARAMS) -> dict[str, str]:
    """Role name → DuckDB SELECT deriving it from the pre-registered views."""
    d = DUCKDB
    links = " UNION ALL ".join(
        f"SELECT o_orderkey AS pol_num, {cli} AS cli_num, '{typ}' AS link_typ FROM orders"
        + (f" WHERE {cond}" if cond else "")
        for cli, typ, cond in link_branches(d)
    )
    scorecard = " UNION ALL ".join(
        f"SELECT s_suppkey AS agt_code, '{m}' AS monthend_dt, {tier_expr(shift)} AS agent_tier, "
        f"'C' || {_s('s_suppkey % 3')} AS agent_cluster FROM supplier"
        for m, shift in scorecard_branches(params)
    )
    lifestage = " UNION ALL ".join(
        f"SELECT c_custkey AS client_number, '{m}' AS monthend_dt, {seg} AS customer_segment "
        f"FROM customer WHERE {cond}"
        for m, seg, cond in lifestage_branches(params)
    )
    pre, keys = new_need_group(d)
    new_need = (f"SELECT {_cte_select(new_need_cols(d))} FROM (SELECT po_num, month, MIN(k) AS k FROM "
                f"(SELECT {_cte_select(pre)} FROM orders) GROUP BY po_num, month)")
    return {
        "coverage": f"SELECT {_cte_select(coverage_cols(d))} FROM lineitem",
        "policy": f"SELECT {_cte_select(policy_cols(d))} FROM orders",
        "links": links,
        "agents": f"SELECT {_cte_select(agent_cols(d))} FROM supplier",
        "candidates": f"SELECT {_cte_select(candidate_cols(d))} FROM supplier WHERE {CANDIDATE_WHERE}",
        "locations": ("SELECT n_nationkey AS loc_code, n_name AS city, r_name AS region "
                      "FROM nation JOIN region ON n_regionkey = r_regionkey"),
        "regional_heads": "SELECT n_nationkey AS loc_cd, 'RH ' || n_name AS rh_name FROM nation WHERE n_nationkey % 3 <> 2",
        "scorecard": scorecard,
        "structure": "SELECT s_nationkey AS loc_code, MIN(s_suppkey) AS loc_mrg FROM supplier GROUP BY s_nationkey",
        "customers": f"SELECT {_cte_select(customer_cols(d))} FROM customer",
        "policy_mart": f"SELECT {_cte_select(policy_mart_cols(d))} FROM orders",
        "agent_mart": f"SELECT {_cte_select(agent_mart_cols(d))} FROM supplier",
        "lifestage": lifestage,
        "client_details": f"SELECT {_cte_select(client_detail_cols(d))} FROM customer",
        "targets": f"SELECT {_cte_select(target_cols(d))} FROM events",
        "need": f"SELECT {_cte_select(need_fields(d))} FROM customer WHERE {NEED_WHERE}",
        "new_need": new_need,
    }


# Oracle view names of the roles (prefixed so they never clash with the base tables).
ORACLE_NAMES = {
    "coverage": "r_coverage", "policy": "r_policy", "links": "r_link", "agents": "r_agent",
    "candidates": "r_candidate", "locations": "r_location", "regional_heads": "r_head",
    "scorecard": "r_scorecard", "structure": "r_structure", "customers": "r_customer",
    "policy_mart": "r_policy_mart", "agent_mart": "r_agent_mart", "lifestage": "r_lifestage",
    "client_details": "r_client_id", "targets": "r_target", "need": "r_need", "new_need": "r_new_need",
}


def oracle_with(params: RunParams = FIXTURE_PARAMS, roles: list[str] | None = None) -> str:
    """A ``WITH`` clause defining the requested roles under their oracle names."""
    ctes = oracle_ctes(params)
    roles = roles or list(ORACLE_NAMES)
    return "WITH " + ",\n".join(f"{ORACLE_NAMES[r]} AS ({ctes[r]})" for r in roles)
