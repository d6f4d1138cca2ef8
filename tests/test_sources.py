"""File sources: ORC snapshot with partition pruning, struct unwrap, gated partition union."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from cohortkit.session import staging_path
from cohortkit.sources import orc as ORC
from cohortkit.sources.tables import ContractError, conform


def test_orc_snapshot_keeps_partition_column_and_unwraps(spark):
    root = staging_path(spark, "t_orc")
    df = spark.createDataFrame([(("C1", 3), "2023-03"), (("C2", None), "2023-03"), (("C3", 1), "2023-02")],
                               "row struct<cli_num:string, decile_ci:int>, monthend_dt string")
    df.write.partitionBy("monthend_dt").orc(root)
    snap = ORC.read_orc_snapshot(spark, root, "monthend_dt", "2023-03")
    assert "monthend_dt" in snap.columns
    plan = snap._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "PartitionCount" in plan or "monthend_dt" in plan
    flat = ORC.unwrap_struct(snap)
    assert flat.columns == ["cli_num", "decile_ci"]
    assert sorted((r.cli_num, r.decile_ci) for r in flat.collect() if r.decile_ci is not None) == [("C1", 3)]
    assert flat.count() == 2


def _write_part(spark, root, name, cols):
    data = [tuple(f"{c}-{i}" if c != "ci_decile" else i for c in cols) for i in range(3)]
    schema = StructType([StructField(c, IntegerType() if c == "ci_decile" else StringType()) for c in cols])
    spark.createDataFrame(data, schema).write.orc(f"{root}/{name}")


BASE = ["po_num", "month", "ci_decile", "invst_decile", "lt_decile", "a", "b", "c"]   # 8 columns


def test_partition_union_gates_by_width_and_matches_by_name(spark):
    root = staging_path(spark, "t_union")
    _write_part(spark, root, "m1", BASE)
    _write_part(spark, root, "m2", list(reversed(BASE)))            # other column order
    _write_part(spark, root, "m3", BASE + ["extra"])                 # extra column
    _write_part(spark, root, "m4", BASE[:7])                         # 7 columns: gated out
    df = ORC.read_partition_union(spark, root, "orc", min_columns=8)
    assert set(df.columns) == set(BASE + ["extra"])
    assert df.count() == 9
    # values line up by name even though m2 was written in reverse order
    assert df.where(F.col("po_num").startswith("po_num") == F.lit(False)).count() == 0
    assert df.where(F.col("extra").isNotNull()).count() == 3


def test_partition_union_gate_by_required_names(spark):
    root = staging_path(spark, "t_union_req")
    _write_part(spark, root, "m1", BASE)
    _write_part(spark, root, "m2", [c for c in BASE if c != "lt_decile"] + ["z"])
    df = ORC.read_partition_union(spark, root, "orc", min_columns=None, required=["po_num", "lt_decile"])
    assert df.count() == 3


def test_partition_union_none_passing_gives_empty_typed_frame(spark):
    root = staging_path(spark, "t_union_none")
    _write_part(spark, root, "m1", BASE[:5])
    empty = StructType([StructField(c, StringType()) for c in BASE])
    df = ORC.read_partition_union(spark, root, "orc", min_columns=8, empty_schema=empty)
    assert df.count() == 0 and df.columns == BASE
    with pytest.raises(ValueError):
        ORC.read_partition_union(spark, root, "orc", min_columns=8)


def test_contract_selects_role_columns_and_casts_dates(spark):
    df = spark.createDataFrame([("P1", "C1", "O", "junk")], "pol_num string, cli_num string, link_typ string, x string")
    assert conform(df, "links").columns == ["pol_num", "cli_num", "link_typ"]
    with pytest.raises(ContractError):
        conform(df.drop("link_typ"), "links")
    t = spark.createDataFrame([("T1", "2023-01-15 10:00:00")], "tgt_cust_id string, batch_start_date string")
    t = t.withColumn("batch_start_date", F.to_timestamp("batch_start_date"))
    out = conform(t, "targets").first()
    assert str(out.batch_start_date) == "2023-01-15"


def test_partition_union_takes_common_types_and_refuses_text(spark):
    from decimal import Decimal
    root = staging_path(spark, "t_types")
    spark.sql("select 1 as k, cast(1.25 as decimal(10,2)) as d, 7 as n, date'2023-01-01' as t").write.orc(f"{root}/a")
    spark.sql("select 2L as k, cast(2.125 as decimal(12,3)) as d, cast(0.5 as decimal(5,1)) as n, timestamp'2023-01-02 03:00:00' as t").write.orc(f"{root}/b")
    df = ORC.read_partition_union(spark, root)
    types = dict(df.dtypes)
    assert types == {"k": "bigint", "d": "decimal(12,3)", "n": "decimal(11,1)", "t": "timestamp"}
    assert sorted((r.k, r.d, r.n) for r in df.collect()) == [(1, Decimal("1.250"), Decimal("7.0")), (2, Decimal("2.125"), Decimal("0.5"))]
    spark.sql("select 3 as k, '10' as d").write.orc(f"{root}/c")
    with pytest.raises(ValueError, match="text"):
        ORC.read_partition_union(spark, root)


def test_text_deciles_are_refused(spark):
    df = spark.createDataFrame([("P1", "2023-03", "10", "2", "3")], "po_num string, month string, ci_decile string, invst_decile string, lt_decile string")
    with pytest.raises(ContractError, match="ci_decile"):
        conform(df, "new_need")


def test_the_run_parameters_choose_the_propensity_month(spark, tmp_path):
    """Two snapshots of the model; runs of two needs_month read one each, and publish different hits."""
    import datetime as dt
    from decimal import Decimal

    from cohortkit.operators.publish import read_published
    from cohortkit.params import RunParams
    from cohortkit.plans.leads import run
    from cohortkit.sources.tables import RoleTables, read_roles
    from tests.units import SCHEMAS, make_roles
    iss = dt.date(2023, 2, 10)
    t = make_roles(
        spark, policy=[dict(pol_num="P1", pmt_mode=12, pol_iss_dt=iss, pol_stat_cd="1", wa_cd_1="W", agt_code="A")],
        coverage=[dict(pol_num="P1", plan_code="B", vers_num="1", cvg_stat_cd="1", cvg_typ="B", cvg_reasn="O",
                       cvg_prem=Decimal("10.00"), cvg_iss_dt=iss)],
        links=[dict(pol_num="P1", cli_num="C1", link_typ=x) for x in "OI"],
        customers=[dict(cli_num="C1", cli_typ="Individual", mthly_incm=Decimal(1))],
        agents=[dict(agt_code=a, comp_prvd_num="01", stat_cd="01") for a in "WA"])
    names = [part.split()[0] for part in SCHEMAS["need"].split(", ")]
    root, new = str(tmp_path / "need"), str(tmp_path / "new")
    for month, decile in (("2023-02", 9), ("2023-03", 1)):
        row = tuple("C1" if n == "cli_num" else decile if n.startswith("decile") else "H" for n in names)
        (spark.createDataFrame([row], SCHEMAS["need"]).select(F.struct("*").alias("row"), F.lit(month).alias("monthend_dt"))
         .write.mode("append").partitionBy("monthend_dt").orc(root))
    spark.createDataFrame([("C9", "2023-02", 1, 1, 1)], SCHEMAS["new_need"]).write.orc(f"{new}/m=1")
    sources = {r: getattr(t, r) for r in RoleTables.role_names()} | {"need": root, "new_need": new}
    hits = {}
    for month in ("2023-02", "2023-03"):
        p = RunParams(month_end=dt.date(2023, 2, 28), run_date=dt.date(2023, 4, 1), needs_month=month)
        out = str(tmp_path / f"leads-{month}")
        assert run(spark, sources, p, out) == 1
        hits[month] = read_published(spark, out).first()["high_prop_model"]
    assert hits == {"2023-02": "N", "2023-03": "Y"}
    with pytest.raises(ValueError, match="needs_month"):
        read_roles(spark, sources, propensity="orc")
    with pytest.raises(ValueError, match="layout"):
        read_roles(spark, sources, propensity="csv")
