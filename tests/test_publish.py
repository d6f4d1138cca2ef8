"""Versioned publish: failed writes keep the old month, counts come from the write, old versions are removed."""

import os

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import publish as PB

SCHEMA = "po_num string, amount int, onb_mth_yr string"


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "leads")


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def read(spark, out):
    return sorted(tuple(r) for r in PB.read_published(spark, out).collect())


def folders(out, month):
    return sorted(x for x in os.listdir(f"{out}/onb_mth_yr={month}") if x.startswith("version="))


def test_a_write_that_fails_half_way_leaves_the_month(spark, out):
    PB.publish_month(rows(spark, ("a", 1, "202301"), ("b", 2, "202301")), out, "202301")
    bad = spark.range(2000).repartition(8).select(
        F.col("id").cast("string").alias("po_num"),
        F.when(F.col("id") == 1999, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.lit(1)).alias("amount"),
        F.lit("202301").alias("onb_mth_yr"))
    with pytest.raises(Exception, match="lost"):
        PB.publish_month(bad, out, "202301")
    assert read(spark, out) == [("a", 1, "202301"), ("b", 2, "202301")]
    assert len(folders(out, "202301")) == 1  # nothing of the failed write stays


def test_a_job_lost_before_the_switch_leaves_the_month(spark, out, monkeypatch):
    PB.publish_month(rows(spark, ("a", 1, "202301")), out, "202301")
    monkeypatch.setattr(PB, "replace_text", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        PB.publish_month(rows(spark, ("z", 9, "202301")), out, "202301")
    assert read(spark, out) == [("a", 1, "202301")]


def test_counts_are_those_of_the_rows(spark, out):
    data = rows(spark, ("a", 1, "202301"), (None, 2, "202301"), ("a", 3, "202301"), ("c", 1, "202302"))
    v = PB.publish_month(data, out, "202301")
    assert (v.rows, v.null_keys, v.keys) == (3, 1, 1)
    assert PB.published_versions(spark, out) == [v]
    assert PB.read_month(spark, out, "202301").count() == v.rows
    other = PB.publish_month(spark.createDataFrame([(1, "202302")], "x int, onb_mth_yr string"), str(out) + "2", "202302")
    assert (other.rows, other.null_keys, other.keys) == (1, None, None)


def test_versions_are_switched_kept_and_removed(spark, out):
    made = [PB.publish_month(rows(spark, ("a", i, "202301")), out, "202301") for i in range(4)]
    assert read(spark, out) == [("a", 3, "202301")]
    assert made[-1].previous == (made[-2].version,)
    assert folders(out, "202301") == sorted(f"version={v.version}" for v in made[-2:])
    old = PB.read_published(spark, out)  # planned on the version of before the next publish
    PB.publish_month(rows(spark, ("a", 9, "202301")), out, "202301")
    assert [r.amount for r in old.collect()] == [3] and read(spark, out) == [("a", 9, "202301")]


def test_no_job_reads_the_written_rows(spark, out, monkeypatch):
    """publish returns what the write counted: the session's reader is not used for the rows."""
    leads = rows(spark, ("a", 1, "202301"))
    monkeypatch.setattr(PB, "read_published", lambda *a, **k: pytest.fail("second read"))
    from cohortkit.params import RunParams
    assert PB.publish(spark, leads, out, RunParams(month_end="2023-01-31")) == 1
