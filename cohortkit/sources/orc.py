"""Propensity sources: ORC snapshot, struct unwrap, schema-gated partition union.

* The existing-customer model is one month of a Hive-style ORC table whose
  data sits in a struct column ``row``.  We read the table *root* and filter
  the partition column, so partition pruning happens and the column is kept,
  then unwrap the struct with ``select("row.*")`` — executors do the work;
  nothing is collected to the driver.
* The new-customer model is a family of partition directories whose file
  schemas drift.  Each directory's schema is read from file footers (metadata
  only), directories failing the gate are skipped, and all passing directories
  are read in **one** scan with ``mergeSchema`` — columns are matched by name,
  missing ones become NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StringType, StructType


def read_orc_snapshot(spark: SparkSession, root: str, partition_col: str, value: str,
                      merge_schema: bool = True) -> DataFrame:
    """One partition of an ORC table, read through the root (pruned, column kept).

    File schemas of older partitions may be narrower; ``merge_schema`` reads
    the union of fields (struct fields included) instead of one file's schema.
    The partition column is read as text so ``2023-03``-style values keep
    their form.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    names = {c.rstrip("/").rsplit("/", 1)[-1]: c for c in _list_children(spark, root)}
    here = names.get(f"{partition_col}={value}")
    if here is not None:  # only this partition's footers are read
        df = reader.option("basePath", root).orc(here)
        return df.withColumn(partition_col, F.lit(value))
    return reader.orc(root).where(F.col(partition_col).cast("string") == F.lit(value))


def unwrap_struct(df: DataFrame, struct_col: str = "row") -> DataFrame:
    """Promote the fields of a struct column to top-level columns."""
    return df.select(f"{struct_col}.*")


def _list_children(spark: SparkSession, root: str) -> list[str]:
    """Child directories of ``root`` through the Hadoop FileSystem API (metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")):
            out.append(st.getPath().toString())
    return sorted(out)


def non_null_fields(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not isinstance(f.dataType, NullType)]


def gate_schema(schema: StructType, min_columns: int | None = None,
                required: Sequence[str] | None = None) -> bool:
    """Gate of one partition: all required names and/or enough non-VOID columns."""
    names = non_null_fields(schema)
    if min_columns is not None and len(names) < min_columns:
        return False
    if required is not None:
        lower = {n.lower() for n in names}
        if any(r.lower() not in lower for r in required):
            return False
    return True


def refuse_mixed_text(schemas: Sequence[StructType]) -> None:
    """Raise if a column is text in one schema and something else in another: neither reading would be safe."""
    kinds: dict[str, set[bool]] = {}
    for schema in schemas:
        for f in schema.fields:
            if not isinstance(f.dataType, NullType):
                kinds.setdefault(f.name.lower(), set()).add(isinstance(f.dataType, StringType))
    mixed = sorted(name for name, k in kinds.items() if len(k) > 1)
    if mixed:
        raise ValueError(f"columns that are text in some directories only: {mixed}")


def read_partition_union(spark: SparkSession, root: str, fmt: str = "orc",
                         min_columns: int | None = None,
                         required: Sequence[str] | None = None,
                         empty_schema: StructType | None = None,
                         refused: list[str] | None = None) -> DataFrame:
    """Union of the partition directories of ``root`` that pass the schema gate.

    Columns are matched by name (never by position); where their types differ
    between directories, Spark's union finds the common type (wider integers,
    decimals, timestamps for dates), but text is never mixed with other types.
    Directories of one schema are one scan.
    Refused directories are appended to ``refused``.  If no directory passes,
    an empty frame with ``empty_schema`` is returned instead of failing.
    """
    groups: dict[StructType, list[str]] = {}
    for child in _list_children(spark, root):
        schema = spark.read.format(fmt).load(child).schema  # footer read only
        if gate_schema(schema, min_columns, required):
            groups.setdefault(schema, []).append(child)
        elif refused is not None:
            refused.append(child)
    if not groups:
        if empty_schema is None:
            raise ValueError(f"no partition of {root} passes the schema gate")
        return spark.createDataFrame([], empty_schema)
    refuse_mixed_text(list(groups))
    parts = [spark.read.format(fmt).schema(schema).load(children).select(*non_null_fields(schema))
             for schema, children in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
