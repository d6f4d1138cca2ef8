"""Shared building blocks: link roles, qualifying agents, bounded broadcast, ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StringType, StructType

from cohortkit.session import staging_path

# Dimensions below this many rows are broadcast; larger ones are left to the
# planner (AQE turns a join into a broadcast from measured shuffle sizes).
DEFAULT_BROADCAST_ROWS = 2_000_000

# Bound for broadcasting a side, in bytes in memory: its rows (counted, for a
# staged table by the write itself) times the width of a row (from the schema).
STAGED_BROADCAST_BYTES = 256 * 1024 * 1024
TEXT_BYTES = 48  # a text value in a row: header and some 40 characters

APE_TYPE = "decimal(18,6)"
TOTAL_TYPE = "decimal(38,6)"


def row_width(schema: StructType) -> int:
    """Bytes of one row in memory, by the types of its columns."""
    def width(t: DataType) -> int:
        return TEXT_BYTES if isinstance(t, StringType) else 24 if isinstance(t, DecimalType) else 8
    return 16 + sum(width(f.dataType) for f in schema)


def within_bounds(df: DataFrame, rows: int, max_rows: int, max_bytes: int = STAGED_BROADCAST_BYTES) -> bool:
    """Whether a side of so many rows may be broadcast: by its rows, and by its rows times their width."""
    return rows <= max_rows and rows * row_width(df.schema) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only after checking its rows and bytes (:func:`within_bounds`).

    ``rows`` is the row count where it is known; else a count runs (a partial
    aggregate, one number per task).  Past the bound the frame is returned as
    is and joins shuffle (sort-merge / AQE-chosen).
    """
    return F.broadcast(df) if within_bounds(df, df.count() if rows is None else rows, max_rows) else df


def materialize(df: DataFrame, how: str | None, name: str = "stage") -> DataFrame:
    """Reuse a stage read by several later stages.

    ``table`` (default) writes it once as Parquet into a fresh folder under the
    shared checkpoint directory and reads it back: lineage is cut (a lost
    executor does not force the upstream joins to rerun), the stage is
    computed exactly once, and the planner gets real file sizes for its join
    choices.  ``None`` leaves it to Spark's exchange reuse.
    """
    if how is None:
        return df
    if how == "table":
        return stage_table(df, name)[0]
    raise ValueError(how)


def stage_table(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write ``df`` once under the shared checkpoint folder; return it read back and its rows.

    The rows are counted by the write itself (an observed metric), not by
    another job.  It is read back with the known schema: an empty stage writes
    no schema to infer.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    seen = Observation(f"{name}-rows")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(seen.get["rows"])


def staged_broadcast(df: DataFrame, max_rows: int, reuse: str | None, name: str) -> DataFrame:
    """Write a reduced side once, then broadcast it if it is within the bounds.

    With ``reuse="table"`` the rows are counted by the write and held against
    ``max_rows`` and, times the row width, against the byte bound; the side is
    computed once, whether it ends up broadcast or shuffled.  With
    ``reuse=None`` nothing is written or counted: its size is unknown, and the
    join is left to the planner.
    """
    if reuse is None:
        return df
    out, n = stage_table(df, name)
    return bounded_broadcast(out, max_rows, n)


#: Rows of one key that a task of a salted join reads.
SALT_ROWS = 1_000_000


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner", rows: int = SALT_ROWS) -> DataFrame:
    """Join on ``key`` where ``big`` may have any number of rows of one key, and ``small`` few.

    One count (partial, map-side) finds the keys with more than ``rows`` rows;
    there are at most rows-of-``big`` / ``rows`` of them, so they are broadcast.
    Their rows in ``big`` are dealt to salts by a hash of the whole row, and
    only their rows in ``small`` are copied, once for each salt; all other
    keys have one salt.  ``how`` is inner, left, left_semi or left_anti; NULL
    keys match nothing, as in a plain join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join can't be {how!r}")
    heavy = big.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select(
        F.col(key).alias("_k"), F.ceil(F.col("_n") / rows).cast("int").alias("_salts"))
    heavy = F.broadcast(stage_table(heavy, "heavy_keys")[0])
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    dealt = big.join(heavy, big[key] == heavy["_k"], "left").withColumn("_salt", F.pmod(F.xxhash64(*big.columns), salts).cast("int"))
    copies = small.join(heavy, small[key] == heavy["_k"], "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    joined = dealt.drop("_k", "_salts").join(copies.drop("_k", "_salts"), [key, "_salt"], how)
    return joined.drop("_salt").select(key, *[c for c in joined.columns if c not in (key, "_salt")])


def links_of(links: DataFrame, link_type: str, cli_alias: str) -> DataFrame:
    """Party links of one role type, e.g. owners (``'O'``) or insureds (``'I'``)."""
    return (links.where(F.col("link_typ") == F.lit(link_type))
            .select("pol_num", F.col("cli_num").alias(cli_alias)))


def agents_in(agents: DataFrame, channels: Sequence[str], prefix: str, extra: Sequence[str] = ()) -> DataFrame:
    """Agents whose channel code is in ``channels``; columns prefixed for a role alias."""
    cols = ["agt_code", "comp_prvd_num", *extra]
    return (agents.where(F.col("comp_prvd_num").isin(*channels))
            .select(*[F.col(c).alias(f"{prefix}{c}") for c in cols]))


def annualized(prem: Column | str, mode: Column | str) -> Column:
    """``prem * 12 / mode``; a zero or NULL mode gives NULL instead of an error."""
    prem = F.col(prem) if isinstance(prem, str) else prem
    mode = F.col(mode) if isinstance(mode, str) else mode
    return F.try_divide(prem * F.lit(12), mode).cast(APE_TYPE)


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str], rprefix: str) -> Column:
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[f"{rprefix}{c}"])
        cond = e if cond is None else cond & e
    return cond


def dense_rank_within(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str,
                      method: str = "split") -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY by ORDER BY order)`` added as ``out``.

    ``method="window"`` is the plain window (one task per group).
    ``method="split"`` survives a hot group (one key holding a large share of
    rows): the distinct ``(by, order)`` keys — whose row number *is* the dense
    rank — are range-partitioned and sorted, so a hot group spans several
    tasks; each task numbers its rows locally, and a tiny per-(task, group)
    count table gives each task's offset within its group.  No group is ever
    gathered into one task.

    The numbered keys are written once (shared checkpoint folder) and both the
    count table and the numbered rows are read from that table, so they agree
    whatever Spark reuses or recomputes.
    """
    keys = df.select(*by, *order).distinct()
    if method == "window":
        w = Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_first() for c in order])
        ranked = keys.withColumn(out, F.dense_rank().over(w))
    elif method == "split":
        ranked = _split_row_number(keys, by, order, out)
    else:
        raise ValueError(method)
    rp = "__r_"
    r = ranked.select(*[F.col(c).alias(rp + c) for c in (*by, *order)], out)
    joined = df.join(r, _null_safe_on(df, r, [*by, *order], rp), "inner")
    return joined.drop(*[rp + c for c in (*by, *order)])


def _split_row_number(keys: DataFrame, by: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    sort_cols = [F.col(c).asc_nulls_first() for c in (*by, *order)]
    tagged = (keys.repartitionByRange(*sort_cols).sortWithinPartitions(*sort_cols)
              .select(*by, *order, F.spark_partition_id().alias("_pid"),
                      F.monotonically_increasing_id().alias("_rid")))
    tagged = stage_table(tagged, "rank_keys")[0]
    # One row per (task, group): first id and row count.  Bounded by tasks × groups.
    stats = tagged.groupBy("_pid", *by).agg(F.min("_rid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    sp = "__s_"
    s = stats.select(*[F.col(c).alias(sp + c) for c in ("_pid", *by)], "_first", "_offset")
    on = _null_safe_on(tagged, s, ["_pid", *by], sp)
    return (tagged.join(s, on, "inner")
            .select(*by, *order, (F.col("_rid") - F.col("_first") + 1 + F.col("_offset")).cast("int").alias(out)))
