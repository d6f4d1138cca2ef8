"""Helpers shared by the training-data operators: table reads, shared staging, text encoding."""

from __future__ import annotations

import contextlib
import contextvars
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch: 512 texts of up to some 100 KB stay far below a worker's memory.
ARROW_ROWS = 512
PLAIN_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def prepare(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small, so that a batch of long texts fits in a Python worker.

    The setting is read when a plan runs, after these functions return, so it stays set; a smaller one is kept.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder (any file system that Spark reads)."""
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Made(list):
    """Folders of a scope, and those that outlive it."""

    def __init__(self):
        super().__init__()
        self.kept: list[str] = []


_MADE: contextvars.ContextVar[Made | None] = contextvars.ContextVar("made", default=None)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which driver and executors share.

    Only a local master may run without the setting (tests): it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-staging-"))
        base = spark.sparkContext.getCheckpointDir()
    path = os.path.join(base, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Made]:
    """Remove the shared folders that the block makes, but those of :func:`kept` tables; scopes nest."""
    outer, made = _MADE.get(), Made()
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in map(jvm.org.apache.hadoop.fs.Path, made):
            path.getFileSystem(conf).delete(path, True)
        if outer is not None:
            outer.extend(made.kept)


def kept(df: DataFrame, name: str, made: Made) -> DataFrame:
    """``df`` staged so that it outlives the scope whose list is ``made``; it belongs to the scope around it."""
    out = staged(df, name)
    path = made.pop()
    made.kept.append(path)
    return out


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends, lost executors cost nothing."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``df`` with its columns of these names renamed, and columns that give ``df``'s own ones back, for operators
    that add columns of these names on the way (names that Arrow functions or their schemas don't take, with dots,
    blanks or quotes, are renamed too)."""
    clash = {c.lower() for c in names}
    new = {c: f"__own_{i}_{uuid.uuid4().hex[:8]}" for i, c in enumerate(df.columns) if c.lower() in clash or not PLAIN_NAME.fullmatch(c)}
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    return df.withColumnsRenamed(new), [F.col(quoted(new.get(c, c))).alias(c) for c in df.columns]


def to_arrow(rows: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    """Column lists as one record batch of the given schema."""
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that hold rows."""
    return (b for b in it if b.num_rows)


def worker_state() -> dict:
    """What a Python worker keeps between its tasks (tokenizers and their caches, bounded by their owners)."""
    import pyspark

    return pyspark.__dict__.setdefault("_llm_worker_state", {})
