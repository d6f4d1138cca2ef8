"""Session helpers: configuration for scale and a shared staging folder.

Nothing here creates a cluster; callers bring their own session.  For tests and
the bench a local session is built with the settings a cluster job would want:
AQE on (runtime coalescing, skew-join splitting, broadcast conversion from real
shuffle sizes) and no UI.
"""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every job of this library expects.  They are all public Spark
# configuration keys; values are defaults a cluster operator may override.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cohortkit", extra_conf: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (no UI, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in {**SCALE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is.  Only under a local master, and when nothing is
    configured, a fresh folder under the system temp dir is chosen; elsewhere
    its files would stay on single machines, so the call is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith(("local[", "local-cluster")) and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="cohortkit-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_STAGED: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("staged", default=None)


@contextlib.contextmanager
def staging_scope() -> Iterator[list[str]]:
    """Collects the folders staged inside the block (of this thread alone); scopes nest."""
    outer, made = _STAGED.get(), []
    token = _STAGED.set(made)
    try:
        yield made
    finally:
        _STAGED.reset(token)
        if outer is not None:
            outer.extend(made)


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "staging", f"{name}-{uuid.uuid4().hex[:12]}")
    if (made := _STAGED.get()) is not None:
        made.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (Hadoop FileSystem API); none if there is no such folder."""
    folder, fs = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    file, fs = _file_system(spark, path)
    stream = fs.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file beside ``path`` and rename it over ``path``: readers see the old or the new one whole."""
    jvm = spark.sparkContext._jvm
    file, fs = _file_system(spark, path)
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}.new")
    stream = fs.create(fresh)
    stream.write(bytearray(text.encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(file).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(file), options)


def remove_staged(spark: SparkSession, paths: list[str]) -> int:
    """Delete staged folders (Hadoop FileSystem API; shared storage); the list is emptied."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            fs.delete(path, True)
            removed += 1
    return removed
