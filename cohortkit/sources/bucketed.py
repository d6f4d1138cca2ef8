"""Bucketed storage of the policy-keyed roles, for runs whose sides outgrow the broadcast bounds.

Coverage, policy and party links are joined on the policy number throughout.  Stored bucketed and sorted by it,
their joins with each other, and with any smaller side keyed by it, need no exchange of these tables: only the
smaller side is dealt to the buckets.  The number of buckets is the parallelism of those joins, so it should be a
multiple of the cluster's cores with buckets of some 128 to 512 MB, and ``spark.sql.shuffle.partitions`` at most that.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import SparkSession

from cohortkit.sources.tables import RoleTables, conform

BUCKET_KEY = "pol_num"
BUCKETED_ROLES = ("coverage", "policy", "links")


def write_bucketed(t: RoleTables, prefix: str, buckets: int, path: str | None = None,
                   roles: Sequence[str] = BUCKETED_ROLES) -> None:
    """Save roles as tables ``<prefix>_<role>``, bucketed and sorted by policy number.

    Rows are dealt to their buckets first, so each bucket is one file.  With
    ``path`` the tables lie in its sub-folders (shared storage), else in the
    warehouse.
    """
    for role in roles:
        writer = (getattr(t, role).repartition(buckets, BUCKET_KEY).write.mode("overwrite").format("parquet")
                  .bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY))
        if path is not None:
            writer = writer.option("path", f"{path.rstrip('/')}/{role}")
        writer.saveAsTable(f"{prefix}_{role}")


def with_bucketed(spark: SparkSession, t: RoleTables, prefix: str, roles: Sequence[str] = BUCKETED_ROLES) -> RoleTables:
    """``t`` with the saved roles read from their bucketed tables (by their contracts)."""
    return replace(t, **{role: conform(spark.table(f"{prefix}_{role}"), role) for role in roles})
