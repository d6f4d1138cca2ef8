"""Sharding: a uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Each input partition permutes its rows (a local sort by a random number) and is written once, every row with
its partition and place.  The number of rows that each partition sends to each shard is drawn from the exact
law that a uniform permutation of all rows has: row by row, the matrix is multivariate hypergeometric over the
free places of the shards.  A partition's first places go to shard 0, the next to shard 1 and so on; one
exchange carries the rows, and each shard permutes what it got.  A shard is any size, so it is permuted in
buckets of bounded size: a row's random key gives its bucket, buckets are sorted by the key, and the counts of
the buckets before it give its slot.  Only the counts (one number for each task) reach the driver.

The law is ``rows``: shard sizes differ by one row at most, whatever the sizes of the texts are.  Copies of a text
are independent rows: nothing keeps them in one shard, and no key is hot, since keys come from places.

Cases: a null text counts as empty, a null id is a row like others; repeated rows are separate rows; an empty
table gives no rows, fewer rows than shards leave shards empty; other columns pass through, and of columns
named as the results (``shard``, ``slot``) the results stay.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import set_aside, staged, table

SHARDS, SEED = 8, 20
#: Bytes and rows in one bucket of a shard; buckets at most (their counts are broadcast; beyond, buckets grow and spill).
BUCKET_BYTES, BUCKET_ROWS, BUCKETS = 4 << 20, 512, 200_000
#: Input partitions whose cuts are broadcast (some 150 bytes each); beyond, they are joined by a merge.
BROADCAST_PARTITIONS = 500_000
REACH = 12  # standard deviations of a draw
PLACE_BITS = 33  # monotonically_increasing_id: the partition above, the place in it below


def draw(rng: random.Random, good: int, bad: int, n: int) -> int:
    """How many good ones a sample of ``n`` from ``good + bad`` has: inverse transform outward from the mode.

    Weights are products of the exact ratios of neighbours, over ``REACH`` standard deviations on both sides: what is left
    out is far below the precision of a double.  The work is in proportion to the deviation, not to the counts.
    """
    low, high, total = max(0, n - bad), min(n, good), good + bad
    if low == high:
        return low
    mode = min(max((n + 1) * (good + 1) // (total + 2), low), high)
    deviation = (n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5
    reach = int(REACH * deviation) + 40
    k = np.arange(mode, min(high, mode + reach), dtype=np.float64)  # from k to k + 1
    up = np.cumprod((good - k) * (n - k) / ((k + 1) * (bad - n + k + 1)))
    k = np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)  # from k to k - 1
    down = np.cumprod(k * (bad - n + k) / ((good - k + 1) * (n - k + 1)))
    sums = np.cumsum(np.concatenate(([1.0], up, down)))
    at = min(int(np.searchsorted(sums, rng.random() * sums[-1], "right")), len(sums) - 1)
    return mode + at if at <= len(up) else mode - (at - len(up))


def communication_matrix(rows: list[int], places: list[int], seed: int = SEED) -> list[list[int]]:
    """Rows that each partition sends to each shard; ``rows`` and ``places`` have the same sum."""
    rng, free, matrix = random.Random(seed), list(places), []
    for n in rows:
        others, sent = sum(free), []
        for j, own in enumerate(free):
            others -= own
            k = draw(rng, own, others, n)
            free[j] -= k
            n -= k
            sent.append(k)
        matrix.append(sent)
    return matrix


def shard_sizes(n: int, shards: int) -> list[int]:
    return [n // shards + (j < n % shards) for j in range(shards)]


def _partition(at: Column) -> Column:
    return F.shiftright(at, PLACE_BITS)


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, text: str = "text") -> DataFrame:
    """``docs`` plus ``shard`` (0 ...) and ``slot`` (0 ... without gaps in each shard), in uniformly random order."""
    spark = docs.sparkSession
    docs, back = set_aside(docs.drop("shard", "slot"))
    size = F.octet_length(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("long")
    mixed = (docs.select(F.struct(*docs.columns).alias("row"), size.alias("bytes"), F.rand(seed).alias("r"))
             .sortWithinPartitions("r").select("row", "bytes", F.monotonically_increasing_id().alias("at")))
    mixed = staged(mixed, "locally-permuted")
    found = mixed.groupBy(_partition(F.col("at")).alias("p")).agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes")).orderBy("p").collect()
    n, data = sum(r["n"] for r in found), sum(r["bytes"] for r in found)
    matrix = communication_matrix([r["n"] for r in found], shard_sizes(n, shards), seed)
    ends = [[sum(sent[:j + 1]) for j in range(shards)] for sent in matrix]
    cuts = spark.createDataFrame([(r["p"], e) for r, e in zip(found, ends, strict=True)], "p long, ends array<long>")
    cuts = F.broadcast(cuts) if len(found) <= BROADCAST_PARTITIONS else cuts.hint("merge")
    per_shard = -(-min(BUCKETS, max(data // BUCKET_BYTES, n // BUCKET_ROWS)) // shards) or 1

    place = F.col("at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    key = F.xxhash64("at", F.lit(seed))

    def sent(df: DataFrame, *columns: str) -> DataFrame:
        """Rows with their shard, random key and bucket."""
        return (df.withColumn("p", _partition(F.col("at"))).join(cuts, "p")
                .select(*columns, "at", F.size(F.filter("ends", lambda e: e <= place)).alias("to"), key.alias("key"))
                .withColumn("bucket", F.pmod("key", F.lit(per_shard))))

    before = Window.partitionBy("to").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sent(mixed.select("at")).groupBy("to", "bucket").agg(F.count("*").alias("n")).select(
        "to", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("to", "bucket").orderBy("key", "at"))
    return (sent(mixed, "row").withColumn("inside", inside).join(F.broadcast(starts), ["to", "bucket"])
            .select(*(F.col("row")[c].alias(c) for c in docs.columns), F.col("to").cast("int").alias("shard"),
                    (F.col("start") + F.col("inside") - 1).cast("long").alias("slot")).select(*back, "shard", "slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """The shards as Parquet folders ``shard=0 ...``, each file in slot order."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its size, its text's checksum, and its place in a shard (law ``rows``)."""
    text = F.coalesce("text", F.lit(""))
    return shard(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
