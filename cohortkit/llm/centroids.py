"""Centroid clustering: exact integer k-means with a vantage-point tree over the centroids.

Vectors become integers, floor(1024 x), and are written once.  In each round the driver builds a vantage-point
tree over the centroids (their number and width are parameters) and broadcasts it.  Tasks search it best first
for each vector: of the vector's open nodes that with the smallest lower bound is visited next, its vantage
point is a candidate, and a node is left out only if its bound lies beyond the best distance, so equal distances
are all met (the radius is inclusive) and the smaller centroid number wins.  Bounds are floating point with a
margin on the safe side; distances are exact integers.  All vectors of a batch search at once: one step visits
the next node of every vector that still has one.  Tasks return sums of their vectors for each centroid, which
Spark adds as decimals; the driver reads clusters times components numbers and takes the exact floor.

Cases: vectors of another length or with a null, NaN or infinite component are left out; a null id is a vector
like others (its hash is that of an empty id); repeated rows are separate vectors, ordered by their components
where hashes are equal; fewer vectors than centroids give fewer centroids; an empty table gives no rows; an
empty cluster keeps its centroid; other columns are ignored.  Integers are exact as long as a squared distance
fits a long; anything larger ends in an error that says so.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import batches, staged, table, to_arrow

CLUSTERS, DIM, ROUNDS, SCALE, SEED_MARK = 8, 64, 10, 1024, "3:"
#: Differences of components up to this are squared and added as 64-bit integers.
SMALL_DIFFERENCE = 1 << 28
#: Vectors of a batch that search at once (bounds the memory of a step).
AT_ONCE = 4096


@dataclass
class Tree:
    """Nodes of a vantage-point tree: a centroid, and for each child the range of its distances to it."""

    points: np.ndarray  # centroids x components, int64
    point: list[int]  # the centroid of each node
    children: list[list[tuple[int, float, float]]]  # (node, least, greatest distance) of the inner and outer child


def distance(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors to a point."""
    diff = vectors - point
    if not len(diff) or max(int(diff.max()), -int(diff.min())) < SMALL_DIFFERENCE:
        return np.einsum("ij,ij->i", diff, diff)
    exact = [sum((int(x) - int(p)) ** 2 for x, p in zip(v, point, strict=True)) for v in vectors]
    if max(exact) >= 1 << 63:
        raise ValueError("a squared distance does not fit a 64-bit integer")
    return np.array(exact, np.int64)


def build(points: np.ndarray) -> Tree:
    """A tree over all centroids: the farthest one from the node's first is its vantage point, the median distance its cut."""
    tree = Tree(points, [], [])

    def grow(members: np.ndarray) -> int:
        d = distance(points[members], points[members[0]])
        vantage = members[int(d.argmax())]
        rest = members[members != vantage]
        node = len(tree.point)
        tree.point.append(int(vantage))
        tree.children.append([])
        if len(rest):
            d = distance(points[rest], points[vantage])
            order = np.argsort(d, kind="stable")
            half = -(-len(rest) // 2)
            for part in (order[:half], order[half:]):
                if len(part):
                    r = np.sqrt(d[part].astype(np.float64))
                    tree.children[node].append((grow(np.sort(rest[part])), float(r.min()), float(r.max())))
        return node

    if len(points):
        grow(np.arange(len(points)))
    return tree


def bound(to_vantage: np.ndarray, least: float, greatest: float) -> np.ndarray:
    """A lower bound of the distance to anything in a child, rounded down by more than the error of the square roots."""
    gap = np.maximum(to_vantage - greatest, least - to_vantage)
    return np.maximum(gap - 1e-9 * (to_vantage + greatest + 1), 0)


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance) of each vector, and the distances computed.

    Best-first branch and bound: ``open_`` holds each vector's lower bounds of its open nodes.
    """
    n, computed = len(vectors), 0
    best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, len(tree.point), np.int64)
    open_ = np.full((n, len(tree.point)), np.inf)
    open_[:, 0] = 0
    todo = np.arange(n)
    while len(todo):
        node = open_[todo].argmin(1)
        low = open_[todo, node]
        go = low <= np.sqrt(best[todo].astype(np.float64)) * (1 + 1e-12)  # inclusive; false where nothing is open
        go &= low < np.inf
        todo, node = todo[go], node[go]
        open_[todo, node] = np.inf
        for k in np.unique(node).tolist():
            rows, c = todo[node == k], tree.point[k]
            d = distance(vectors[rows], tree.points[c])
            computed += len(rows)
            better = (d < best[rows]) | ((d == best[rows]) & (c < number[rows]))
            best[rows[better]], number[rows[better]] = d[better], c
            root = np.sqrt(d.astype(np.float64))
            for child, least, greatest in tree.children[k]:
                open_[rows, child] = bound(root, least, greatest)
    return number, best, computed


def _runs(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, vectors) of a batch in runs of bounded size."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    for s in range(0, len(flat), AT_ONCE):
        yield s, flat[s:s + AT_ONCE]


def integer_vectors(vectors: DataFrame, id_column: str, embedding: str, dim: int, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): the usable vectors as whole numbers, floor(scale x)."""
    ok = (F.size(embedding) == dim) & F.forall(embedding, lambda x: F.coalesce(
        ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    return vectors.where(ok).select(F.col(id_column).alias("vec_id"), F.transform(
        embedding, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vector"))


def first_centroids(whole: DataFrame, k: int, mark: str = SEED_MARK) -> np.ndarray:
    """The k vectors with the smallest hashes of their ids."""
    hashed = F.sha2(F.concat(F.lit(mark), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = whole.select(hashed.alias("hash"), "vector").orderBy("hash", "vector").limit(k).collect()
    rows.sort(key=lambda r: (r["hash"], r["vector"]))
    return np.array([r["vector"] for r in rows], np.int64)


def sums(whole: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """(count, sums of the components) of each cluster that has vectors, as assigned by ``centroids``."""
    k, dim = centroids.shape
    held = whole.sparkSession.sparkContext.broadcast(build(centroids))
    schema = pa.schema([("cluster", pa.int32()), ("sums", pa.list_(pa.decimal128(38, 0)))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        total = [[0] * (dim + 1) for _ in range(k)]  # Python's integers; the last is the count
        for b in batches(it):
            for _, vectors in _runs(b, dim):
                number, _, _ = nearest(held.value, vectors)
                for c in np.unique(number).tolist():
                    part = vectors[number == c]
                    wide = np.abs(part).max(initial=0) >= 1 << 48
                    added = part.astype(object).sum(0) if wide else part.sum(0)
                    total[c] = [x + int(y) for x, y in zip(total[c], [*added, len(part)], strict=True)]
        used = [c for c in range(k) if total[c][-1]]
        yield to_arrow({"cluster": used, "sums": [list(map(Decimal, total[c])) for c in used]}, schema)

    parts = whole.select("vector").mapInArrow(run, "cluster int, sums array<decimal(38,0)>")
    added = parts.select("cluster", F.posexplode("sums").alias("at", "value")).groupBy("cluster", "at").agg(
        F.sum("value").alias("value")).collect()
    held.unpersist()
    found: dict[int, list[int]] = {}
    for r in added:
        found.setdefault(r["cluster"], [0] * (dim + 1))[r["at"]] = int(r["value"])
    return {c: (x[-1], x[:-1]) for c, x in found.items()}


def assign(whole: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of all vectors."""
    dim = centroids.shape[1]
    held = whole.sparkSession.sparkContext.broadcast(build(centroids))
    more = [pa.field("cluster", pa.int32()), pa.field("distance", pa.int64())]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            found = [nearest(held.value, v)[:2] for _, v in _runs(b, dim)]
            number, d = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(d)],
                                             schema=pa.schema([b.schema.field("vec_id"), *more]))

    name = whole.schema["vec_id"].dataType.simpleString()
    return whole.select("vec_id", "vector").mapInArrow(run, f"vec_id {name}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, id_column: str = "vec_id",
            embedding: str = "embedding", mark: str = SEED_MARK) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of the usable vectors, and the final centroids."""
    whole = staged(integer_vectors(vectors, id_column, embedding, dim), "integer-vectors")
    centroids = first_centroids(whole, k, mark).reshape(-1, dim)
    if not len(centroids):
        name = whole.schema["vec_id"].dataType.simpleString()
        return whole.sparkSession.createDataFrame([], f"vec_id {name}, cluster int, distance long"), centroids
    for _ in range(rounds):
        new = centroids.copy()
        for c, (n, total) in sums(whole, centroids).items():
            new[c] = [x // n for x in total]
        if (new == centroids).all():
            break  # a fixed point: all further rounds give the same
        centroids = new
    return assign(whole, centroids), centroids


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: its cluster and squared distance, the sums of the distances, and a digest of its centroid."""
    found, centroids = cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    found = staged(found, "clusters")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    each = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(wide.alias("s")).collect()}
    rows = [(c, s, sum(each.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
            for c, s in sorted(each.items())]
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _round_sql(i: int) -> str:
    """The centroids after a round, from those before it."""
    return f"""
a{i} AS MATERIALIZED ({_assigned_sql(i - 1)}),
c{i} AS MATERIALIZED (
  SELECT c.c, c.pos, coalesce(m.x, c.x) AS x FROM c{i - 1} c LEFT JOIN (
    SELECT a.c, v.pos, (floor_div(sum(v.x)::HUGEINT, count(*)::HUGEINT))::BIGINT AS x
    FROM a{i} a JOIN v USING (rid) GROUP BY a.c, v.pos) m ON m.c = c.c AND m.pos = c.pos),"""


def _assigned_sql(i: int) -> str:
    return f"""SELECT rid, min(struct_pack(d := d, c := c)).c AS c, min(d) AS d FROM (
    SELECT v.rid, c.c, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM v JOIN c{i} c USING (pos) GROUP BY v.rid, c.c) GROUP BY rid"""


OP13_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS vector
  FROM embeddings WHERE len(embedding) = {DIM}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
v AS MATERIALIZED (SELECT rid, unnest(vector) AS x, generate_subscripts(vector, 1) AS pos FROM kept),
c0 AS MATERIALIZED (
  SELECT c, unnest(vector) AS x, generate_subscripts(vector, 1) AS pos FROM (
    SELECT row_number() OVER (ORDER BY sha256('{SEED_MARK}' || coalesce(vec_id::VARCHAR, '')), vector) - 1 AS c, vector
    FROM kept QUALIFY c < {CLUSTERS})),
{"".join(_round_sql(i) for i in range(1, ROUNDS + 1))}
last AS MATERIALIZED ({_assigned_sql(ROUNDS)}),
digest AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY pos)) AS sha FROM c{ROUNDS} GROUP BY c)
SELECT k.vec_id, a.c::INTEGER AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, g.sha AS centroid_sha256
FROM last a JOIN kept k USING (rid) JOIN digest g ON g.c = a.c
""".replace("floor_div(sum(v.x)::HUGEINT, count(*)::HUGEINT)",
            "((sum(v.x)::HUGEINT - (((sum(v.x)::HUGEINT % count(*)) + count(*)) % count(*))) // count(*))")
