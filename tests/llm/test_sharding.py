"""op12: exact sizes, gapless slots, the law of the matrix, and that every row arrives once."""

import itertools
import random
import zlib
from collections import Counter
from math import comb

import pytest

from cohortkit.llm import sharding as S
from cohortkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def check_places(rows, n, shards=8):
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == n and [sizes.get(j, 0) for j in range(shards)] == S.shard_sizes(n, shards)
    for j in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == j) == list(range(sizes.get(j, 0)))


def test_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op12_hypergeometric_shards"](spark, SF).collect()
    check_places(rows, len(docs))
    for r in rows:
        data = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    again = QUERIES["op12_hypergeometric_shards"](spark, SF).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in rows} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
def test_edges(spark, n, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_ROWS", 20)  # many buckets in a shard
    rows = [(i % 5 if i % 3 else None, None if i % 7 == 0 else "same" * (i % 2), "mine", -1, i) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int, at int").repartition(5)
    got = S.shard(docs).collect()
    check_places(got, n)
    assert Counter((r["doc_id"], r["text"], r["at"]) for r in got) == Counter((r[0], r[1], r[4]) for r in rows)


def test_hot_copies_are_spread(spark):
    docs = spark.range(6000).selectExpr("1L as doc_id", "'copy' as text").repartition(6)
    got = S.shard(docs).groupBy("shard").count().collect()
    assert {r["count"] for r in got} == {750}


def test_written_shards(spark, tmp_path):
    path = str(tmp_path / "out")
    S.write_shards(S.shard(spark.range(100).selectExpr("id as doc_id", "cast(id as string) as text"), shards=3), path)
    back = spark.read.parquet(path)
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [33, 33, 34]


def test_matrix_sums_and_large_counts():
    rows, places = [10**9, 0, 1, 250_000, 10**10 + 7], S.shard_sizes(10**9 + 250_001 + 10**10 + 7, 8)
    m = S.communication_matrix(rows, places, 3)
    assert [sum(x) for x in m] == rows and [sum(x) for x in zip(*m)] == places
    assert all(abs(x - 10**9 / 8) < 8 * (10**9 / 8 * 7 / 8) ** 0.5 for x in m[0])


def test_draws_follow_the_law():
    """Chi-square of 20,000 draws against the exact probabilities; the bound is far in the tail."""
    for good, bad, n in ((3, 5, 4), (30, 50, 40), (1, 9, 5)):
        rng, tries = random.Random(1), 20_000
        got = Counter(S.draw(rng, good, bad, n) for _ in range(tries))
        law = {k: comb(good, k) * comb(bad, n - k) / comb(good + bad, n) for k in range(max(0, n - bad), min(n, good) + 1)}
        assert set(got) <= set(law)
        chi = sum((got.get(k, 0) - p * tries) ** 2 / (p * tries) for k, p in law.items() if p * tries >= 5)
        assert chi < 3 * len(law) + 20


def test_draws_cost_little():
    """The matrix is drawn on the driver: a draw's cost does not grow with the counts."""
    import time
    rng, start = random.Random(1), time.time()
    got = [S.draw(rng, 10**10, 7 * 10**10, 60_000) for _ in range(3000)]
    assert time.time() - start < 3
    mean, deviation = 7500, (60_000 / 8 * 7 / 8) ** 0.5
    assert abs(sum(got) / len(got) - mean) < 5 * deviation / 3000**0.5
    spread = (sum((x - mean) ** 2 for x in got) / len(got)) ** 0.5
    assert abs(spread / deviation - 1) < 0.07
    assert [S.draw(rng, *x) for x in ((0, 5, 3), (5, 0, 3), (4, 4, 8), (4, 4, 0), (1, 0, 1), (0, 0, 0))] == [0, 3, 4, 0, 1, 0]


def test_matrices_have_the_law_of_a_permutation():
    """Two partitions of two rows into two shards of two: all 24 permutations give the law 1/6, 4/6, 1/6."""
    law = Counter(sum(x < 2 for x in p[:2]) for p in itertools.permutations(range(4)))
    got = Counter(S.communication_matrix([2, 2], [2, 2], s)[0][0] for s in range(6000))
    for k in (0, 1, 2):
        assert abs(got[k] / 6000 - law[k] / 24) < 0.03


def test_order_is_uniform(spark):
    """Over many seeds, the first row of the table comes to each place of four about equally often."""
    rows = spark.range(4).selectExpr("id as doc_id", "'x' as text").coalesce(2)
    got = Counter()
    for seed in range(24):
        got.update((r["shard"], r["slot"]) for r in S.shard(rows, shards=2, seed=seed).where("doc_id = 0").collect())
    assert len(got) == 4 and sum(got.values()) == 24
