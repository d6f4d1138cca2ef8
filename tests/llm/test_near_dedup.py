"""op6: signatures against the similarity they estimate, classes against brute force over all pairs."""

import random

import numpy as np
import pytest

from cohortkit.llm import near_dedup as N
from cohortkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_classes(rows, least=N.SIMILAR):
    """Smallest id of each connected class, from all pairs that share a shingle (and equal word sequences)."""
    sets = {i: np.unique(N.shingles(N.words_of(t or ""))) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    at = {}
    for i, keys in sets.items():
        for k in keys.tolist():
            at.setdefault(k, []).append(i)
        if not len(keys):
            at.setdefault(None, []).append(i)
    pairs = {(a, b) for ids in at.values() for x, a in enumerate(ids) for b in ids[x + 1:]}
    for a, b in pairs:
        if N.similarity(sets[a], sets[b]) >= least:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in sets}


def words(r, n):
    return ["".join(r.choices("abcdefgh", k=5)) for _ in range(n)]


def weighted(a, b):
    """Weighted Jaccard similarity, from dictionaries."""
    a, b = (dict(zip(k.tolist(), w.tolist())) for k, w in (a, b))
    low = sum(min(w, b[k]) for k, w in a.items() if k in b)
    return low / (sum(a.values()) + sum(b.values()) - low)


def test_agreement_estimates_weighted_similarity():
    r = random.Random(3)
    for change in (0, 4, 12, 40):
        a = words(r, 300) * 2 + words(r, 40)
        b = list(a)
        for i in r.sample(range(len(b)), change):
            b[i] = "x" * 6
        sets = [N.weights(N.shingles(t)) for t in (a, b)]
        v = N.signatures(sets, 1024)
        assert abs((v[0] == v[1]).mean() - weighted(*sets)) < 0.06


def test_signature_does_not_depend_on_the_batch():
    r = random.Random(4)
    sets = [N.weights(N.shingles(words(r, n))) for n in (1, 5, 7, 60, 3000)] + [N.weights([])]
    together = N.signatures(sets, 144)
    for s, row in zip(sets, together, strict=True):
        assert (N.signatures([s], 144)[0] == row).all()
    assert not together[-1].any() and together[:-1].all()


def test_classes_equal_brute_force_on_the_given_table(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op6_dart_minhash"](spark, SF).collect()}
    assert got == brute_classes(rows)


def test_groups_chains_and_shared_passages(spark):
    r = random.Random(5)
    base, passage = words(r, 200), words(r, 120)
    rows = []
    for i in range(120):  # near copies of one text, by a few changed words
        t = list(base)
        for j in r.sample(range(200), 2):
            t[j] = "".join(r.choices("xyz", k=6))
        rows.append((i, " ".join(t)))
    rows += [(200 + i, " ".join(passage + words(r, 90))) for i in range(60)]  # a shared passage, below the threshold
    t = words(r, 150)
    for i in range(6):  # a chain: neighbours alike, the ends not
        rows.append((300 + i, " ".join(t)))
        t = t[6:] + words(r, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["class_id"] for x in N.near_classes(docs).collect()}
    assert got == brute_classes(rows)
    kept = {x["doc_id"] for x in N.keep_one(docs).collect()}
    assert kept == set(got.values())


def test_buckets_above_the_small_size(spark):
    """With leaders that meet only uncovered members, a text and its many copies still make one class."""
    r = random.Random(6)
    base, rows = words(r, 200), []
    for i in range(150):
        t = list(base)
        for j in r.sample(range(200), 4 if i else 0):
            t[j] = "".join(r.choices("xyz", k=6))
        rows.append((i, " ".join(t)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = N.hashed(docs)
    nodes = N.staged(N.nodes_of(N.sign(texts)), "nodes")
    found = N.components(N.links(nodes, texts, small=8))
    ids = {x["node"]: x["doc_id"] for x in nodes.collect()}
    members = {}
    for x in found.collect():
        members.setdefault(x["class_id"], []).append(ids[x["node"]])
    got = {i: min(m) for m in members.values() for i in m}
    assert {i: got.get(i, i) for i, _ in rows} == brute_classes(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "one two"), (4, "One, two!"), (5, "a b c d e"), (5, "a b c d e"), (None, "x"), (6, "w " * 50_000)]
    docs = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, text string, class_id string")
    got = {x["doc_id"]: x["class_id"] for x in N.near_classes(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(x["doc_id"] or 0 for x in kept.collect()) == [0, 1, 3, 5, 6]
    assert N.near_classes(docs.where("false")).count() == 0


def test_rows_without_an_id_or_words(spark, tmp_path):
    rows = [(1, "..."), (2, "!?"), (3, "..."), (4, None), (5, ""), (6, "one"), (None, "one"), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(x) for x in N.op6(spark, str(tmp_path)).collect()]
    want = [(1, 1, True), (2, 2, True), (3, 1, False), (4, 4, True), (5, 4, False), (6, 6, True), (None, None, True), (None, None, True)]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("mean", [0.004, 1.0, 64.0])
def test_darts_per_cell_are_poisson(mean):
    steps = N.poisson_steps(mean)
    n = np.searchsorted(steps, np.random.default_rng(1).random(50_000), "right")
    assert abs(n.mean() - mean) < 5 * (mean / 50_000) ** 0.5


def test_an_id_with_several_texts_is_linked_by_each(spark):
    r = random.Random(8)
    a, b, c = (" ".join(words(r, 60)) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "x"), (1, a, "x"), (2, a + " tail", "y"), (3, b + " tail", "y"), (4, c, "z"), (5, c, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash string").withColumn("row", N.F.lit(0))
    assert {x["doc_id"]: x["class_id"] for x in N.near_classes(docs).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((x["doc_id"], x["text"]) for x in kept.collect()) == sorted([(1, a), (1, b), (4, c)])


def test_repeated_lines_do_not_hide_a_copy(spark):
    r = random.Random(9)
    line, rest = words(r, 20), words(r, 100)
    texts = [" ".join(rest + line), " ".join(rest + line * 50), " ".join(words(r, 120))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x["doc_id"]: x["class_id"] for x in N.near_classes(docs).collect()} == {0: 0, 1: 0, 2: 2}


def test_a_hot_id_with_many_texts(spark):
    r = random.Random(10)
    rows = [(7, " ".join(words(r, 30))) for _ in range(300)] + [(i, " ".join(words(r, 30))) for i in range(100, 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["class_id"] for x in N.near_classes(docs).collect()}
    assert len(got) == 601 and all(i == c for i, c in got.items())
    assert N.keep_one(docs).count() == 900


def test_scratch_tables_are_removed(spark):
    import os

    from cohortkit.llm.common import scratch, staged
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z")], "doc_id long, text string")
    with scratch(spark):
        classes = N.near_classes(docs)
        kept_rows = classes.count()  # the result outlives the scope of the operator, and ends with this one
    assert kept_rows == 3
    with scratch(spark) as outer:
        staged(docs, "t")
        path = outer[0].removeprefix("file:")
        assert os.path.isdir(path)
    assert not os.path.isdir(path)
