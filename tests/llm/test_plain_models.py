"""op1, op5 and the pipeline against plain versions; null ids and own columns through the queries."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cohortkit.llm import decontaminate as D
from cohortkit.llm import near_dedup as N
from cohortkit.llm import packing as P
from cohortkit.llm import quality as Q
from cohortkit.llm import secrets as S
from cohortkit.llm import toxicity as X
from cohortkit.llm.queries import QUERIES
from tests.llm.test_near_dedup import brute_classes

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def plain_score(p, text):
    """The network position by position, from the parameters, with lists and loops."""
    data = text.encode()
    if not data:
        vector = [0.0] * (2 * Q.HIDDEN)
    else:
        n = -(-len(data) // Q.HALF)
        data += bytes(n * Q.HALF + Q.WIDTH - len(data))
        w = p["W"].reshape(2 * Q.DIM, Q.PAIRS, Q.FILTERS)
        halves = []
        for h in range(n):
            best = [0.0] * Q.FILTERS
            for pos in range(h * Q.HALF, (h + 1) * Q.HALF, 2):
                for f in range(Q.FILTERS):
                    total = float(p["b"][f])
                    for k in range(Q.PAIRS):
                        pair = np.concatenate([p["E"][data[pos + 2 * k]], p["E"][data[pos + 2 * k + 1]]])
                        total += float(pair @ w[:, k, f])
                    best[f] = max(best[f], total)
            halves.append(best)
        chunks = [[max(x, y) for x, y in zip(a, b)] for a, b in zip(halves, halves[1:] + halves[-1:])]
        hidden = [[max(0.0, sum(c[f] * float(p["H"][f, j]) for f in range(Q.FILTERS)) + float(p["h"][j])) for j in range(Q.HIDDEN)] for c in chunks]
        vector = [max(h[j] for h in hidden) for j in range(Q.HIDDEN)] + [sum(h[j] for h in hidden) / n for j in range(Q.HIDDEN)]
    z = sum(v * float(o) for v, o in zip(vector, p["o"])) + float(p["c"][0])
    return 1 / (1 + math.exp(-z))


@pytest.mark.parametrize("text", ["", "a", "größe " * 9, "x" * 128, "y" * 129, "some words of a text, " * 20])
def test_scores_equal_a_plain_network(text):
    net = Q.Network(4)
    assert abs(net.scores([b"other", text.encode(), b"z" * 700])[1] - plain_score(net.p, text)) < 1e-4


def test_training_reads_whole_texts():
    """A mark in the last bytes of long texts is all that tells the classes apart."""
    r = np.random.default_rng(3)
    body = lambda: bytes(r.integers(97, 105, 24_000).astype(np.uint8))
    texts = [body() + (b" QQQQQQQQ" if i % 2 else b" ........") for i in range(60)]
    y = np.array([i % 2 for i in range(60)])
    net = Q.fit(texts, y, 0.5, epochs=25)
    assert ((net.scores(texts) >= 0.5) == (y == 1)).mean() > 0.95


def test_gradients_of_the_filters():
    """The winning positions' gradients, against differences of the loss."""
    r = np.random.default_rng(2)
    net = Q.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    docs = [Q.halves_of(bytes(r.integers(32, 120, n).astype(np.uint8))) for n in (90, 300, 700)]
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    halves, y, w = np.concatenate(docs), np.array([1.0, 0, 1]), np.ones(3)

    def loss():
        s = np.clip(net.scores([bytes(d[:, :Q.HALF].ravel()) for d in docs]), 1e-9, 1 - 1e-9)
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    g, base = Q._step(net, halves, first, y, w), loss()
    for k in ("E", "W", "b"):
        x = net.p[k].reshape(-1)
        for i in np.argsort(-np.abs(g[k]).reshape(-1))[:5]:
            x[i] += 1e-4
            assert abs((loss() - base) / 1e-4 - g[k].reshape(-1)[i]) < 5e-2
            x[i] -= 1e-4


def test_chain_equals_a_plain_scorer(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    features, chain = X.train(docs, labels)

    def plain(text):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        begun = Counter(w[:n] + "*" for w in words for n in X.BEGINNINGS if len(w) >= n)
        have = set(words) | set(begun) | {b + "*" for b, n in begun.items() if n >= X.REPEATED and n * X.DENSE >= len(words)}
        assert have == X.text_features(text or "")
        x, out = [float(f in have) for f in features], []
        for w in chain:
            z = sum(a * float(b) for a, b in zip(x + out, w[:-1])) + float(w[-1])
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        return out

    for r in X.score(docs, (features, chain)).collect():
        want = plain(r["text"])
        assert np.allclose([*r["family_scores"], r["score"]], want, atol=1e-5), r["doc_id"]


@pytest.mark.parametrize("name", ["op1_quality_cnn", "op5_toxicity_chain"])
def test_null_ids_through_the_queries(spark, name, tmp_path):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    more = spark.createDataFrame([(None, "a text without an id"), (None, None)], "doc_id long, text string")
    docs.select("doc_id", "text").unionByName(more).write.parquet(str(tmp_path / "documents.parquet"))
    labels.unionByName(spark.createDataFrame([(None, 1, 1)], labels.schema)).write.parquet(str(tmp_path / "labels.parquet"))
    rows = QUERIES[name](spark, str(tmp_path)).collect()
    assert len(rows) == docs.count() + 2
    alone = [r for r in rows if r["doc_id"] is None]
    assert len(alone) == 2 and all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(b"") % 3 == 1) for r in alone)


def test_kept_documents_have_their_own_columns(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "text", "'mine' as score", "7 as predicted", "'x' as `a.b`")
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {(r["score"], r["predicted"], r["a.b"]) for r in kept.collect()} == {("mine", 7, "x")}


def test_pipeline_run_equals_plain_stages(spark, tmp_path):
    """run() against the stages in plain Python: the model's plain decision, all pairs, all windows, all spans, all ids."""
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    model = Q.train(spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet"))
    assert isinstance(model, Q.Network)
    good = {i: t for i, t in rows.items() if model.scores([t.encode()])[0] >= 0.5}
    classes = brute_classes(list(good.items()))
    one = {i: good[i] for i in set(classes.values())}
    lower = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", t.encode().lower())
    windows = {}
    for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect():
        w = lower(r["text"] or "")
        n = min(10, len(w))
        windows.setdefault(n, set()).update(tuple(w[i:i + n]) for i in range(len(w) - n + 1) if n)
    leaked = lambda t: any(tuple(w[i:i + n]) in g for w in [lower(t)] for n, g in windows.items() if n for i in range(len(w) - n + 1))
    clean = {i: t for i, t in one.items() if not leaked(t)}

    def redacted(t):
        spans, out = sorted({(s, e) for _, s, e in S.scan(t)[1]}), []
        for s, e in spans:
            if out and s <= out[-1][1]:
                out[-1][1] = max(out[-1][1], e)
            else:
                out.append([s, e])
        for s, e in reversed(out):
            t = t[:s] + "[REDACTED]" + t[e:]
        return t

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    want = {i: [*tok.encode(redacted(t), add_special_tokens=False).ids, 1] for i, t in clean.items()}
    got, places = {}, {}
    for r in sorted(corpus_pipeline.run(spark, SF01).collect(), key=lambda r: (r["doc_id"], r["start"])):
        got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert 0 < len(clean) < len(one) <= len(good) < len(rows)
    assert got == want
    for pieces in places.values():
        ends = np.cumsum([0, *(n for _, n in sorted(pieces))])
        assert [o for o, _ in sorted(pieces)] == ends[:-1].tolist() and ends[-1] <= P.SEQUENCE


def test_pipeline_stages_keep_rows_as_they_are(spark):
    docs = spark.createDataFrame([(1, "a clean text of some words here", "s", 1, 2.5), (1, "another text, quite unlike the first one", "t", 3, None)],
                                 "doc_id long, text string, class_id string, bench_hit int, secret_spans double")
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == 2
    items = spark.createDataFrame([(1, "nothing of it")], "item_id long, text string")
    assert sorted(map(tuple, D.drop_leaks(kept, items).collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    assert sorted(map(tuple, S.redact(docs).collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
