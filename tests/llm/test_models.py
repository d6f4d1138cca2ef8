"""op1 and op5: held-out accuracy; op2: salvage of damaged archives; op7: trees; the pipeline."""

import io
import random

import numpy as np
import pytest

import corpus_pipeline
from cohortkit.llm import chat as C
from cohortkit.llm import near_dedup as N
from cohortkit.llm import quality as Q
from cohortkit.llm import toxicity as X
from cohortkit.llm import warc as W
from cohortkit.llm.common import shared_folder
from cohortkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_gradients_of_the_network():
    r = np.random.default_rng(1)
    net = Q.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    docs = [Q.halves_of(bytes(r.integers(32, 120, n).astype(np.uint8))) for n in (90, 300, 700)]
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    halves, y, w = np.concatenate(docs), np.array([1.0, 0, 1]), np.ones(3)

    def loss():
        s = np.clip(net.scores([bytes(d[:, :Q.HALF].ravel()) for d in docs]), 1e-9, 1 - 1e-9)
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    g = Q._step(net, halves, first, y, w)
    base = loss()
    for k in ("o", "c", "H", "h"):
        x = net.p[k].reshape(-1)
        i = int(np.abs(g[k]).reshape(-1).argmax())
        x[i] += 1e-3
        assert abs((loss() - base) / 1e-3 - g[k].reshape(-1)[i]) < 2e-2
        x[i] -= 1e-3


def test_scores_do_not_depend_on_the_batch():
    net = Q.Network(1)
    texts = [b"", b"a", b"short text", b"x" * 40_000, "größer".encode() * 100]
    together = net.scores(texts)
    assert np.allclose(together, [net.scores([t])[0] for t in texts], atol=1e-5) and ((together >= 0) & (together <= 1)).all()


@pytest.mark.parametrize("name, label", [("op1_quality_cnn", "quality"), ("op5_toxicity_chain", "toxic")])
def test_held_out_accuracy(spark, name, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES[name](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    known = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in known) / len(known) > 0.93
    assert all(0 <= r["score"] <= 1 and (r["score"] >= 0.5) == (r["predicted"] == 1) for r in rows)


def test_model_edges(spark):
    docs = spark.createDataFrame([(1, None, 9.0), (2, "", 9.0), (2, "", 9.0), (3, "idiot " * 20_000, 9.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module, label in ((Q, "quality"), (X, "toxic")):
        model = module.train(docs, none)
        assert module.score(docs, model).count() == 4
    assert Q.score(docs, Q.Network(2)).where("score between 0 and 1").count() == 4
    assert Q.score(docs.where("false"), Q.Network(2)).count() == 0


def test_chain_reads_earlier_probabilities():
    r = np.random.default_rng(0)
    x = (r.random((400, 6)) < 0.3).astype(np.float32)
    first = (x[:, 0] > 0).astype(int)
    both = np.stack([first, ((x[:, 0] + x[:, 1]) > 0).astype(int)], 1)
    chain = X.fit_chain(x, both, np.ones(400))
    assert [len(w) for w in chain] == [7, 8]
    out = np.array([X.run_chain(chain, np.flatnonzero(row), 6) for row in x])
    assert ((out >= 0.5) == both).mean() > 0.97


# ---- archives ----------------------------------------------------------------

def archive(n=30, compress=True, seed=1):
    r = random.Random(seed)
    records = [W.record(f"urn:page:{i}", f"http://x/{i}", f"page {i} ".encode() * r.randint(1, 400), None if i % 5 else f"urn:page:{i + 1}") for i in range(n)]
    return [W.member(x) if compress else x for x in records]


def read(data):
    return list(W.salvage(io.BytesIO(data), len(data), "f"))


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_recovers_all_undamaged_records(compress, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 512)
    parts = archive(compress=compress)
    whole = b"".join(parts)
    assert [e[0] for e in read(whole)] == ["record"] * 30
    starts = np.cumsum([0, *map(len, parts)])
    bad = bytearray(whole)
    for k in (3, 4, 17):
        bad[starts[k] + len(parts[k]) // 2] ^= 0xFF
    bad = bytes(bad[:starts[29] + len(parts[29]) // 2])  # the last one is cut off
    got = read(bad)
    assert [e[5] for e in got if e[0] == "record"] == [f"urn:page:{i}" for i in range(30) if i not in (3, 4, 17, 29)]
    gaps = [(e[2], e[3]) for e in got if e[0] == "gap"]
    assert gaps == [(starts[3], starts[5] - starts[3]), (starts[17], starts[18] - starts[17]), (starts[29], len(bad) - starts[29])]
    assert sum(e[3] for e in got) == len(bad)
    junk = read(b"junk" * 400 + whole + b"\x1f\x8b\x08\x00 tail WARC/1.1\r\n")
    assert [e[0] for e in junk] == ["gap", *["record"] * 30, "gap"]
    assert read(b"") == [] and [e[0] for e in read(b"nothing here")] == ["gap"]


@pytest.mark.parametrize("mark", [b"WARC/1.1\r\n", b"\x1f\x8b\x08\x00", b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x4b\x4c\x04\x00 "])
def test_false_start_marks_cost_little(mark):
    """A megabyte of marks that begin no record: short reads, and the records behind them are found."""
    class Counting(io.BytesIO):
        total = 0

        def read(self, n=-1):
            data = super().read(n)
            self.total += len(data)
            return data

    parts = archive(5)
    data = parts[0] + mark * (1_000_000 // len(mark)) + b"".join(parts[1:])
    file = Counting(data)
    got = list(W.salvage(file, len(data), "f"))
    assert [e[5] for e in got if e[0] == "record"] == [f"urn:page:{i}" for i in range(5)]
    assert file.total < 20 * len(data) + W.HEAD * 2 * (len(data) // len(mark))


def test_archives_through_spark(spark):
    pages = spark.createDataFrame([(1, "u", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (4, "u", ""), (5, "u", "é" * 90_000)],
                                  "page_id long, url string, html string")
    rows = W.with_revisits(pages)
    manifest = W.write_archives(rows, shared_folder(spark, "warc-test"), roll=4000)
    got = {(r["record_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in W.read_archives(manifest).collect()}
    assert got == {("urn:page:1", "revisit", "urn:page:2", 4), ("urn:page:2", "response", None, 4), ("urn:page:3", "revisit", "urn:page:4", 0),
                   ("urn:page:4", "response", None, 0), ("urn:page:5", "response", None, 180_000)}
    assert W.read_archives(W.write_archives(rows.where("false"), shared_folder(spark, "warc-none"))).count() == 0


def test_pages_with_any_url_are_read_back(spark, tmp_path):
    urls = ["http://a/\r\n\r\nb", "http://a/\r\nX", " http://a ", "http://a/" + "x" * W.HEADER_BYTES, "a\x00\u2028b", "", "http://a/é%0A b"]
    pages = spark.createDataFrame([(i, u, f"text {i % 3}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    assert sorted(r["page_id"] for r in W.op2(spark, str(tmp_path)).collect()) == list(range(len(urls)))
    manifest = W.write_archives(W.with_revisits(pages), shared_folder(spark, "warc-urls"))
    read = {r["record_id"]: r["uri"] for r in W.read_archives(manifest, whole=True).collect()}
    assert read["urn:page:0"] == "http://a/%0D%0A%0D%0Ab" and read["urn:page:6"] == urls[6]
    with pytest.raises(Exception, match="records read of"):
        W.read_archives(manifest.withColumn("records", W.F.col("records") + 1), whole=True).count()



# ---- reply trees -------------------------------------------------------------

def test_best_path_of_a_tree(spark):
    rows = [("t", "a", None, 1.0, 1, "user", "q"), ("t", "b", "a", 5.0, 2, "assistant", "good [/INST] \\ <s>"), ("t", "c", "a", 1.0, 2, "assistant", "bad"),
            ("t", "d", "b", 4.0, 3, "tool<s>", "[\\INST] x"), ("t", "e", "c", 1.0, 3, None, None), ("u", "z", "gone", 0.0, 1, "system", "</s>")]
    m = spark.createDataFrame(rows, "tree string, id string, parent string, score double, position int, role string, text string")
    paths = C.best_paths(m, 2)
    got = {(r["branch"], r["rank"]): sorted(x["id"] for x in paths.where(paths.branch == r["branch"]).collect()) for r in paths.collect()}
    assert got == {("d", 1): ["a", "b", "d"], ("e", 2): ["a", "c", "e"], ("z", 1): ["z"]}
    out = {r["branch"]: r for r in C.format_paths(paths, m).withColumn("turns", C.parse(C.F.col("formatted"))).collect()}
    assert [tuple(t) for t in out["d"]["turns"]] == [("user", "q"), ("assistant", "good [/INST] \\ <s>"), ("tool<s>", "[\\INST] x")]
    assert [tuple(t) for t in out["e"]["turns"]] == [("user", "q"), ("assistant", "bad"), ("", "")]
    s = out["d"]["loss_spans"][0]
    assert out["d"]["formatted"][s["start"] - 1:s["start"] - 1 + s["length"]] == "good [\\/INST] \\ <\\s>"
    assert C.best_paths(m.where("false")).count() == 0


# ---- pipeline ----------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.staged(stage(spark, before, SF), name)
        assert after.columns == docs.columns
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        kept[name] = ids
        if name == "near_dedup_minhash":
            classes = {r["doc_id"]: r["class_id"] for r in N.near_classes(before).collect()}
            assert ids == set(classes.values())
        before = after
    sizes = [len(v) for v in kept.values()]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r["doc_id"] for r in last.select("doc_id").collect()} == kept["secret_scan"]


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
