"""Quality classifier: a byte-level convolutional network in numpy over overlapping chunks.

A document's UTF-8 bytes are embedded and convolved with learned filters; each chunk of ``CHUNK``
bytes (half overlapping the next) is max-pooled over its positions and passed through a small dense
layer; the chunk vectors are pooled over the whole document (maximum and mean) and combined into one
probability.  Every byte of a document is read: documents are padded to whole half chunks, and the
memory of a call is that of one Arrow batch cut into bounded runs.

Training is numpy as well, on a bounded number of labelled rows (``sample`` per class), whose whole texts
are read in every epoch, run by run, and pooled per document as in scoring; they alone reach the driver.
Labels are learned only from rows whose crc32(doc_id as text) mod 3 is not 1.

Cases: a null or empty text has no chunks and is scored by its zero vector; repeated rows get equal
scores; repeated labels of a document count as their larger value, null labels are ignored; with no
labels of one class every score is the share of label 1 (0.5 without any labels); a null id is a row like
others (held out as the empty id is); other columns pass through, in ``score`` columns named as the results
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import batches, prepare, scratch, set_aside, staged, table, texts_of

HALF = 128  # bytes of half a chunk
CHUNK = 2 * HALF
DIM, WIDTH, FILTERS, HIDDEN = 8, 8, 16, 24
PAIRS = WIDTH // 2  # filters move two bytes at a time
#: Labelled documents of each class that training reads, at most.
SAMPLE = 800
EPOCHS, RATE, BATCH = 6, 0.006, 16
#: Half chunks in one run of the network (bounds the memory of scoring), and in one run of its gradients.
RUN_HALVES, RUN_ROWS = 256, 2048


class Network:
    """Parameters and the forward pass; ``halves`` are rows of HALF + WIDTH - 2 bytes."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        normal = lambda *s: r.normal(0, 1, s).astype(np.float32)
        self.p = {"E": normal(256, DIM) * 0.5, "W": normal(2 * DIM, PAIRS * FILTERS) / np.sqrt(WIDTH * DIM),
                  "b": np.zeros(FILTERS, np.float32), "H": normal(FILTERS, HIDDEN) / np.sqrt(FILTERS),
                  "h": np.zeros(HIDDEN, np.float32), "o": normal(2 * HIDDEN) * 0.1, "c": np.zeros(1, np.float32)}

    def convolve(self, halves: np.ndarray) -> np.ndarray:
        """(halves, positions, filters) responses: a product for each byte pair, summed over shifts."""
        n = len(halves)
        pairs = self.p["E"][halves].reshape(n, -1, 2 * DIM)
        y = (pairs.reshape(-1, 2 * DIM) @ self.p["W"]).reshape(n, -1, PAIRS, FILTERS)
        length = HALF // 2
        out = y[:, :length, 0] + self.p["b"]
        for k in range(1, PAIRS):
            out += y[:, k:length + k, k]
        return out

    def tops(self, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(greatest response, its position) of each filter in each half chunk, run by run."""
        top, at = np.empty((len(halves), FILTERS), self.p["b"].dtype), np.empty((len(halves), FILTERS), np.int64)
        for s in range(0, len(halves), 64):
            r = self.convolve(halves[s:s + 64])
            at[s:s + 64] = best = r.argmax(1)
            top[s:s + 64] = np.take_along_axis(r, best[:, None], 1)[:, 0]
        return top, at

    def pooled(self, halves: np.ndarray) -> np.ndarray:
        """Maximum of each filter over each half chunk, at least 0."""
        out = np.empty((len(halves), FILTERS), np.float32)
        for s in range(0, len(halves), 16):
            np.maximum(self.convolve(halves[s:s + 16]).max(1), 0, out=out[s:s + 16])
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """One probability for each document, from all its chunks."""
        first, parts = [0], []
        run: list[np.ndarray] = []
        held = 0
        for t in texts:
            h = halves_of(t)
            first.append(first[-1] + len(h))
            while len(h):  # a very long document goes on in the next run
                take = h[:RUN_HALVES - held]
                run.append(take)
                held, h = held + len(take), h[len(take):]
                if held == RUN_HALVES:
                    parts.append(self.pooled(np.concatenate(run)))
                    run, held = [], 0
        if run:
            parts.append(self.pooled(np.concatenate(run)))
        v = np.concatenate(parts) if parts else np.zeros((0, FILTERS), np.float32)
        first = np.array(first)
        vectors = np.zeros((len(texts), 2 * HIDDEN), np.float32)
        full = np.flatnonzero(np.diff(first))
        if len(full):
            chunk = v.copy()
            chunk[:-1] = np.maximum(v[:-1], v[1:])  # with the following half ...
            last = first[full + 1] - 1
            chunk[last] = v[last]  # ... but for the last of each document
            hidden = np.maximum(chunk @ self.p["H"] + self.p["h"], 0)
            vectors[full, :HIDDEN] = np.maximum.reduceat(hidden, first[full])
            vectors[full, HIDDEN:] = np.add.reduceat(hidden, first[full]) / np.diff(first)[full, None]
        return sigmoid(vectors @ self.p["o"] + self.p["c"])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30).astype(np.float64)))


def halves_of(data: bytes) -> np.ndarray:
    """Half chunks of a document, each with the bytes after it that its last filter positions read."""
    n = -(-len(data) // HALF)
    buf = np.zeros(n * HALF + WIDTH - 2, np.uint8)
    buf[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.as_strided(buf, (n, HALF + WIDTH - 2), (HALF, 1)) if n else np.zeros((0, HALF + WIDTH - 2), np.uint8)


def _step(net: Network, halves: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Gradients of the weighted log loss of one batch of whole documents (chunks are pairs of neighbouring rows)."""
    p = net.p
    top, at = net.tops(halves)
    v = np.maximum(top, 0)
    nxt = np.arange(len(v)) + 1
    nxt[first[1:] - 1] -= 1
    use = v[nxt] > v
    chunk = np.where(use, v[nxt], v)
    z = chunk @ p["H"] + p["h"]
    hid = np.maximum(z, 0)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    best = np.maximum.reduceat(hid, first[:-1])
    mean = np.add.reduceat(hid, first[:-1]) / n[:, None]
    vec = np.concatenate([best, mean], 1)
    d = ((sigmoid(vec @ p["o"] + p["c"]) - y) * weight / weight.sum()).astype(np.float32)
    g = {"o": vec.T @ d, "c": np.array([d.sum()])}
    dvec = d[:, None] * p["o"]
    is_best = (hid == best[owner]) & (hid > 0)
    ties = np.maximum(np.add.reduceat(is_best.astype(np.float32), first[:-1]), 1)
    dh = (is_best * (dvec[:, :HIDDEN] / ties)[owner] + (dvec[:, HIDDEN:] / n[:, None])[owner]) * (z > 0)
    g["H"], g["h"] = chunk.T @ dh, dh.sum(0)
    dchunk = dh @ p["H"].T
    dv = np.where(use, 0, dchunk)
    np.add.at(dv, nxt, np.where(use, dchunk, 0))
    dv *= top > 0
    g["b"] = dv.sum(0)
    emb = np.zeros(p["E"].shape)
    gw = np.zeros_like(p["W"]).reshape(2 * DIM, PAIRS, FILTERS)
    w = p["W"].reshape(2 * DIM, PAIRS, FILTERS)
    for s in range(0, len(v), RUN_ROWS):  # only the winning positions have gradients
        part = slice(s, s + RUN_ROWS)
        rows, own = np.arange(len(v))[part, None], dv[part]
        for k in range(PAIRS):
            pos = 2 * (at[part] + k)
            a, b = halves[rows, pos], halves[rows, pos + 1]
            x = np.concatenate([p["E"][a], p["E"][b]], 2)  # rows, filters, 2 * DIM
            gw[:, k] += np.einsum("nfd,nf->df", x, own)
            dx = (own[:, :, None] * w[:, k].T[None]).reshape(-1, 2 * DIM)
            for d in range(DIM):
                emb[:, d] += np.bincount(a.ravel(), dx[:, d], 256) + np.bincount(b.ravel(), dx[:, DIM + d], 256)
    g["E"], g["W"] = emb.astype(p["E"].dtype), gw.reshape(2 * DIM, -1)
    return g


def fit(texts: list[bytes], labels: np.ndarray, share: float, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Train on the texts; ``share``, that of label 1 among all labelled rows, weights the classes."""
    net, r = Network(seed), np.random.default_rng(seed)
    y = labels.astype(np.float32)
    weight = np.where(y == 1, share / max(y.mean(), 1e-6), (1 - share) / max(1 - y.mean(), 1e-6)).astype(np.float32)
    docs = [halves_of(t) for t in texts]
    use = np.flatnonzero([len(d) > 0 for d in docs])
    m = {k: np.zeros_like(x) for k, x in net.p.items()}
    s = {k: np.zeros_like(x) for k, x in net.p.items()}
    t, total = 0, max(1, epochs * -(-len(use) // BATCH))
    for _ in range(epochs):
        order = r.permutation(use)
        for at in range(0, len(order), BATCH):
            ids = order[at:at + BATCH]
            parts = [docs[i] for i in ids]
            first = np.concatenate([[0], np.cumsum([len(d) for d in parts])])
            g = _step(net, np.concatenate(parts), first, y[ids], weight[ids])
            t += 1
            rate = RATE * (1 - 0.9 * t / total)
            for k, x in net.p.items():
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                x -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-7)).astype(np.float32)
    return net


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows whose label is never learned (a null id counts as the empty text)."""
    own = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(own.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> tuple[list[str], np.ndarray, float]:
    """(texts, labels, share of label 1): at most ``sample`` documents of each class, by a hash of the id."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    spark = docs.sparkSession
    with scratch(spark):  # ids and labels alone are written; they are read for the counts and for the choice
        known = staged(docs.select("doc_id").join(known, "doc_id", "left_semi").distinct().join(known, "doc_id"), "known-labels")
        return _chosen_texts(docs, known, sample)


def _chosen_texts(docs: DataFrame, known: DataFrame, sample: int) -> tuple[list[str], np.ndarray, float]:
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rank = F.xxhash64("doc_id")
    chosen = []
    for y in (0, 1):  # ids alone are ranked; the texts of the chosen follow
        chosen += known.where(F.col("y") == y).orderBy(rank, "doc_id").limit(sample).collect()
    spark = docs.sparkSession
    picked = spark.createDataFrame([(r["doc_id"], r["y"]) for r in chosen], "doc_id long, y int")
    got = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).join(F.broadcast(picked), "doc_id")
           .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
           .select("text", "y", "doc_id").collect())
    got.sort(key=lambda r: r["doc_id"])
    total = sum(counts.values())
    return [r["text"] or "" for r in got], np.array([r["y"] for r in got], int), counts.get(1, 0) / total if total else 0.5


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Network | float:
    """A trained network, or the share of label 1 where a class has no labelled documents."""
    texts, y, share = training_rows(docs, labels, label, sample)
    if len(set(y.tolist())) < 2:
        return share
    return fit([t.encode() for t in texts], y, share)


def score(docs: DataFrame, model: Network | float, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5)."""
    prepare(docs.sparkSession)
    docs, back = set_aside(docs.drop("score", "predicted"))
    if isinstance(model, float):
        return docs.select(*back, F.lit(model).alias("score"), F.lit(int(model >= 0.5)).alias("predicted"))
    held = docs.sparkSession.sparkContext.broadcast(model.p)
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network()
        net.p = held.value
        for b in batches(it):
            s = net.scores([t.encode() for t in texts_of(b, text)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], schema=pa.schema(
                [*b.schema, pa.field("score", pa.float64()), pa.field("predicted", pa.int32())]))

    return docs.mapInArrow(run, f"{own}, score double, predicted int").select(*back, "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their own columns as they are."""
    inner, own = set_aside(docs, "score", "predicted")
    return score(inner, train(docs, labels)).where("predicted = 1").select(*own)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether its label was held out, its score and the prediction."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
