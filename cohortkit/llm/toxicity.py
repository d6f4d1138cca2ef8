"""Toxicity: a classifier chain of linear models over lexical features.

A link of the chain is a logistic regression for one category; its inputs are the features of the
text and the probabilities of the earlier categories.  In training those probabilities are predicted
out of fold, so that a later link sees them as it will in use.  ``fit_chain`` takes any 0/1
categories.  The label table here has one (``toxic``), so the categories before it are found first:
the toxic training documents are clustered by the terms that set them apart, and each cluster (a
family of toxic language) is a category; the last link is ``toxic`` itself.

Features are the presence of words and word beginnings in the whole text, and of beginnings that are
dense there (repeated, and one word in ``DENSE`` or more); those that training finds more frequent in
toxic documents are kept.  Training reads at most ``SAMPLE`` labelled documents of
each class (rows whose crc32(doc_id as text) mod 3 is 1 are left out for measuring); scoring is one
pass without a shuffle.

Cases: a null or empty text has no features and gets the base probabilities; repeated rows score
alike; repeated labels of a document count as their larger value; without labels of both classes
every score is the share of toxic rows (0 without labels); other columns pass through whatever their names, those
named as the results are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import batches, prepare, set_aside, table, texts_of
from cohortkit.llm.quality import held_out, sigmoid, training_rows

SAMPLE = 1500
FEATURES = 600
FAMILIES = 4
FOLDS = 5
#: Length of the word beginnings that are features beside the words.
BEGINNINGS = (4, 5, 6)
#: A beginning is dense if it begins this many words of a text, and one word in ``DENSE`` or more.
REPEATED, DENSE = 2, 200
#: A feature is kept if it is in this many toxic documents and this many times likelier there.
LEAST_DOCS, LEAST_RATIO = 4, 6.0
CACHE_WORDS = 300_000
WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n)]


def is_dense(count: int, words: int) -> bool:
    return count >= REPEATED and count * DENSE >= words


def text_features(text: str) -> set[str]:
    """Words, beginnings (``word*``) and dense beginnings (``word**``) of a text."""
    words = Counter(WORD.findall(text.lower()))
    found: Counter[str] = Counter()
    for w, n in words.items():
        for f in word_features(w):
            found[f] += n
    total = words.total()
    return found.keys() | {f"{f}*" for f, n in found.items() if f.endswith("*") and is_dense(n, total)}


def choose_features(docs: list[set[str]], toxic: np.ndarray, limit: int = FEATURES) -> list[str]:
    """The features that set toxic documents apart, strongest first (ties by name)."""
    inside, outside = Counter(), Counter()
    for d, t in zip(docs, toxic.tolist(), strict=True):
        (inside if t else outside).update(d)
    n1, n0 = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    ratio = {f: ((k + 0.5) / n1) / ((outside[f] + 0.5) / n0) for f, k in inside.items() if k >= LEAST_DOCS}
    strong = [f for f, r in ratio.items() if r >= LEAST_RATIO]
    return sorted(strong, key=lambda f: (-inside[f] * np.log(ratio[f]), f))[:limit]


def presence(docs: list[set[str]], features: list[str]) -> np.ndarray:
    at = {f: i for i, f in enumerate(features)}
    x = np.zeros((len(docs), len(features)), np.float32)
    for row, d in zip(x, docs, strict=True):
        row[[at[f] for f in d if f in at]] = 1
    return x


def families(x: np.ndarray, k: int = FAMILIES, rounds: int = 20) -> np.ndarray:
    """Cluster number of each row: means of unit vectors, started from the rows farthest apart."""
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)
    centres = [unit[int(x.sum(1).argmax())]]
    while len(centres) < min(k, len(x)):
        centres.append(unit[int(np.max([unit @ c for c in centres], axis=0).argmin())])
    c = np.array(centres)
    for _ in range(rounds):
        own = (unit @ c.T).argmax(1)
        new = np.array([unit[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-6)
        if np.allclose(new, c):
            break
        c = new
    return (unit @ c.T).argmax(1)


def fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 150, l2: float = 1e-4) -> np.ndarray:
    """Weights and, last, the intercept of a weighted logistic regression (Adam on the whole sample)."""
    x1 = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
    w = np.zeros(x1.shape[1], np.float32)
    m, s, share = np.zeros_like(w), np.zeros_like(w), weight / weight.sum()
    for t in range(1, steps + 1):
        g = (x1.T @ ((sigmoid(x1 @ w) - y) * share).astype(np.float32)) + l2 * np.append(w[:-1], 0)
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w -= 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    return w


def predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


def fit_chain(x: np.ndarray, categories: np.ndarray, weight: np.ndarray, folds: int = FOLDS, seed: int = 5) -> list[np.ndarray]:
    """One weight vector for each column of ``categories``; link k also reads k earlier probabilities."""
    fold = np.random.default_rng(seed).permutation(len(x)) % folds
    chain, inputs = [], x
    for k in range(categories.shape[1]):
        y = categories[:, k].astype(np.float32)
        chain.append(fit_linear(inputs, y, weight))
        if k + 1 < categories.shape[1]:
            out = np.zeros(len(x), np.float32)
            for f in range(folds):
                if (test := fold == f).any() and (~test).any():
                    out[test] = predict(fit_linear(inputs[~test], y[~test], weight[~test]), inputs[test])
            inputs = np.concatenate([inputs, out[:, None]], 1)
    return chain


def run_chain(chain: list[np.ndarray], active: np.ndarray, n: int) -> list[float]:
    """Probabilities of all categories for a text with the active features, of n."""
    out: list[float] = []
    for w in chain:
        z = w[active].sum() + w[-1] + sum(p * w[n + i] for i, p in enumerate(out))
        out.append(float(sigmoid(np.array(z))))
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, k: int = FAMILIES) -> tuple[list[str], list[np.ndarray]] | float:
    """(features, chain), or the share of toxic rows where one class has no labels."""
    texts, toxic, share = training_rows(docs, labels, "toxic", sample)
    if len(set(toxic.tolist())) < 2:
        return share if len(toxic) else 0.0
    found = [text_features(t) for t in texts]
    features = choose_features(found, toxic)
    x = presence(found, features)
    categories = np.zeros((len(x), k + 1), int)
    rows = np.flatnonzero(toxic)
    categories[rows, families(x[rows], k)] = 1
    categories[:, k] = toxic
    weight = np.where(toxic == 1, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    return features, fit_chain(x, categories, weight)


def score(docs: DataFrame, model: tuple[list[str], list[np.ndarray]] | float, text: str = "text") -> DataFrame:
    """``docs`` plus ``family_scores``, ``score`` (0 to 1), ``predicted`` (1 from 0.5) and ``toxic``."""
    spark = prepare(docs.sparkSession)
    docs, back = set_aside(docs.drop("family_scores", "score", "predicted", "toxic"))
    if isinstance(model, float):
        return docs.select(*back, F.array().cast("array<double>").alias("family_scores"), F.lit(model).alias("score"),
                           F.lit(int(model >= 0.5)).alias("predicted"), F.lit(model >= 0.5).alias("toxic"))
    held = spark.sparkContext.broadcast(model)
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, chain = held.value
        at = {f: i for i, f in enumerate(features)}
        cache: dict[str, tuple[tuple[int, ...], tuple[int, ...]]] = {}

        def numbers(word: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
            """Features that the word brings, and those that it brings where its beginning is dense."""
            got = cache.get(word)
            if got is None:
                if len(cache) > CACHE_WORDS:
                    cache.clear()
                own = word_features(word)
                got = cache[word] = (tuple(at[f] for f in own if f in at), tuple(at[f"{f}*"] for f in own[1:] if f"{f}*" in at))
            return got

        def active_in(text: str) -> set[int]:
            words = Counter(WORD.findall(text.lower()))
            present: set[int] = set()
            begun: Counter[int] = Counter()
            for w, n in words.items():
                plain, dense = numbers(w)
                present.update(plain)
                for i in dense:
                    begun[i] += n
            total = words.total() if begun else 0
            return present | {i for i, n in begun.items() if is_dense(n, total)}

        none = run_chain(chain, np.array([], int), len(features))
        for b in batches(it):
            rows = []
            for t in texts_of(b, text):
                active = active_in(t)
                rows.append(run_chain(chain, np.array(sorted(active)), len(features)) if active else none)
            s = np.array([r[-1] for r in rows])
            more = {"family_scores": pa.array([r[:-1] for r in rows], pa.list_(pa.float64())), "score": pa.array(s),
                    "predicted": pa.array((s >= 0.5).astype(np.int32)), "toxic": pa.array(s >= 0.5)}
            yield pa.RecordBatch.from_arrays([*b.columns, *more.values()], schema=pa.schema(
                [*b.schema, *(pa.field(n, a.type) for n, a in more.items())]))

    out = docs.mapInArrow(run, f"{own}, family_scores array<double>, score double, predicted int, toxic boolean")
    return out.select(*back, "family_scores", "score", "predicted", "toxic")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its toxicity probability, the decision, and the probabilities of the families."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "toxic", "family_scores")
