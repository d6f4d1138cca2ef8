"""Every operator over tables whose extra columns are named as its results, as what it uses inside, or with dots."""

import pytest
from pyspark.sql import functions as F

from cohortkit.llm import (
    alignment,
    decontaminate,
    fingerprint,
    html_text,
    near_dedup,
    packing,
    quality,
    secrets,
    sharding,
    toxicity,
    warc,
)

#: Names of results and of inner columns of the operators, in either case, and names that need quoting.
NAMES = ["Score", "predicted", "toxic", "family_scores", "secret_spans", "base_spans", "Shard", "slot", "row", "at", "p", "key",
         "bucket", "to", "inside", "n", "rid", "own", "hash", "band", "class_id", "bench_hit", "main_text", "fingerprint", "guest",
         "y", "r", "bytes", "start", "length", "value", "a.b", "c`d", "e f"]
TEXTS = ["one two three four five six seven password=hunter2222", "", None, "one two three four five six seven password=hunter2222"]


def with_names(spark, rows, schema, names=NAMES):
    df = spark.createDataFrame(rows, schema)
    return df.select("*", *[F.lit(f"mine {n}").alias(n) for n in names if n.lower() not in {c.lower() for c in df.columns}])


@pytest.fixture(scope="module")
def docs(spark):
    return with_names(spark, [(i, t) for i, t in enumerate(TEXTS, 1)], "doc_id bigint, text string")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([("b1", "three four five six seven")], "item_id string, text string")


def check(out, own, replaced, n=4):
    """All rows, every own column as it was but those that the results replace, no name twice."""
    names = [c.lower() for c in out.columns]
    assert len(set(names)) == len(names)
    rows = out.collect()
    assert len(rows) == n
    for c in own:
        if c.lower() not in replaced and c not in ("doc_id", "text"):
            assert {r[c] for r in rows} == {f"mine {c}"}


@pytest.mark.parametrize("model", [0.25, None])
def test_quality_score(docs, model):
    out = quality.score(docs, quality.Network() if model is None else model)
    check(out, docs.columns, {"score", "predicted"})


@pytest.mark.parametrize("model", [0.25, None])
def test_toxicity_score(docs, model):
    import numpy as np
    chain = (["password"], [np.zeros(2, np.float32), np.zeros(3, np.float32)])
    check(toxicity.score(docs, chain if model is None else model), docs.columns, {"score", "predicted", "toxic", "family_scores"})


def test_find_secrets_and_redact(docs):
    check(secrets.find_secrets(docs), docs.columns, {"base_spans", "secret_spans"})
    check(secrets.redact(docs), docs.columns, set())


def test_shard(docs):
    out = sharding.shard(docs, shards=3)
    check(out, docs.columns, {"shard", "slot"})
    assert sorted(r["shard"] for r in out.collect()) == [0, 0, 1, 2]


def test_leaks(docs, bench):
    found = decontaminate.find_leaks(docs, bench)
    check(found, docs.columns, {f.lower() for f in decontaminate.RESULTS})
    several = bench.unionByName(bench.withColumn("item_id", F.lit("b2")))
    blocks = decontaminate.find_leaks(docs, several, block_bytes=30)
    check(blocks, docs.columns, {f.lower() for f in decontaminate.RESULTS})
    assert {r["bench_hit"] for r in blocks.collect()} == {0, 5}
    check(decontaminate.drop_leaks(docs, bench), docs.columns, set(), 2)
    check(decontaminate.remove_spans(docs, bench), docs.columns, set())


def test_near_dedup(docs):
    check(near_dedup.keep_one(docs), docs.columns, set(), 2)
    assert near_dedup.near_classes(docs).count() == 4


def test_extract(spark):
    pages = with_names(spark, [(1, "u", "<article><p>Some text of an article.</p></article>"), (2, None, None)],
                       "page_id bigint, url string, html string")
    check(html_text.extract(pages), [c for c in pages.columns if c not in ("page_id", "url", "html")], {"main_text"}, 2)


def test_operators_that_ignore_other_columns(spark, docs):
    assert packing.pack(docs).agg(F.countDistinct("doc_id")).first()[0] == 4
    assert fingerprint.fingerprints(docs).count() == 4
    assert alignment.aligned_rows(docs).count() >= 1
    pages = with_names(spark, [(1, "u", "x"), (2, "v", "x")], "page_id bigint, url string, html string")
    assert warc.with_revisits(pages).count() == 2
