"""The training-corpus pipeline: quality, near-dedup, decontamination, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes a stage's rows as Parquet to
the shared folder and gives them, read again, to the next.  All stages but the last return the columns of
``documents``.  Cases (in every stage): null texts are empty texts, extra columns pass through as they are until
packing, whatever their names, an empty table stays empty, repeated rows of an id are one document from the second
stage on (one row for each different text), rows without an id go their own way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortkit.llm import decontaminate, near_dedup, packing, quality, secrets
from cohortkit.llm.common import kept, scratch, staged, table  # noqa: F401 (staged re-exported)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (trained on the labelled ones among the given documents)."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id."""
    return near_dedup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts (in any decoded layer) replaced by a mark."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup_minhash", near_dedup_minhash),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("pack_sequences", pack_sequences),
]

#: The trained classifier, the signatures and the tokenizer have no SQL form: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as stages:  # what a stage wrote on its way goes with the stage, its rows with the run
        for name, stage in STAGES:
            with scratch(spark) as made:
                docs = kept(stage(spark, docs, sf_dir), name, made)
        stages.kept.append(stages.pop())
    return docs
