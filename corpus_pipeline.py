"""Training-data pipeline over ``documents``: each stage's result is written as
Parquet and reread as the next stage's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionlens.llm import byte_bpe, decontaminate, secret_scan, simhash, toxicity
from sessionlens.llm.common import Scratch, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. The model is fitted on the
    labelled rows of ``docs``. Rows with a null text stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays, the one with the smallest id."""
    return simhash.drop_copies(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, in whatever order, go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text is masked; all documents stay."""
    return secret_scan.mask(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the decoded bytes."""
    keep = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    return byte_bpe.round_trip(docs, keep=keep, with_ids=True)


STAGES = [("toxicity", toxic), ("simhash", near_copies), ("decontaminate", benchmark_leaks),
          ("secret_scan", secrets), ("byte_bpe", encoded)]

ORACLE_SQL = None  # SQL can express neither the classifier nor the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        made = scratch.write(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
        docs = made
    return docs
