"""Corpus pipeline: toxicity, near-duplicates, benchmark leaks, personal data, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; what it returns is written as Parquet in the shared
checkpoint folder and read again as the next stage's ``docs``. All stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scarp.llm import bpe, decontaminate, near_dup, pii, toxicity
from scarp.llm.common import scratch_table
from scarp.llm.queries import tokenizer_path
from scarp.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the model is trained on labelled rows of ``docs``."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, the one with the smallest id."""
    return near_dup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and the terms that disclose it generalised."""
    return pii.sanitise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text that is left."""
    return bpe.encode_digests(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("near_dup", drop_near_duplicates), ("decontamination", drop_leaks),
          ("pii", hide_personal_data), ("bpe", encode)]

# toxicity is a trained model, which SQL cannot express; the tests hold run() against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
