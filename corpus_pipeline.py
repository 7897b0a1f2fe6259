"""The training-data pipeline: language ID, exact dedup, near dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``. Nulls, repeated rows, empty tables and
further columns are handled as the operators' docstrings say.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from podium.llm import bpe, exact, langid, mix, near
from podium.llm.common import documents
from podium.session import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents for which op5 names a language; those it calls ``und`` go."""
    return langid.keep_identified(docs, langid.fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.exact_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return near.near_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix.mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of ids and decoded text."""
    return bpe.bpe_encode(docs, bpe.default_path(), carry=("lang", "source"))


STAGES = [("language_id", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mixing),
          ("bpe", encoding)]

#: Model fits and the token encoder have no SQL form; tests check each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
