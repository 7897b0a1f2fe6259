"""Quality selection by importance resampling.

Hashed unigram and bigram counts give two generative models: one of target
text (documents labelled good), one of raw text (all documents). A document's
log importance weight is the sum over its n-grams of log p_target - log p_raw.
Adding Gumbel noise and keeping the k largest samples k documents without
replacement in proportion to their weights.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import global_row_number
from ..sources.views import table
from .common import documents, map_arrow, mix64, words_by_pass

BUCKETS = 1 << 14
#: Labelled good documents that the target model is fitted on: those with the smallest hash of their id.
TARGET_ROWS = 5000
#: Share of the documents that is sampled.
KEEP = 0.8
SEED = 20240601


def _features(h: np.ndarray, row: np.ndarray):
    """(bucket, row) of the unigrams and bigrams of a pass."""
    if not len(h):
        return h.astype(np.int64), row
    pair = row[1:] == row[:-1]
    two = mix64(h[:-1][pair] * np.uint64(0x9E3779B97F4A7C15) + h[1:][pair])
    return (np.concatenate([h, two]) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([row, row[1:][pair]])


def fit(docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        target_rows: int = TARGET_ROWS) -> np.ndarray:
    """Log ratio of each bucket. ``good`` holds the ids of target documents;
    at most ``target_rows`` of them are used. Raw counts cover all documents:
    each task sends one row per bucket."""
    chosen = good.select(F.col(id_col).alias("_gid")).where(F.col("_gid").isNotNull()).distinct().orderBy(
        F.xxhash64("_gid"), "_gid").limit(target_rows)
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(chosen), F.col("_id") == F.col("_gid"), "left").select(F.col("_gid").isNotNull().alias("_target"), "_text")

    def run(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            flag = b.column(0).to_numpy(zero_copy_only=False)
            for i, _, h, row in words_by_pass(b.column(1)):
                bucket, r = _features(h, row)
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[flag[i + r]] if len(r) else bucket, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(raw), pa.array(target)], ["b", "raw", "target"])
    got = map_arrow(marked, run, "b long, raw long, target long").groupBy("b").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas().sort_values("b")    # BUCKETS rows
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[got["b"]], target[got["b"]] = got["raw"], got["target"]
    if target.sum() == 0:
        return np.zeros(BUCKETS)                # nothing to prefer
    smooth = lambda c: np.log((c + 1.0) / (c.sum() + BUCKETS))
    return smooth(target) - smooth(raw)


def weigh(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, log_weight`` of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        for b in batches:
            words, weight = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for i, j, h, row in words_by_pass(b.column(1)):
                bucket, r = _features(h, row)
                words[i:j] = np.bincount(row, minlength=j - i)
                weight[i:j] = np.bincount(r, weights=shared.value[bucket], minlength=j - i)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words), pa.array(weight)], ["doc_id", "n_words", "log_weight"])
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text")), run,
                     "doc_id long, n_words long, log_weight double")


def resample(weights: DataFrame, keep: float = KEEP, seed: int = SEED) -> DataFrame:
    """Adds ``gumbel_key, rank, kept``: the ceil(keep x rows) largest keys stay.

    The noise is a hash of id and seed, so reruns agree. Documents without
    words go last. Ranks come from a range sort without a single task.
    """
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce("doc_id", F.lit(-1))), 12).cast("double") + 0.5) / float(1 << 52)
    keyed = weights.withColumn("gumbel_key", F.when(F.col("n_words") > 0, F.col("log_weight") - F.log(-F.log(u))).otherwise(
        F.lit(float("-inf"))))
    ranked = global_row_number(keyed, [F.col("gumbel_key").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_words")], "rank")
    total = keyed.agg(F.ceil(F.count(F.lit(1)) * F.lit(keep)).alias("_k"))      # one row
    return ranked.crossJoin(F.broadcast(total)).withColumn("kept", F.col("rank") <= F.col("_k")).drop("_k")


def select_quality(docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   keep: float = KEEP) -> DataFrame:
    """``doc_id, n_words, log_weight, gumbel_key, rank, kept`` per row.

    Null and empty texts weigh 0 and rank last. Without good documents all
    weights are 0 and the sample is uniform. Rows repeating an id share its
    noise and rank next to each other when their texts are equal. An empty
    table gives an empty result.
    """
    from .common import materialize
    return resample(materialize(weigh(docs, fit(docs, good, id_col, text_col), id_col, text_col), "quality-weights"), keep)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return select_quality(documents(spark, sf_dir), good)


QUERIES = {"op6_quality": op6_quality}
SQL: dict[str, str] = {}
