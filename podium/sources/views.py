"""Canonical tables over the driver's test tables.

``items`` and ``interactions`` are the two tables every operator consumes.
They are lazy DataFrames: Catalyst prunes the columns a query does not use
and pushes filters into the Parquet scans.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def sold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order's customer and date: the one large join
    both canonical tables derive from (only the four needed columns)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner").select(
        "l_partkey", "l_quantity", "o_custkey", "o_orderdate")


def interactions_from(sold: DataFrame) -> DataFrame:
    """(user_id, podcast_id, rating in [0.1, 5], timestamp)."""
    return sold.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("podcast_id"),
        (F.col("l_quantity") / F.lit(10.0)).alias("rating"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )


def items_from(part: DataFrame, sold: DataFrame) -> DataFrame:
    """Items over ``part``; usage statistics aggregated from sold lines
    (partial aggregation before the shuffle, one row per part after)."""
    stats = sold.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.min(F.year("o_orderdate")).alias("first_year"))
    return part.join(stats, part.p_partkey == stats.l_partkey, "left").select(
        F.col("p_partkey").cast("string").alias("podcast_id"),
        F.col("p_name").alias("title"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_type")).alias("description"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("int").alias("avg_duration_min"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("long").alias("total_episodes"),
        F.coalesce(F.col("qty"), F.lit(0.0)).cast("double").alias("play_count"),
        F.col("first_year").cast("int").alias("release_year"),
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions_from(sold_lines(spark, sf_dir))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_from(table(spark, sf_dir, "part"), sold_lines(spark, sf_dir))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, embedding array<float>, category) from ``embeddings``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("item_id"),
        F.col("embedding"),
        F.col("label").cast("string").alias("category"))


def drift_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitored request features from ``events``: two numeric features and one
    categorical one, keyed by time."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").cast("double").alias("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.col("event_type"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review table shaped like a public podcast-review CSV: ``documents``
    with ``source`` as the podcast, ``text`` as the review, ``lang`` as the
    category and the quality label (when present) as the rating text.
    ``row_id`` is the explicit input order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("row_id"),
        F.col("source").alias("podcast_name"),
        F.col("text").alias("review_text"),
        F.col("quality").cast("string").alias("rating"),
        F.col("lang").alias("category"))


# Landed feed records derived from ``documents``: one feed per (source, block
# of 64 document ids), entries in document order. The fixed run time stands in
# for the scrape time.
FEED_RUN_TS = "2024-02-01T00:00:00Z"
FEED_BLOCK = 64


def feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed records shaped like the landed JSONL (nested feed and entries)
    plus ``_line``, the landing order. Entry arrays are bounded by the block."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    block = F.floor(F.col("doc_id") / F.lit(FEED_BLOCK)).cast("long")
    url = F.concat(F.lit("https://feeds.example.org/"), F.col("source"), F.lit("/"), block.cast("string"))
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.col("doc_id"), F.lit(365)).cast("int"))
    entry = F.struct(
        F.when(F.pmod(F.col("doc_id"), F.lit(5)) == 0, F.lit("")).otherwise(
            F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))).alias("id"),
        F.lit(None).cast("string").alias("guid"),
        F.concat(F.lit("https://docs.example.org/"), F.col("doc_id").cast("string")).alias("link"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:30:00+05:00")).alias("published"),
        F.lit(None).cast("string").alias("updated"),
        F.lit(None).cast("string").alias("published_parsed"))
    g = docs.select(url.alias("feed_url"), "source", "lang", "doc_id", entry.alias("e")).groupBy("feed_url").agg(
        F.first("source").alias("source"),
        F.array_sort(F.collect_set("lang")).alias("langs"),
        F.array_sort(F.collect_list(F.struct("doc_id", "e"))).alias("_es"))
    rec = g.select(
        "feed_url", F.lit(FEED_RUN_TS).alias("last_scraped_at"),
        F.substring(F.sha2("feed_url", 256), 1, 16).alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        F.struct(F.col("source").alias("title"), F.lit("").alias("subtitle"),
                 F.concat(F.lit("Feed of "), F.col("source")).alias("description"),
                 F.slice("langs", 1, 5).alias("tags")).alias("feed"),
        F.transform("_es", lambda s: s["e"]).alias("entries"))
    return rec.orderBy("feed_url").withColumn("_line", F.monotonically_increasing_id())


def feed_state(records: DataFrame, status_expr=None) -> DataFrame:
    """``(feed_url, etag, last_modified, status)`` of a landing run."""
    st = status_expr if status_expr is not None else F.lit(200)
    return records.select("feed_url", "etag", "last_modified", st.cast("int").alias("status"))
