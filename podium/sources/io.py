"""Readers, sinks and the source dispatch for the two canonical tables.

Schemas are declared, not inferred, for the canonical tables; only an
arbitrary review CSV is read with its header as given (all strings).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import try_parse_timestamp
from . import views

ITEMS_SCHEMA = T.StructType([
    T.StructField("podcast_id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("avg_duration_min", T.IntegerType()), T.StructField("total_episodes", T.LongType()),
    T.StructField("play_count", T.DoubleType()), T.StructField("release_year", T.IntegerType())])
INTERACTIONS_CSV_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("podcast_id", T.StringType()),
    T.StructField("rating", T.DoubleType()), T.StructField("timestamp", T.StringType())])

SOURCES = ("synthetic", "csv", "rss", "kaggle")


CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"'}


def write_csv(df: DataFrame, path: str) -> None:
    """A table as CSV that ``load_source`` reads back as it was: quotes inside
    a field are doubled, blanks around it kept."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns by header name in any order (a missing one is NULL), cast to the
    declared types; quoted newlines and doubled quotes belong to their field."""
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    have = {c.lower(): c for c in raw.columns}
    return raw.select(*[(F.col(f"`{have[f.name]}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
                        .alias(f.name) for f in schema.fields])


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: items CSV, columns by header name."""
    return _read_csv(spark, path, ITEMS_SCHEMA)


def read_interactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: interactions CSV; ``timestamp`` parsed (unparseable -> NULL)."""
    df = _read_csv(spark, path, INTERACTIONS_CSV_SCHEMA)
    return df.withColumn("timestamp", try_parse_timestamp(F.col("timestamp")))


def read_parquet_tables(spark: SparkSession, items_path: str, interactions_path: str):
    """Parquet items and interactions; timestamps coerced to UTC instants
    (text that does not parse becomes NULL)."""
    items = spark.read.parquet(items_path)
    inter = spark.read.parquet(interactions_path)
    ts_type = dict(inter.dtypes).get("timestamp")
    if ts_type == "string":
        inter = inter.withColumn("timestamp", try_parse_timestamp(F.col("timestamp")))
    elif ts_type is not None:
        inter = inter.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return items, inter


def load_source(spark: SparkSession, source: str, items_path: str | None = None,
                interactions_path: str | None = None, sf_dir: str | None = None):
    """``synthetic`` maps to the test-table views, ``csv`` to S3,
    ``rss``/``kaggle`` to S4 (both paths required). Case-insensitive; other
    values raise."""
    s = (source or "").lower()
    if s not in SOURCES:
        raise ValueError(f"unknown source {source!r}; known are {', '.join(SOURCES)}")
    if s == "synthetic":
        if not sf_dir:
            raise ValueError("synthetic source needs sf_dir (the test tables)")
        return views.items(spark, sf_dir), views.interactions(spark, sf_dir)
    if s in ("rss", "kaggle"):
        if items_path is None or interactions_path is None:
            raise ValueError(f"source {s!r} reads two Parquet tables: give items_path and interactions_path")
        return read_parquet_tables(spark, items_path, interactions_path)
    return read_items_csv(spark, items_path), read_interactions_csv(spark, interactions_path)


def write_table(df: DataFrame, path: str, partition_by=None, sort_by=None, row_group_bytes: int | None = None) -> None:
    """Parquet sink (overwrite). ``partition_by`` columns become folders, so
    a filter or a join on them reads only the folders that can match;
    ``sort_by`` orders the rows of each file, so that a point lookup skips the
    row groups whose key range leaves it out. Rows are dealt by ranges of both,
    so a hot partition value is spread over several files, not one task."""
    by, sort = list(partition_by or []), list(sort_by or [])
    if by or sort:
        df = df.repartitionByRange(*[F.col(c) for c in by + sort]).sortWithinPartitions(*by, *sort)
    w = df.write.mode("overwrite")
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    if by:
        w = w.partitionBy(*by)
    w.parquet(path)


def write_interactions(inter: DataFrame, path: str) -> None:
    """The interactions table in month folders, each file sorted by user and time."""
    write_table(inter.withColumn("month", F.date_format("timestamp", "yyyy-MM")), path, ["month"], ["user_id", "timestamp"])


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as a single JSON file (the frame is one row by
    construction, so one task writes it)."""
    report.coalesce(1).write.mode("overwrite").json(path)


def latest_report(spark: SparkSession, glob: str) -> DataFrame:
    """The newest report among JSON files matching ``glob``, by path,
    descending (report names carry their timestamp)."""
    df = spark.read.json(glob).withColumn("report_path", F.col("_metadata.file_path"))
    return df.orderBy(F.col("report_path").desc()).limit(1)


def cached_embeddings(texts: DataFrame, cache_path: str | None, encoder, encoder_name: str,
                      spark: SparkSession) -> DataFrame:
    """S11 as an incremental job: the cache is keyed by (podcast_id, sha2 of
    the text, encoder); a left-anti join finds the rows to encode, the new
    vectors are appended, and the result always matches the items. An encoder
    with a ``fingerprint`` of its fit has it in the key, so vectors of another
    fit are never mixed in."""
    from ..operators.retrieve import embed_text
    if getattr(encoder, "model", None) is None:   # fit on every text, not just the new ones
        encoder.fit(texts.select("text"))
    mark = getattr(encoder, "fingerprint", None)
    encoder_key = f"{encoder_name}:{mark()}" if mark else encoder_name
    keyed = texts.select("podcast_id", "text", F.sha2("text", 256).alias("text_sha"),
                         F.lit(encoder_key).alias("encoder"))
    cache = None
    if cache_path:
        jp = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
        if jp.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jp):
            cache = spark.read.parquet(cache_path)
    key = ["podcast_id", "text_sha", "encoder"]
    todo = keyed if cache is None else keyed.join(cache.select(*key), key, "left_anti")
    # rows that repeat id and text are one, rows that repeat an id alone are told apart by their text
    todo = todo.dropDuplicates(key).withColumn("_key", F.struct("podcast_id", "text_sha"))
    fresh = embed_text(todo, "_key", encoder=encoder).select("_key.*", F.lit(encoder_key).alias("encoder"), "embedding")
    if cache_path:
        fresh.write.mode("append").parquet(cache_path)
        cache = spark.read.parquet(cache_path)
        return keyed.join(cache, key, "inner").select("podcast_id", "embedding")
    return keyed.join(fresh, key).select("podcast_id", "embedding")
