"""Structured Streaming jobs.

X1 online drift: request features arrive as files; each row is binned against
the reference edges (fixed literals, one per feature and edge), counted per
tumbling time window with a watermark, and the per-window counts are written
by ``foreachBatch`` to an append-only log keyed by batch id (rewriting a batch
after a failure overwrites the same folder, so the sink is idempotent).
PSI per window is then a batch read of the latest counts.

X2 incremental feed landing: landed JSONL files stream in; each batch is
written to the same kind of log and the current payload per feed URL is the
latest record by scrape time (merge on read).
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import clean_double, try_parse_timestamp
from ..operators import monitor


def reference_edges(reference: DataFrame, features, bins: int = monitor.PSI_BINS) -> dict:
    """Per-feature (lo, hi) of the reference window after the constant-range
    widening: one small aggregate (a row per feature) reaches the driver."""
    long = monitor.unpivot(reference, features)
    r = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    out = {}
    for row in r:
        lo, hi = float(row["lo"]), float(row["hi"])
        if lo == hi:
            lo, hi = lo - (abs(lo) * 0.001 if lo != 0 else 0.001), hi + (abs(hi) * 0.001 if hi != 0 else 0.001)
        out[row["feature"]] = (lo, hi)
    return out


def _bin_expr(edges: dict, bins: int):
    """Bin of ``value`` for its ``feature`` with literal edges (right-closed)."""
    expr = None
    for f, (lo, hi) in edges.items():
        step = (hi - lo) / float(bins)
        inner = [lo + i * step for i in range(1, bins)]
        b = F.lit(1)
        for e in inner:
            b = b + F.when(F.col("value") > F.lit(e), 1).otherwise(0)
        expr = F.when(F.col("feature") == f, b) if expr is None else expr.when(F.col("feature") == f, b)
    return expr


def reference_counts(reference: DataFrame, edges: dict, bins: int = monitor.PSI_BINS) -> DataFrame:
    long = monitor.unpivot(reference, list(edges))
    return long.withColumn("bin", _bin_expr(edges, bins)).groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("cnt"))


def start_online_drift(spark: SparkSession, source_dir: str, schema, edges: dict, sink_dir: str,
                       checkpoint: str, ts_col: str = "ts", window: str = "7 days",
                       watermark: str = "1 day", bins: int = monitor.PSI_BINS,
                       available_now: bool = True, max_files: int | None = None):
    """Start the X1 stream; returns the StreamingQuery. ``max_files`` bounds the
    files of one micro-batch. A row older than the watermark that earlier
    batches set is dropped (``late_values`` counts it); NaN counts as missing,
    as in the batch form."""
    feats = list(edges)
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(source_dir)
    args = []
    for f in feats:
        args += [F.lit(f), clean_double(f)]
    long = stream.select(F.col(ts_col).cast("timestamp").alias("ts"),
                         F.stack(F.lit(len(feats)), *args).alias("feature", "value")).where(F.col("value").isNotNull())
    counts = (long.withColumn("bin", _bin_expr(edges, bins))
                  .withWatermark("ts", watermark)
                  .groupBy(F.window("ts", window).alias("w"), "feature", "bin")
                  .agg(F.count(F.lit(1)).alias("cnt")))

    def sink(batch: DataFrame, batch_id: int):
        out = batch.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                           "feature", "bin", "cnt", F.lit(batch_id).cast("long").alias("batch_id"))
        out.write.mode("overwrite").parquet(os.path.join(sink_dir, f"batch_id={batch_id}"))

    w = counts.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def late_values(query) -> int:
    """How many (window, feature, bin) updates a finished query dropped as older than its watermark."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


def latest_counts(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Current cumulative count per (window, feature, bin): the update from the
    latest batch that touched it (update mode emits running totals)."""
    log = spark.read.parquet(sink_dir)
    key = ["window_start", "window_end", "feature", "bin"]
    return log.groupBy(*key).agg(F.max_by("cnt", "batch_id").alias("cnt"))


def window_psi(ref_counts: DataFrame, cur_counts: DataFrame, bins: int = monitor.PSI_BINS) -> DataFrame:
    """PSI per (window, feature) from binned counts on both sides."""
    ref_tot = ref_counts.groupBy("feature").agg(F.sum("cnt").alias("n_ref"))
    keys = cur_counts.select("window_start", "window_end", "feature").distinct()
    spine = keys.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    cur_tot = cur_counts.groupBy("window_start", "feature").agg(F.sum("cnt").alias("n_cur"))
    t = (spine.join(cur_counts.withColumnRenamed("cnt", "cc"), ["window_start", "window_end", "feature", "bin"], "left")
              .join(ref_counts.withColumnRenamed("cnt", "rc"), ["feature", "bin"], "left")
              .join(ref_tot, "feature", "left").join(cur_tot, ["window_start", "feature"], "left"))
    rp = F.greatest(F.coalesce("rc", F.lit(0)) / F.col("n_ref"), F.lit(monitor.PSI_FLOOR))
    cp = F.greatest(F.coalesce("cc", F.lit(0)) / F.col("n_cur"), F.lit(monitor.PSI_FLOOR))
    return t.groupBy("window_start", "window_end", "feature").agg(
        F.abs(F.sum((cp - rp) * F.log(cp / rp))).alias("psi"), F.max("n_cur").alias("n_current"))


def start_feed_landing(spark: SparkSession, landing_dir: str, schema, log_dir: str, checkpoint: str,
                       available_now: bool = True):
    """Start the X2 stream over landed JSONL files; returns the StreamingQuery."""
    stream = spark.readStream.schema(schema).json(landing_dir)

    def sink(batch: DataFrame, batch_id: int):
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")) \
             .write.mode("overwrite").parquet(os.path.join(log_dir, f"batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def current_payloads(spark: SparkSession, log_dir: str) -> DataFrame:
    """Latest landed record per feed URL (by scrape time as an instant, then batch)."""
    log = spark.read.parquet(log_dir)
    w = Window.partitionBy("feed_url").orderBy(try_parse_timestamp(F.col("last_scraped_at")).desc_nulls_last(), F.col("batch_id").desc())
    return log.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "batch_id")
