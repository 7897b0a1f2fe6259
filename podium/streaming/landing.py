"""Landed feed records merged into a current table, copy on write.

The table lies in hash buckets of the feed URL. A micro-batch rewrites the
buckets it touches into a folder of its own and then publishes a manifest,
named by the batch id, that says where each bucket lies; readers follow the
newest manifest, so they see a batch whole or not at all, and read as much as
the table holds, not its history. A replayed batch finds its manifest and does
nothing. Buckets that no kept manifest names are deleted.

Per feed a 200 replaces payload and state, a 304 or a failure keeps both, and
of several records the latest scrape (as an instant) counts.
"""
from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import try_parse_timestamp
from ..operators.ingest import RAW_FEED_SCHEMA

#: A landed record: the feed's payload and the answer's status.
LANDED_SCHEMA = T.StructType([*RAW_FEED_SCHEMA.fields, T.StructField("status", T.IntegerType())])
_PAYLOAD = [f for f in RAW_FEED_SCHEMA.fields if f.name != "feed_url"]
_ROW = T.StructType([T.StructField("feed_url", T.StringType()), T.StructField("scraped", T.TimestampType()),
                     T.StructField("payload", T.StructType(_PAYLOAD))])


class FeedTable:
    """The current state of all feeds under ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32, keep: int = 3):
        self.spark, self.path, self.buckets, self.keep = spark, path, buckets, keep

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _batches(self) -> list[int]:
        """Published batch ids, ascending."""
        fs, p = self._fs(os.path.join(self.path, "manifest"))
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, batch: int) -> dict[int, str]:
        text = self.spark.read.option("wholetext", True).text(os.path.join(self.path, "manifest", f"{batch}.json")).first()[0]
        return {int(b): folder for b, folder in json.loads(text).items()}

    def _publish(self, batch: int, where: dict[int, str]) -> None:
        fs, target = self._fs(os.path.join(self.path, "manifest", f"{batch}.json"))
        _, draft = self._fs(os.path.join(self.path, "manifest", f"_{batch}-{uuid.uuid4().hex}"))
        out = fs.create(draft, True)
        out.write(json.dumps(where).encode())
        out.close()
        fs.rename(draft, target)

    def _read(self, folders) -> DataFrame:
        folders = list(folders)
        return self.spark.read.schema(_ROW).parquet(*folders) if folders else self.spark.createDataFrame([], _ROW)

    def rows(self) -> DataFrame:
        """``feed_url, scraped, payload``: the current rows, all buckets."""
        done = self._batches()
        return self._read(self._manifest(done[-1]).values() if done else [])

    def payloads(self) -> DataFrame:
        """The current record of each feed that ever answered 200."""
        return self.rows().where("payload is not null").select("feed_url", *[F.col(f"payload.{f.name}") for f in _PAYLOAD])

    def state(self) -> DataFrame:
        """``feed_url, etag, last_modified`` of each feed ever tried."""
        return self.rows().select("feed_url", "payload.etag", "payload.last_modified")

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Merges landed records (``LANDED_SCHEMA``) as batch ``batch_id``."""
        done = self._batches()
        if batch_id in done:
            return                              # replayed after it was published
        before = [b for b in done if b < batch_id]
        where = self._manifest(before[-1]) if before else {}
        answer = F.when(F.col("status") == 200, F.struct(
            try_parse_timestamp(F.col("last_scraped_at")).alias("scraped"),
            F.struct(*[f.name for f in _PAYLOAD]).alias("payload")))
        landed = batch.where("feed_url is not null").groupBy("feed_url").agg(F.max(answer).alias("new")).withColumn(
            "bucket", F.pmod(F.xxhash64("feed_url"), F.lit(self.buckets)).cast("int")).persist()
        try:
            touched = [r["bucket"] for r in landed.select("bucket").distinct().collect()]      # at most ``buckets``
            if touched:
                old = self._read(where[b] for b in touched if b in where).select(
                    "feed_url", F.struct("scraped", "payload").alias("old"),
                    F.pmod(F.xxhash64("feed_url"), F.lit(self.buckets)).cast("int").alias("bucket"))
                both = old.join(landed, ["feed_url", "bucket"], "full_outer")
                newer = F.col("new").isNotNull() & (F.col("old.payload").isNull() | F.col("old.scraped").isNull() | (
                    F.col("new.scraped") >= F.col("old.scraped")))
                kept = F.when(newer, F.col("new")).otherwise(F.col("old"))
                folder = os.path.join(self.path, "data", f"batch-{batch_id}-{uuid.uuid4().hex}")
                both.select("feed_url", "bucket", kept["scraped"].alias("scraped"), kept["payload"].alias("payload")).repartition(
                    len(touched), "bucket").write.partitionBy("bucket").parquet(folder)
                where.update({b: os.path.join(folder, f"bucket={b}") for b in touched})
            self._publish(batch_id, where)
        finally:
            landed.unpersist()
        self.vacuum()

    def vacuum(self) -> int:
        """Deletes manifests but the ``keep`` newest, and bucket folders that
        none of those names (also of batches that were never published). The
        number of folders deleted."""
        done = self._batches()
        named = {folder for b in done[-self.keep:] for folder in self._manifest(b).values()}
        for b in done[:-self.keep]:
            fs, p = self._fs(os.path.join(self.path, "manifest", f"{b}.json"))
            fs.delete(p, False)
        gone = 0
        fs, p = self._fs(os.path.join(self.path, "data"))
        names = {os.path.join(*folder.split("/")[-2:]) for folder in named}
        for batch in fs.listStatus(p) if fs.exists(p) else []:
            for bucket in fs.listStatus(batch.getPath()):
                name = bucket.getPath().getName()
                if name.startswith("bucket=") and os.path.join(batch.getPath().getName(), name) not in names:
                    gone += bool(fs.delete(bucket.getPath(), True))
        return gone


def start_feed_merge(table: FeedTable, landing_dir: str, checkpoint: str, available_now: bool = True,
                     max_files: int | None = None):
    """The stream of landed JSONL files into ``table``; returns the StreamingQuery."""
    reader = table.spark.readStream.schema(LANDED_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    w = reader.json(landing_dir).writeStream.foreachBatch(table.merge).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
