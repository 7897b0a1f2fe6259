"""A versioned vector store: an encoder is fitted once and frozen under a
version; vectors are keyed by (version, text) in a table bucketed by the key.

A vector depends on the version and the text alone, so equal texts share one,
a new item encodes one row, and a changed fit is a new version beside the old
one. Lookups join the items' keys with the bucketed table: only the narrow key
side is shuffled, to the buckets, never the vectors.
"""
from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


class VectorStore:
    """``path`` lies in a shared folder. ``buckets`` is fixed when a version's
    table is made; ``load`` reads back what ``encoder.save(path)`` wrote."""

    def __init__(self, spark: SparkSession, path: str, load, buckets: int = 64):
        self.spark, self.path, self.load, self.buckets = spark, path, load, buckets

    def freeze(self, version: str, encoder, texts: DataFrame) -> None:
        """Fits ``encoder`` on ``texts`` and keeps it as ``version``; a version
        that exists stays as it is."""
        at = os.path.join(self.path, "encoders", version)
        if not _exists(self.spark, at):
            if getattr(encoder, "model", None) is None:
                encoder.fit(texts.select("text"))
            encoder.save(at)

    def encoder(self, version: str):
        return self.load(os.path.join(self.path, "encoders", version))

    def vectors(self, version: str) -> DataFrame:
        """``text_sha, embedding`` of a version; its bucketed table is named in
        this session's catalog when first asked for."""
        return self.spark.table(self._table(version))

    def _table(self, version: str) -> str:
        at = os.path.join(self.path, "vectors", version)
        name = "vectors_" + hashlib.sha256(at.encode()).hexdigest()[:16]
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (text_sha STRING, embedding ARRAY<FLOAT>) USING parquet "
                       f"CLUSTERED BY (text_sha) INTO {int(self.buckets)} BUCKETS LOCATION '{at}'")
        return name

    def missing(self, texts: DataFrame, version: str) -> DataFrame:
        """``text_sha, text``: each text that has no vector yet, once."""
        keyed = texts.select(F.sha2("text", 256).alias("text_sha"), "text").where("text is not null").dropDuplicates(["text_sha"])
        return keyed.join(self.vectors(version).select("text_sha"), "text_sha", "left_anti")

    def embed(self, texts: DataFrame, version: str, id_col: str = "podcast_id") -> DataFrame:
        """``id, embedding`` of every row of ``texts`` (id, text); missing
        vectors are encoded and appended first. A null text has no vector."""
        name = self._table(version)
        fresh = self.encoder(version).transform(self.missing(texts, version), "text_sha")
        fresh.select("text_sha", F.col("embedding").cast("array<float>")).repartition(self.buckets, "text_sha").write.mode(
            "append").format("parquet").bucketBy(self.buckets, "text_sha").saveAsTable(name)
        return self.lookup(texts, version, id_col)

    def lookup(self, texts: DataFrame, version: str, id_col: str = "podcast_id") -> DataFrame:
        """``id, embedding`` of the rows whose text has a vector; encodes nothing."""
        keyed = texts.select(id_col, F.sha2("text", 256).alias("text_sha"))
        return keyed.join(self.vectors(version), "text_sha").select(id_col, "embedding")
