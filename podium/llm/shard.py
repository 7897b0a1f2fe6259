"""Sharding by jump consistent hashing, in DataFrame expressions only.

The jump walk of a key visits ever larger shard numbers; the last one below
the shard count is the key's shard, so one more shard can only pull a key into
itself. The 64-bit linear generator of the published method runs in
decimal(38,0), which holds its products exactly under ANSI arithmetic.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, materialize, tasks

SHARDS = 40
#: Bytes a row costs beside its text.
ROW_BYTES = 16
#: Blocks that equal rows of one id are spread over.
SALTS = 64
# Multiplier of the published jump hash, and 2**64.
_MULTIPLIER = "2862933555777941757"
_WORD = "18446744073709551616"
#: A walk to n shards takes about ln n steps; beyond so many it is refused, never cut.
_MOST_STEPS = 256


def jump_walk(key: Column, shards: int) -> Column:
    """struct(b, j): the shard of ``key`` among ``shards`` and the next shard
    number its walk would visit (>= shards)."""
    wide = lambda s: F.lit(s).cast("decimal(38,0)")
    unsigned = F.when(key < 0, key.cast("decimal(20,0)") + wide(_WORD)).otherwise(key.cast("decimal(20,0)"))
    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
                     unsigned.cast("decimal(38,0)").alias("k"))

    def step(s: Column, _: Column) -> Column:
        k = ((s["k"] * wide(_MULTIPLIER) + wide("1")) % wide(_WORD)).cast("decimal(38,0)")
        top = F.floor(k.cast("decimal(20,0)") / F.lit("8589934592").cast("decimal(10,0)")).cast("double")
        jump = F.floor((s["j"] + 1).cast("double") * (F.lit(2147483648.0) / (top + 1.0))).cast("long")
        return F.when(s["j"] < shards, F.struct(s["j"].alias("b"), jump.alias("j"), k.alias("k"))).otherwise(s)

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, _MOST_STEPS))), start, step)
    return F.when(walked["j"] >= shards, walked).otherwise(F.raise_error(F.lit("jump walk did not end")))


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row.

    ``law`` is ``key``: id and shard count alone decide the shard;
    ``grown_shard`` is the shard with one more. ``slot`` numbers a shard's rows
    from 0 without gaps. Size: UTF-8 bytes of the text (null: none) plus 16.
    Rows repeating an id share its shard and get their own slots; null ids
    share one shard. An empty table gives an empty result.

    Slots need no shard in one task: rows of a shard are numbered inside
    blocks and moved up by the counts of the blocks before. A block is a hash
    of id, text and a salt, so neither one id nor one text fills a block.
    """
    spark = docs.sparkSession
    blocks = 4 * tasks(spark)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-1).cast("long"))
    body = F.coalesce(F.col(text_col), F.lit(""))
    crc = F.crc32(body.cast("binary"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
                       crc.alias("text_crc32"), jump_walk(key, shards).alias("_w"),
                       F.pmod(F.xxhash64(key, crc, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))), F.lit(blocks)).cast("int").alias("_block"))
    rows = materialize(rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("_w.b").cast("int").alias("shard"),
        F.when(F.col("_w.j") == shards, F.lit(shards)).otherwise(F.col("_w.b")).cast("int").alias("grown_shard"), "_block"), "shard-rows")
    counts = rows.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # shards x blocks rows at most, whatever the input
    offsets = counts.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_block").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("_i", F.row_number().over(inside)).join(F.broadcast(offsets), ["shard", "_block"]).select(
        "doc_id", "size", "text_crc32", "law", "shard",
        (F.col("_before") + F.col("_i") - 1).cast("long").alias("slot"), "grown_shard")


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))


QUERIES = {"op3_shard": op3_shard}
SQL: dict[str, str] = {}
