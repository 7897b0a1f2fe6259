"""Mixing sources to target weights by weighted fair queueing.

Each source queues its documents in a seeded shuffle, up to three times over.
A queued copy finishes at virtual time (words of its source up to its end) /
(target of its source); copies go out in order of virtual finish time until
the total budget is spent. At virtual time 1 every source has sent its target.

Both running sums are taken without one task per source: the shuffle key and
the virtual time are near uniform, so equal-width buckets split them evenly; a
bucket is summed in place and moved up by the totals of the buckets before.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, free_names, materialize, tasks

WEIGHTS = (1, 2, 3)
REPEATS = 3
SEED = "mix-1"
_SPACE = float(1 << 60)


def source_targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, target`` from (source, size) rows.

    Sources by code point, null last, take the weights in turn and share all
    words; a share stops at ``repeats`` times the source's size and the excess
    goes to the others by weight until none is above. Closed form: sources in
    order of cap / weight stop one after the other, the rest share by weight.
    Works on one row per source.
    """
    s = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    every, upto = Window.partitionBy(F.lit(1)), fill.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({"_caps": F.coalesce(F.sum("cap").over(upto), F.lit(0.0)),
                       "_ws": F.coalesce(F.sum("w").over(upto), F.lit(0.0)),
                       "_t": F.sum("source_size").over(every).cast("double"), "_w": F.sum("w").over(every)})
    level = (F.col("_t") - F.col("_caps")) / (F.col("_w") - F.col("_ws"))
    s = s.withColumn("_level", level).withColumn(
        "_final", F.max("_level").over(every))      # the level rises up to the first source that has room
    return s.select("source", "source_size", F.least(F.col("cap"), F.col("_final") * F.col("w")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, repeats: int = REPEATS, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, source`` per row.

    Size is the number of words (null text: 0); ``taken`` = size x copies. A
    row of size 0 is never taken. The shuffle key is a hash of seed and id, so
    reruns agree (null ids: of the text); rows repeating an id queue next to each other by size. An
    empty table, or one without words, takes nothing.
    """
    spark = docs.sparkSession
    n = tasks(spark)
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    # rows without an id queue by their text, so that they are no single key
    own = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("-:"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)))
    key = F.md5(F.concat(F.lit(seed + ":"), own))
    rows = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                                   words.alias("size"),
                                   F.conv(F.substring(key, 1, 15), 16, 10).cast("long").alias("k")), "mix-sizes")
    targets = materialize(source_targets(rows, weights, repeats), "mix-targets")
    rows = rows.withColumn("b", F.floor(F.col("k") / F.lit(_SPACE) * n).cast("int"))
    # 1. words of the same source up to each document's end, in shuffle order
    by_bucket = rows.groupBy("source", "b").agg(F.sum("size").alias("t"))
    before = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_bucket.select(F.col("source").alias("s"), F.col("b").alias("sb"),
                              F.coalesce(F.sum("t").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "b").orderBy("k", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    at = rows.withColumn("run", F.sum("size").over(inside)).join(
        starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("b") == F.col("sb"))).drop("s", "sb")
    at = at.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    at = materialize(at.select("doc_id", "source", "size", "source_size", "target", "k",
                               (F.col("start") + F.col("run")).alias("end")), "mix-queue")
    # 2. the queued copies, in order of virtual finish time, up to the budget
    queue = at.where("size > 0").select(
        "doc_id", "source", "size", "k", "target", "end", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("lap"),
        "source_size").select(
        "doc_id", "source", "size", "k", "lap",
        ((F.col("lap") * F.col("source_size") + F.col("end")).cast("double") / F.col("target")).alias("finish"))
    queue = queue.withColumn("fb", F.floor(F.least(F.col("finish"), F.lit(2.0)) * n).cast("int"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("budget"))
    line = Window.orderBy("fb").rowsBetween(Window.unboundedPreceding, -1)      # one row per bucket
    fronts = queue.groupBy("fb").agg(F.sum("size").alias("t")).select(
        F.col("fb").alias("qb"), F.coalesce(F.sum("t").over(line), F.lit(0)).alias("sent"))
    fronts = fronts.crossJoin(F.broadcast(total)).where("sent < budget")        # one total beside each bucket
    order = Window.partitionBy("fb").orderBy("finish", "source", "k", "doc_id", "size", "lap").rowsBetween(
        Window.unboundedPreceding, 0)
    sent = queue.join(F.broadcast(fronts), F.col("fb") == F.col("qb")).withColumn(
        "upto", F.col("sent") + F.sum("size").over(order)).where("upto <= budget")
    copies = sent.groupBy("doc_id", "source", "size", "k").agg(F.count(F.lit(1)).alias("c"))
    # rows repeating id, source and size share their copies evenly, none above the repeats
    same = Window.partitionBy("doc_id", "source", "size", "k").orderBy("end")
    numbered = at.withColumns({"_i": F.row_number().over(same) - 1,
                               "_n": F.count(F.lit(1)).over(same.rowsBetween(Window.unboundedPreceding,
                                                                             Window.unboundedFollowing))})
    c = copies.select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("z"),
                      F.col("k").alias("ck"), "c")
    out = numbered.join(c, (F.col("doc_id").eqNullSafe(F.col("d"))) & F.col("source").eqNullSafe(F.col("s"))
                        & (F.col("size") == F.col("z")) & (F.col("k") == F.col("ck")), "left")
    share = F.floor((F.coalesce(F.col("c"), F.lit(0)) + F.col("_n") - 1 - F.col("_i")) / F.col("_n")).cast("long")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * share).alias("taken"),
                      share.alias("copies"), "source")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it, columns untouched.

    Rows that repeat id, source and size are alike to the mix: they are numbered
    and take its answers in turn. Rows alike in every column add theirs up."""
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    a, b, c, i = free_names(docs, "_a", "_b", "_c", "_i")
    whole = [docs[x] for x in docs.columns] + [docs[x].isNull() for x in docs.columns]
    keyed = docs.withColumns({a: F.xxhash64(*whole), b: F.xxhash64(F.lit(1), *whole)})
    rows = keyed.select(F.col(id_col).cast("long").alias("d"), F.col(source_col).alias("s"), words.alias("z"),
                        F.col(a).alias("a"), F.col(b).alias("b"))
    rows = rows.withColumn("i", F.row_number().over(Window.partitionBy("d", "s", "z").orderBy("a", "b")))
    taken = mix(docs, id_col, text_col, source_col).where("copies > 0")
    taken = taken.withColumn("j", F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy(F.desc("copies"))))
    found = rows.join(taken, F.col("d").eqNullSafe(F.col("doc_id")) & F.col("s").eqNullSafe(F.col("source"))
                      & (F.col("z") == F.col("size")) & (F.col("i") == F.col("j")))
    copies = found.groupBy(F.col("a").alias(a), F.col("b").alias(b)).agg(F.sum("copies").cast("int").alias(c))
    out = keyed.dropDuplicates([a, b]).join(copies, [a, b])
    return out.withColumn(i, F.explode(F.sequence(F.lit(1), F.col(c)))).drop(a, b, c, i)


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).drop("source", "copies")


SQL = {"op10_mix": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-1:' || CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS k FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
s AS (SELECT source, source_size, 3.0 * CAST(source_size AS DOUBLE) AS cap,
             CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS w FROM s0),
f AS (SELECT *, coalesce(sum(cap) OVER o, 0) AS caps, coalesce(sum(w) OVER o, 0) AS ws,
             CAST(sum(source_size) OVER () AS DOUBLE) AS t, sum(w) OVER () AS wt FROM s
      WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (t - caps) / (wt - ws) AS level FROM f),
g AS (SELECT *, max(level) OVER () AS final FROM l),
tg AS (SELECT source, source_size, least(cap, final * w) AS target FROM g),
q AS (SELECT d.doc_id, d.source, d.size, d.k, source_size, target,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS fin
      FROM d JOIN tg ON d.source IS NOT DISTINCT FROM tg.source),
c AS (SELECT q.*, lap, CAST(lap * source_size + fin AS DOUBLE) / target AS finish
      FROM q, (SELECT unnest([0, 1, 2]) AS lap) WHERE size > 0),
u AS (SELECT *, sum(size) OVER (ORDER BY finish, source, k, doc_id, size, lap ROWS UNBOUNDED PRECEDING) AS upto FROM c),
n AS (SELECT doc_id, count(*) AS copies FROM u WHERE upto <= (SELECT sum(size) FROM d) GROUP BY 1)
SELECT q.doc_id, size, source_size, target, CAST(size * coalesce(copies, 0) AS BIGINT) AS taken
FROM q LEFT JOIN n ON q.doc_id = n.doc_id"""}
QUERIES = {"op10_mix": op10_mix}
