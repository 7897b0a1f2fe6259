"""Exact dedup by a tree merge of sorted digest runs.

Every scan partition becomes a sorted run of (digest, id) records. The runs
then meet in rounds on a fan-in-m binomial tree: in round r the partners whose
partition numbers differ only in base-m digit r exchange those parts of their
runs whose digest addresses carry the partner's digit; each partner merges the
m sorted parts it gets and keeps one record per digest (the winner and a
count). After the last round a digest lives in the one partition of its
address. A group of copies of any size is one record per run from the first
merge on, so no task ever gathers a hot group. The answers go back over
(run, digest) keys, which hold at most one scan partition's rows.

A merge is *verified*: records join only where SHA-256, byte length and a
second independent 64-bit hash of the normalised text all agree.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free_names, lower_az, map_arrow, materialize, tasks

FAN_IN = 8
_KEY = ["digest", "n_bytes", "check"]
_RUN = "node long, digest binary, n_bytes long, check long, best_id long, best_row long, copies long"


def _merge(batches):
    """Streaming merge of one partition's records, sorted by key and then by
    winner first: the first record of a key wins, copies add up."""
    schema = pa.schema([("node", pa.int64()), ("digest", pa.binary()), ("n_bytes", pa.int64()),
                        ("check", pa.int64()), ("best_id", pa.int64()), ("best_row", pa.int64()),
                        ("copies", pa.int64())])
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch]).select(schema.names).cast(schema)
        if held is not None:
            t = pa.concat_tables([held, t])
        n = t.num_rows
        if n == 0:
            continue
        fresh = np.zeros(n, bool)
        fresh[0] = True
        for c in _KEY:
            col = t[c].combine_chunks()
            fresh[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(fresh)
        total = np.add.reduceat(t["copies"].to_numpy(), first)
        out = t.take(pa.array(first)).set_column(6, "copies", pa.array(total))
        held = out.slice(out.num_rows - 1)      # may go on in the next batch
        yield from out.slice(0, out.num_rows - 1).to_batches()
    if held is not None:
        yield from held.to_batches()


def _merged(runs: DataFrame, nodes: int, largest: bool) -> DataFrame:
    best = F.col("best_id").desc_nulls_last() if largest else F.col("best_id").asc_nulls_last()
    dealt = runs.repartitionById(nodes, F.col("node").cast("int")).sortWithinPartitions(
        *_KEY, best, F.col("best_row"))
    return map_arrow(dealt.select("node", *_KEY, "best_id", "best_row", "copies"), _merge, _RUN)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null is the empty
    text. ``keep`` names the winner of a group: ``smallest`` or ``largest`` id;
    of rows repeating the winning id exactly one is kept. Null ids lose to any
    other; a group with null ids only keeps one row with a null ``keep_id``.
    An empty table gives an empty result. Other columns are not touched.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    spark = docs.sparkSession
    nodes = fan_in ** max(1, math.ceil(math.log(max(2, tasks(spark)), fan_in) - 1e-9))
    norm = lower_az(text_col)
    narrow = materialize(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(F.sha2(norm, 256)).alias("digest"),
        F.octet_length(norm).cast("long").alias("n_bytes"),
        F.xxhash64(norm).alias("check"),
        F.spark_partition_id().cast("long").alias("run"),
        F.monotonically_increasing_id().alias("row")), "exact-digests")
    runs = narrow.select(F.pmod("run", F.lit(nodes)).alias("node"), *_KEY, F.col("doc_id").alias("best_id"),
                         F.col("row").alias("best_row"), F.lit(1).cast("long").alias("copies"))
    runs = _merged(runs, nodes, keep == "largest")              # round 0: a sorted run per scan partition
    address = F.pmod(F.col("check"), F.lit(nodes))
    step = 1
    while step < nodes:
        digit = lambda c: F.pmod(F.floor(c / F.lit(step)), F.lit(fan_in))  # noqa: B023,E731
        runs = _merged(runs.withColumn("node", (F.col("node") + (digit(address) - digit(F.col("node"))) * F.lit(step))
                                       .cast("long")), nodes, keep == "largest")
        step *= fan_in
    groups = runs.select(*_KEY, F.col("best_id").alias("keep_id"), F.col("best_row"), F.col("copies").alias("group_size"))
    per_run = narrow.groupBy("run", *_KEY).agg(F.count(F.lit(1)).alias("_n"))
    answers = per_run.join(groups, _KEY).select("run", *_KEY, "keep_id", "best_row", "group_size")
    return narrow.join(answers, ["run", *_KEY]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("best_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, all their columns untouched. Rows that
    repeat both id and text are one document, of which one row stays."""
    i0, s0, i1, s1 = free_names(docs, "_row_id", "_row_sha", "_kept_id", "_kept_sha")
    kept = exact_groups(docs, id_col, text_col, keep).where("kept").select(
        F.col("doc_id").alias(i1), F.col("text_sha256").alias(s1))
    keyed = docs.withColumns({i0: F.col(id_col).cast("long"), s0: F.sha2(lower_az(text_col), 256)})
    stay = keyed.join(kept, F.col(i0).eqNullSafe(F.col(i1)) & (F.col(s0) == F.col(s1)), "left_semi")
    return stay.dropDuplicates([i0, s0]).drop(i0, s0)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir), keep="largest")


SQL = {"op1_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
     g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)"""}
QUERIES = {"op1_exact_dedup": op1_exact_dedup}
