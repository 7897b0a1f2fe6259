"""Context-triggered piecewise hashing of documents.

A 7-byte rolling hash looks for boundaries: a byte ends a piece where the
rolling value is block size - 1 modulo the block size. Each piece gives one
letter (6 bits of its hash), so an edit changes only the letters around it. A
fingerprint holds the signatures of a block size and of twice that size;
signatures of equal block sizes are compared by edit distance (insertions and
deletions), if they share a run of seven letters.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _BYTE_CODE, documents, map_arrow, span_hashes, tasks

WINDOW = 7
LEAST_BLOCK = 3
LETTERS = 64
# The 64 signature letters.
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _rolling(data: np.ndarray) -> np.ndarray:
    """Rolling value after each byte: sum, position-weighted sum and shifted
    xor of the last seven bytes, added up in 32 bits."""
    n = len(data)
    d = np.zeros(n + WINDOW - 1, np.uint32)
    d[WINDOW - 1:] = data
    total = np.zeros(n, np.uint32)
    shifted = np.zeros(n, np.uint32)
    for back in range(WINDOW):
        part = d[WINDOW - 1 - back:WINDOW - 1 - back + n]
        total += part * np.uint32(1 + WINDOW - back)
        shifted ^= part << np.uint32(5 * back) if 5 * back < 32 else np.uint32(0)
    return total + shifted


def _signature(codes: np.ndarray, roll: np.ndarray, block: int) -> str:
    """One letter per piece; the last piece ends with the text. At most
    LETTERS pieces: the pieces after the last but one join to one."""
    ends = np.flatnonzero(roll % np.uint32(block) == np.uint32(block - 1)) + 1
    ends = ends[:LETTERS - 1]
    if len(ends) == 0 or ends[-1] != len(codes):
        ends = np.append(ends, len(codes))
    starts = np.concatenate([[0], ends[:-1]])
    h = span_hashes(codes, starts, ends)
    return ALPHABET[(h >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str | None) -> str:
    """``block:signature:signature at twice the block``; ``0::`` for no text."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data)
    if n == 0:
        return "0::"
    roll = _rolling(data)
    codes = _BYTE_CODE[data]
    block = LEAST_BLOCK
    while block * LETTERS < n:
        block *= 2
    sig = _signature(codes, roll, block)
    while len(sig) < LETTERS // 2 and block > LEAST_BLOCK:      # few boundaries at this size
        block //= 2
        sig = _signature(codes, roll, block)
    return f"{block}:{sig}:{_signature(codes, roll, 2 * block)}"


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, 64 columns per integer step."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & where.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def _similarity(a: str, b: str) -> float:
    """1 - edit distance / joint length; 0 without a common run of letters."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    k = min(WINDOW, len(a), len(b))
    grams = {a[i:i + k] for i in range(len(a) - k + 1)}
    if not any(b[i:i + k] in grams for i in range(len(b) - k + 1)):
        return 0.0
    return 2.0 * _common(a, b) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1: the best similarity of signatures made at equal block sizes; 1
    for equal fingerprints, 0 where the block sizes do not meet."""
    if x == y:
        return 1.0
    bx, sx, tx = x.split(":")
    by, sy, ty = y.split(":")
    bx, by = int(bx), int(by)
    if bx == 0 or by == 0:
        return 0.0
    if bx == by:
        return max(_similarity(sx, sy), _similarity(tx, ty))
    if bx == 2 * by:
        return _similarity(sx, ty)
    if by == 2 * bx:
        return _similarity(tx, sy)
    return 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of each whole text."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([fingerprint(t) for t in b.column(1).to_pylist()], pa.string())],
                ["doc_id", "fingerprint"])
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col), run,
                     "doc_id long, fingerprint string")


def _bucketed(docs: DataFrame, n: int):
    """Rows with the range bucket of their id, and the first id of each bucket.

    The bounds are quantiles of the ids (one number per bucket reaches the
    driver). Null ids come first, in bucket 0."""
    spark = docs.sparkSession
    bounds = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10000).alias("q")).head()["q"] if n > 1 else []
    cuts = np.array(sorted(set(bounds or [])), np.int64)

    @F.pandas_udf(T.IntegerType())
    def bucket(ids):
        import pandas as pd
        got = np.searchsorted(cuts, ids.fillna(0).to_numpy().astype(np.int64), "right")
        return pd.Series(np.where(ids.isna(), 0, got).astype(np.int32))

    return docs.withColumn("_b", bucket("doc_id") if len(cuts) else F.lit(0)), spark


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text is the text with its last floor(n/2) code points replaced
    by the first as many (or all) of the next row by ascending id (null ids
    first, ties by text); the last row's next is the first row. Null counts as
    empty: it stays empty and its fingerprint is ``0::``. A single row is its
    own next; an empty table gives an empty result.

    Rows are dealt by id range; the only row a range needs from outside is the
    first of the next one, so one row per range is copied to the range before.
    """
    spark = docs.sparkSession
    n = tasks(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows, spark = _bucketed(base, n)
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    # one id per bucket: the driver links each bucket to the next that has rows
    firsts = sorted((r["_b"], r["m"], r["z"]) for r in rows.groupBy("_b").agg(
        F.min("doc_id").alias("m"), F.max(F.col("doc_id").isNull().cast("int")).alias("z")).collect())
    if not firsts:
        return spark.createDataFrame([], _SCHEMA)
    heads = [(None if z else m, firsts[i - 1][0] if i else firsts[-1][0], int(i == 0)) for i, (_, m, z) in enumerate(firsts)]
    heads = spark.createDataFrame(heads, "h long, hb int, wraps int")
    found = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("h")))
    # of rows repeating a first id, the first by text
    ahead = found.groupBy("hb").agg(F.min(F.struct("text", "doc_id")).alias("s"))
    ahead = ahead.select(F.col("s.doc_id").alias("doc_id"), F.col("s.text").alias("text"), F.col("hb").alias("_b"),
                         F.lit(1).alias("_ahead"))
    prints = _with_prints(rows.select("doc_id", "text", "_b", F.lit(0).alias("_ahead")).unionByName(ahead))
    w = Window.partitionBy("_b").orderBy("_ahead", *order)
    chars = F.char_length("text")
    half = F.floor(chars / 2).cast("int")
    pairs = prints.withColumns({"_nt": F.lead("text").over(w), "_nf": F.lead("fingerprint").over(w)}).where(
        "_ahead = 0").select("doc_id", chars.cast("long").alias("n_chars"), F.concat(
            F.substring("text", F.lit(1), chars - half), F.substring("_nt", F.lit(1), half)).alias("edited"),
        "fingerprint", "_nf")

    def run(batches):
        for b in batches:
            edited, own, nxt = (b.column(i).to_pylist() for i in (2, 3, 4))
            import hashlib
            prints = [fingerprint(t) for t in edited]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pc.cast(b.column(3), pa.string()), pa.array(prints, pa.string()),
                pa.array([likeness(x, y) for x, y in zip(own, prints, strict=True)], pa.float64()),
                pa.array([likeness(x, y) for x, y in zip(own, nxt, strict=True)], pa.float64())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
    return map_arrow(pairs, run, _SCHEMA)


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _with_prints(df: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            prints = pa.array([fingerprint(t) for t in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, prints], [*b.schema.names, "fingerprint"])
    return map_arrow(df, run, "doc_id long, text string, _b int, _ahead int, fingerprint string")


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(documents(spark, sf_dir))


QUERIES = {"op9_fingerprint": op9_fingerprint}
SQL: dict[str, str] = {}
