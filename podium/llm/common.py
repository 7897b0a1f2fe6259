"""Helpers shared by the training-data operators.

The numpy half works on whole Arrow batches of UTF-8 text: words and their
64-bit hashes come from a handful of array passes instead of a Python loop per
word. Word boundaries are the six ASCII blanks (space, tab, LF, VT, FF, CR);
lower-casing touches A-Z only, so both are byte operations.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from ..sources.views import table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of text that one numpy pass works on; a longer document is one pass.
PASS_BYTES = 1 << 20
#: Bytes of an Arrow batch that goes to Python (at least one row).
BATCH_BYTES = 8 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def lower_az(c) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit("")), UPPER, UPPER.lower())


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns beside the columns of ``df``, whatever those are called."""
    have = {c.lower() for c in df.columns}
    tail = ""
    while any((n + tail).lower() in have for n in names):
        tail += "_"
    return [n + tail for n in names]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: lineage is cut and
    later jobs see exactly these rows, whatever happens to executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` in batches of bounded bytes; memory that a task's
    batches held goes back when it ends."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches):
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
_LOWER_CODE = _BYTE_CODE[_LOWER]
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown to the longest pass so far."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, PASS_BYTES)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 4 * PASS_BYTES:      # keep the usual size only
            _POWERS[base] = have
    return have


#: Spans of more codes than this are hashed one by one (see ``span_hashes``).
LONG_SPAN = 64


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of codes[start:end] for every span, independent of where in
    the pass it lies. Short spans come from one prefix sum of a polynomial.
    Modulo 2**64 that is weak for long spans (Thue-Morse words of 1,024 codes
    meet under every base), so these few are hashed by their content."""
    n = len(codes)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(codes * _powers(_BASE, n + 1)[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _powers(_BASE_INV, n + 1)[starts]
    h = mix64(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    for i in np.flatnonzero(ends - starts > LONG_SPAN).tolist():
        h[i] = xxhash.xxh3_64_intdigest(codes[starts[i]:ends[i]].tobytes(), seed=7)
    return h


def distinct_spans(codes: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(first, back): one span of each distinct content, and for every span the
    number of its content. Hashes only sort; contents are compared."""
    _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    length, like = ends - starts, first[back]
    exact = bool((length == length[like]).all())
    sums, at = np.concatenate([[0], np.cumsum(length)]), 0
    while exact and at < len(length):           # spans of about one pass at a time
        to = max(at + 1, int(np.searchsorted(sums, sums[at] + PASS_BYTES, "right")) - 1)
        n = length[at:to]
        offset = np.arange(sums[to] - sums[at]) - np.repeat(sums[at:to] - sums[at], n)
        exact = bool((codes[np.repeat(starts[at:to], n) + offset] == codes[np.repeat(starts[like[at:to]], n) + offset]).all())
        at = to
    if exact:
        return first, back
    seen: dict[bytes, int] = {}
    back = np.array([seen.setdefault(codes[a:z].tobytes(), len(seen)) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)])
    return np.unique(back, return_index=True)[1], back


def text_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each row (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offsets = np.frombuffer(off, kind)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def passes(offsets: np.ndarray, limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a row is never cut."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, row) of every word; rows never share a word."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_BLANK[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    before[cuts[cuts < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))


def hashed_words(data: np.ndarray, offsets: np.ndarray):
    """(hash, row) of every lower-cased word of the rows of one pass."""
    starts, ends, row = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), row
    return span_hashes(_LOWER_CODE[data], starts, ends), row


def words_by_pass(col):
    """For each pass over a text column: (first row, end row, hashes, row - first row)."""
    data, offsets = text_buffers(col)
    for i, j in passes(offsets):
        a, b = offsets[i], offsets[j]
        h, row = hashed_words(data[a:b], offsets[i:j + 1] - a)
        yield i, j, h, row
