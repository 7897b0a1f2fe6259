"""Seeded sampling without collecting anything: weighted per-group samples
(Efraimidis-Spirakis keys) and exact-size samples ordered by a seeded hash.
Keys come from a hash of the row's identity, so a sample does not depend on
partitioning or on re-execution after a lost executor."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import global_row_number

_MANTISSA = 2 ** 53


def uniform01(seed: int, *cols) -> "F.Column":
    """A uniform number in (0, 1) from a seeded 64-bit hash of ``cols``."""
    h = F.xxhash64(F.lit(int(seed)), *[F.col(c) if isinstance(c, str) else c for c in cols])
    m = F.pmod(h, F.lit(_MANTISSA)).cast("double")
    return (m + F.lit(0.5)) / F.lit(float(_MANTISSA))


def weighted_sample(df: DataFrame, group: str, item: str, weight: str, n, seed: int = 42,
                    out_col: str = "sample_rank") -> DataFrame:
    """G1: per group, ``n`` items without replacement with probability
    proportional to ``weight`` (fewer if the group is smaller); zero and NULL
    weights are never drawn. Key ``-ln(u) / w``, smallest keys win; the
    per-group limit is applied map-side before the shuffle."""
    u = uniform01(seed, group, item)
    keyed = df.where(F.col(weight) > 0).withColumn("_key", -F.log(u) / F.col(weight))
    rn = F.row_number().over(Window.partitionBy(group).orderBy(F.col("_key").asc(), F.col(item).asc()))
    n_col = F.col(n) if isinstance(n, str) else F.lit(int(n))
    return keyed.withColumn(out_col, rn).where(F.col(out_col) <= n_col).drop("_key")


#: Bits of the hash that one histogram looks at, and rows that a boundary bucket may hold before it is split further.
_DIGIT, _SORTED_ROWS = 16, 100_000


def downsample(df: DataFrame, n: int, key_cols, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, those of the smallest seeded hash
    of ``key_cols`` (ties by the keys), independent of layout.

    Radix selection: a histogram of the hash's leading bits (at most 2**16
    rows) names the bucket in which the n-th row lies; a bucket of many rows is
    split by the next bits. Rows below it are in, and only the bucket itself is
    sorted, by a distributed rank, so the table is never shuffled."""
    n = int(n)
    h = F.xxhash64(F.lit(int(seed)), *[F.col(c) for c in key_cols])
    bits, bound, missing, inside = 0, 0, n, F.lit(True)
    while True:
        bits += _DIGIT
        digit = F.shiftright(h, 64 - bits)
        counts = sorted((r["d"], r["n"]) for r in df.where(inside).groupBy(digit.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect())
        for bound, rows in counts:
            if rows > missing:
                break
            missing -= rows
        else:
            return df                           # fewer rows than asked for (first histogram only)
        inside = digit == F.lit(bound)
        if rows <= _SORTED_ROWS or bits == 64 or missing == 0:
            break
    below = df.where(digit < F.lit(bound))
    if missing == 0:
        return below
    order = [h.asc()] + [F.col(c).asc_nulls_last() for c in key_cols]
    edge = global_row_number(df.where(inside), order, out_col="_rn").where(F.col("_rn") <= missing).drop("_rn")
    return below.unionByName(edge)
