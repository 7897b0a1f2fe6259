"""Monitoring from day-wise state: exact counts per (day, feature, value).

Counts of days add up, so the profile (D4) and the bins (D1) of any window
(D7) come from the state of its whole days plus a scan of the raw rows of its
two edge days, with both bounds pushed to the scan. A day that is landed again
replaces its own partition. Missing values (NULL and NaN) are counted as such.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clean_double, instant
from . import monitor

_VALUE = ["feature", "num", "cat"]


def day_counts(rows: DataFrame, ts_col: str, numeric, categorical) -> DataFrame:
    """``day, feature, num, cat, cnt``: how often each value occurs on each day;
    a missing value is the row with neither. Rows without a time belong to no day."""
    args = []
    for f in numeric:
        args += [F.lit(f), clean_double(f), F.lit(None).cast("string")]
    for f in categorical:
        args += [F.lit(f), F.lit(None).cast("double"), F.col(f).cast("string")]
    n = len(numeric) + len(categorical)
    long = rows.where(F.col(ts_col).isNotNull()).select(
        F.to_date(ts_col).alias("day"), F.stack(F.lit(n), *args).alias(*_VALUE))
    return long.groupBy("day", *_VALUE).agg(F.count(F.lit(1)).alias("cnt"))


def write_days(counts: DataFrame, path: str) -> None:
    """Adds days to the state at ``path``; a day that is there is replaced, all others stay."""
    counts.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def window_counts(state: DataFrame, rows: DataFrame, ts_col: str, numeric, categorical, start: dt.datetime, end: dt.datetime | None) -> DataFrame:
    """``feature, num, cat, cnt`` of the window [start, end) (UTC; no end: open)."""
    day = dt.timedelta(days=1)
    midnight = lambda t: dt.datetime.combine(t.date(), dt.time())
    first = midnight(start) if start == midnight(start) else midnight(start) + day
    last = None if end is None else midnight(end)
    kind = dict(rows.dtypes)[ts_col]
    at = lambda t: instant(int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000), kind)
    t = F.col(ts_col)
    if last is not None and last < first:       # within one day
        edges, whole = (t >= at(start)) & (t < at(end)), state.limit(0)
    else:
        edges = (t >= at(start)) & (t < at(first))
        whole = state.where(F.col("day") >= F.lit(first.date()))
        if last is not None:
            edges = edges | ((t >= at(last)) & (t < at(end)))
            whole = whole.where(F.col("day") < F.lit(last.date()))
    parts = whole.select(*_VALUE, "cnt").unionByName(day_counts(rows.where(edges), ts_col, numeric, categorical).select(*_VALUE, "cnt"))
    return parts.groupBy(*_VALUE).agg(F.sum("cnt").alias("cnt"))


def profile(counts: DataFrame, side: str, numeric) -> DataFrame:
    """D4 of one window: the rows of ``monitor.quality_profile``."""
    n = F.col("cnt")
    present = F.col("num").isNotNull() | F.col("cat").isNotNull()
    base = counts.groupBy("feature").agg(
        F.sum(n).alias("n_rows"), F.coalesce(F.sum(F.when(~present, n)), F.lit(0)).alias("n_null"),
        F.count_if(present).alias("n_distinct"), F.min("num").alias("min_value"), F.max("num").alias("max_value"),
        F.try_divide(F.sum(F.col("num") * n), F.sum(F.when(F.col("num").isNotNull(), n))).alias("mean_value"))
    # one row per feature
    spread = counts.join(F.broadcast(base.select("feature", "mean_value")), "feature").where("num is not null").groupBy("feature").agg(
        F.sqrt(F.try_divide(F.sum(n * (F.col("num") - F.col("mean_value")) ** 2), F.sum(n) - 1)).alias("std_value"))
    return base.join(F.broadcast(spread), "feature", "left").select(
        F.lit(side).alias("side"), "feature", "n_rows", "n_null", "n_distinct", "min_value", "max_value", "mean_value", "std_value")


def psi(reference: DataFrame, current: DataFrame, features, bins: int = monitor.PSI_BINS) -> DataFrame:
    """D1 of two windows: the rows of ``monitor.psi``."""
    side = lambda df: df.where(F.col("num").isNotNull() & F.col("feature").isin(list(features))).select(
        "feature", F.col("num").alias("value"), F.col("cnt").alias("n"))
    return monitor.psi_of_values(side(reference), side(current), bins)


def labelled_windows(rows: DataFrame, ts_col: str = "ts", current_days: int = monitor.CURRENT_WINDOW_DAYS,
                     reference_days: int = monitor.REFERENCE_WINDOW_DAYS):
    """(reference start, current start) of the newest row; None without rows."""
    top = rows.agg(F.unix_micros(F.max(F.col(ts_col).cast("timestamp")))).first()[0]
    if top is None:
        return None
    now = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=top)
    return now - dt.timedelta(days=current_days + reference_days), now - dt.timedelta(days=current_days)

