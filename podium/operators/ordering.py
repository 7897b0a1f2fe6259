"""Exact global ordering without a single-partition window.

``global_row_number`` ranks every row of a DataFrame by a total order:
range-partition on the order key (sampled bounds split even a hot value of
the leading column, because the trailing key columns differ), sort inside each
partition, stamp each row with its in-partition position, cut lineage with a
reliable checkpoint, then add the count of all earlier partitions. Only one
row per partition reaches the driver.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, ship_package

_POS_BITS = 33  # monotonically_increasing_id: partition index << 33 | row position


def _sort_cols(order_cols) -> list[Column]:
    out = []
    for c in order_cols:
        out.append(F.col(c).asc_nulls_last() if isinstance(c, str) else c)
    return out


def global_row_number(df: DataFrame, order_cols, out_col: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based rank of each row by ``order_cols`` (strings sort ascending, nulls
    last; pass Columns for other directions). Rows equal on the whole key get
    distinct consecutive numbers in an arbitrary but consistent order."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _sort_cols(order_cols)
    staged = (df.repartitionByRange(n, *keys)
                .sortWithinPartitions(*keys)
                .withColumn("_mid", F.monotonically_increasing_id()))
    staged = reliable_checkpoint(staged)
    staged = staged.withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
    # One row per partition: bounded by the partition count.
    counts = sorted((r["_pid"], r["c"]) for r in
                    staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("c")).collect())
    offsets, acc = [], 0
    for pid, c in counts:
        offsets.append((int(pid), acc))
        acc += int(c)
    off_df = spark.createDataFrame(offsets or [(0, 0)], "_pid long, _off long")
    pos = F.col("_mid") - F.shiftleft(F.col("_pid"), _POS_BITS)
    return (staged.join(F.broadcast(off_df), "_pid", "inner")
                  .withColumn(out_col, F.col("_off") + pos + F.lit(1))
                  .drop("_pid", "_mid", "_off"))


def prefix_sums(df: DataFrame, group: str, order: str, sum_cols, num_partitions: int | None = None) -> DataFrame:
    """Running sums of ``sum_cols`` within each ``group`` in ``order`` order
    (inclusive), without putting a group into one task: range-partition on
    (group, order), cumulate inside each partition with pandas, then add the
    totals of the same group in all earlier partitions (one row per partition
    and group reaches the driver). ``order`` values should be distinct per
    group (aggregate first)."""
    import pandas as pd

    spark = df.sparkSession
    ship_package(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sum_cols = list(sum_cols)
    staged = (df.repartitionByRange(n, F.col(group).asc_nulls_last(), F.col(order).asc_nulls_last())
                .sortWithinPartitions(F.col(group).asc_nulls_last(), F.col(order).asc_nulls_last())
                .withColumn("_pid", F.spark_partition_id()))
    staged = reliable_checkpoint(staged)
    from pyspark.sql import types as T
    out_schema = T.StructType(list(staged.schema.fields) +
                              [T.StructField("_cum_" + c, T.DoubleType()) for c in sum_cols])

    def local(it):
        for pdf in it:
            if pdf.empty:
                yield pdf.assign(**{"_cum_" + c: pd.Series([], dtype=float) for c in sum_cols})
                continue
            g = pdf.groupby(group, sort=False, dropna=False)
            for c in sum_cols:
                pdf["_cum_" + c] = g[c].cumsum().astype(float)
            yield pdf

    # Batches of one partition arrive in order; carry running sums across them.
    def carried(it):
        carry = {}
        for pdf in local(it):
            if pdf.empty:
                yield pdf
                continue
            for c in sum_cols:
                base = pdf[group].map(lambda k, c=c: carry.get((k, c), 0.0))
                pdf["_cum_" + c] = pdf["_cum_" + c] + base.astype(float)
            last = pdf.groupby(group, sort=False, dropna=False).tail(1)
            for _, r in last.iterrows():
                for c in sum_cols:
                    carry[(r[group], c)] = float(r["_cum_" + c])
            yield pdf

    cum = staged.mapInPandas(carried, out_schema)
    tot = staged.groupBy("_pid", group).agg(*[F.sum(c).cast("double").alias("_t_" + c) for c in sum_cols]).collect()
    rows, run = [], {}
    for r in sorted(tot, key=lambda r: r["_pid"]):
        k = r[group]
        prev = run.get(k, [0.0] * len(sum_cols))
        rows.append((int(r["_pid"]), k, *prev))
        run[k] = [p + float(r["_t_" + c] or 0.0) for p, c in zip(prev, sum_cols)]
    gtype = dict((f.name, f.dataType.simpleString()) for f in staged.schema.fields)[group]
    schema = f"_pid int, {group} {gtype}, " + ", ".join(f"_o_{c} double" for c in sum_cols)
    off = spark.createDataFrame(rows, schema) if rows else spark.createDataFrame([], schema)
    res = cum.join(F.broadcast(off), ["_pid", group], "left")
    for c in sum_cols:
        res = res.withColumn("cum_" + c, F.col("_cum_" + c) + F.coalesce(F.col("_o_" + c), F.lit(0.0)))
    return res.drop("_pid", *[x for c in sum_cols for x in ("_cum_" + c, "_o_" + c)])
