"""Day-wise monitoring state against the one-scan forms."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from podium.operators import daily, monitor

T0 = dt.datetime(2024, 1, 1, 5, 30)


def frame(spark, n=900):
    rng = random.Random(4)
    rows = [(T0 + dt.timedelta(minutes=rng.randrange(0, 50 * 1440)), rng.choice([None, float("nan"), 0.0, 1.5, -2.0, rng.random()]),
             float(i % 7), rng.choice([None, "", "a", "b"])) for i in range(n)]
    rows += [(None, 1.0, 1.0, "a"), (T0, 9.0, 9.0, "z"), (T0 + dt.timedelta(days=50), 3.0, 3.0, "a")]
    return spark.createDataFrame(rows, "ts timestamp, v double, k double, c string")


def near(rows):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows)


def test_two_windows_from_state_equal_the_scan(spark, tmp_dir):
    df = frame(spark)
    daily.write_days(daily.day_counts(df, "ts", ["v", "k"], ["c"]), tmp_dir + "/days")
    state = spark.read.parquet(tmp_dir + "/days")
    ref_start, cur_start = daily.labelled_windows(df)
    counts = [daily.window_counts(state, df, "ts", ["v", "k"], ["c"], a, b) for a, b in ((ref_start, cur_start), (cur_start, None))]
    ref, cur = monitor.drift_windows(df, "ts")
    want = monitor.quality_profile(ref.drop("ts"), cur.drop("ts"), ["v", "k"], ["c"]).collect()
    got = daily.profile(counts[0], "reference", ["v", "k"]).unionByName(daily.profile(counts[1], "current", ["v", "k"])).collect()
    assert near(map(lambda r: tuple("" if x is None else x for x in r), got)) == near(map(lambda r: tuple("" if x is None else x for x in r), want))
    assert near(daily.psi(*counts, ["v", "k"]).collect()) == near(monitor.psi(ref, cur, ["v", "k"]).collect())


@pytest.mark.parametrize("a, b", [(0, 60), (24 * 3 + 2, 24 * 3 + 9), (24 * 3, 24 * 9), (18.5, 18.5 + 24 * 4), (24 * 2 + 1, 24 * 40 + 7)])
def test_any_window(spark, tmp_dir, a, b):
    df = frame(spark)
    state = daily.day_counts(df, "ts", ["v"], ["c"])
    start, end = T0 + dt.timedelta(hours=a), T0 + dt.timedelta(hours=b)
    got = daily.window_counts(state, df, "ts", ["v"], ["c"], start, end).collect()
    inside = df.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end)))
    want = daily.day_counts(inside, "ts", ["v"], ["c"]).groupBy("feature", "num", "cat").agg(F.sum("cnt").alias("cnt")).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def test_a_day_landed_again_replaces_itself_only(spark, tmp_dir):
    df = frame(spark)
    path = tmp_dir + "/days"
    daily.write_days(daily.day_counts(df, "ts", ["v"], []), path)
    before = spark.read.parquet(path).groupBy("day").agg(F.sum("cnt").alias("n"))
    before = {r.day: r.n for r in before.collect()}
    day = T0.date() + dt.timedelta(days=2)
    again = df.where(F.to_date("ts") == F.lit(day)).limit(3)
    for _ in range(2):                          # replayed
        daily.write_days(daily.day_counts(again, "ts", ["v"], []), path)
    after = {r.day: r.n for r in spark.read.parquet(path).groupBy("day").agg(F.sum("cnt").alias("n")).collect()}
    assert after == {**before, day: 3}


def test_state_reads_only_its_days_and_edges_reach_the_scan(spark, tmp_dir):
    df = frame(spark)
    df.write.parquet(tmp_dir + "/raw")
    daily.write_days(daily.day_counts(df, "ts", ["v"], []), tmp_dir + "/days")
    counts = daily.window_counts(spark.read.parquet(tmp_dir + "/days"), spark.read.parquet(tmp_dir + "/raw"), "ts", ["v"], [],
                                 T0 + dt.timedelta(days=3), T0 + dt.timedelta(days=9))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(ts" in plan.replace(" ", "")


def test_empty_frame(spark):
    df = frame(spark).limit(0)
    assert daily.labelled_windows(df) is None and daily.day_counts(df, "ts", ["v"], ["c"]).count() == 0
