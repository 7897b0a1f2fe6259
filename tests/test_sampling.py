import pytest
from pyspark.sql import functions as F

from podium.operators import sampling


def test_weighted_sample(spark):
    rows = [(f"u{u}", f"p{i}", float(i % 3)) for u in range(5) for i in range(12)]
    df = spark.createDataFrame(rows, "user_id string, podcast_id string, w double")
    s = sampling.weighted_sample(df, "user_id", "podcast_id", "w", 4, seed=1).collect()
    per = {}
    for r in s:
        per.setdefault(r.user_id, []).append(r)
    assert all(len(v) == 4 for v in per.values()) and len(per) == 5
    assert all(r.w > 0 for r in s)                      # zero weights are never drawn
    again = sampling.weighted_sample(df.repartition(7), "user_id", "podcast_id", "w", 4, seed=1).collect()
    assert sorted((r.user_id, r.podcast_id) for r in s) == sorted((r.user_id, r.podcast_id) for r in again)
    small = sampling.weighted_sample(df.where("podcast_id in ('p1', 'p2')"), "user_id", "podcast_id", "w", 4)
    assert small.count() == 10


def test_downsample_exact_and_layout_free(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    a = sorted(r.k for r in sampling.downsample(df, 100, ["k"]).collect())
    b = sorted(r.k for r in sampling.downsample(df.repartition(5), 100, ["k"]).collect())
    assert len(a) == 100 and a == b
    assert sampling.downsample(df, 5000, ["k"]).count() == 1000
    big = spark.range(300_000).select(F.col("id").cast("string").alias("k"))
    assert sampling.downsample(big, 150_000, ["k"]).count() == 150_000


@pytest.mark.parametrize("n", [0, 1, 399, 400, 1000])
def test_radix_selection_takes_the_smallest_hashes(spark, monkeypatch, n):
    """Buckets split down to the last bits; a third of the rows repeat one key."""
    monkeypatch.setattr(sampling, "_SORTED_ROWS", 2)
    df = spark.range(600).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    got = [r["k"] for r in sampling.downsample(df.repartition(5), n, ["k"], seed=3).select("k").collect()]
    h = F.xxhash64(F.lit(3), F.col("k"))
    want = [r["k"] for r in df.select("k", h.alias("h")).orderBy("h", "k").limit(n).collect()]
    assert sorted(got) == sorted(want)


def test_selection_sorts_only_the_boundary_bucket(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    plan = sampling.downsample(df, 2000, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1
    assert sampling.downsample(df, 2000, ["k"]).distinct().count() == 2000
