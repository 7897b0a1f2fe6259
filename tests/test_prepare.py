import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from podium.operators import ordering, prepare

INTER = "user_id string, podcast_id string, rating double, timestamp timestamp"
ITEMS = "podcast_id string, title string, description string, category string"


def _ts(d):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=d)


def test_missing_columns(spark):
    df = spark.createDataFrame([("a", "b")], "podcast_id string, title string")
    assert prepare.missing_columns(df, prepare.ITEM_REQUIRED) == ["category", "description"]
    with pytest.raises(ValueError):
        prepare.require_columns(df, prepare.ITEM_REQUIRED, "podcasts")


def test_null_rating_fails(spark):
    df = spark.createDataFrame([("u", "p", None, _ts(0)), ("u", "q", 3.0, _ts(1))], INTER)
    with pytest.raises(AssertionError):
        prepare.validate_interactions(df)


def test_duplicate_and_null_ids_fail(spark):
    dup = spark.createDataFrame([("a", "t", "d", "c"), ("a", "t", "d", "c")], ITEMS)
    with pytest.raises(AssertionError):
        prepare.validate_items(dup)
    null = spark.createDataFrame([(None, "t", "d", "c"), ("b", "t", "d", "c")], ITEMS)
    with pytest.raises(AssertionError):
        prepare.validate_items(null)
    assert prepare.duplicate_ids(null).count() == 1


def test_null_description_fails(spark):
    df = spark.createDataFrame([("a", "t", None, "c")], ITEMS)
    with pytest.raises(AssertionError):
        prepare.validate_items(df)


def test_active_users_counts_rows_not_items(spark):
    rows = [("u1", "p", 1.0, _ts(i)) for i in range(5)] + [("u2", f"p{i}", 1.0, _ts(i)) for i in range(4)]
    df = spark.createDataFrame(rows, INTER)
    out = prepare.filter_active_users(df, 5)
    assert {r.user_id for r in out.collect()} == {"u1"}


def test_encode_ids_dense_sorted(spark):
    df = spark.createDataFrame([("b", "x", 1.0, _ts(0)), ("a", "y", 1.0, _ts(0)), ("c", "x", 1.0, _ts(0)),
                                ("a", "z", 1.0, _ts(0))], INTER)
    m = {r.user_id: r.user_idx for r in prepare.encode_ids(df, "user_id", "user_idx").collect()}
    assert m == {"a": 0, "b": 1, "c": 2}


def test_boundary_ties(spark):
    # 10 rows, 4 on the cut timestamp: 8 train, 2 test, deterministic.
    rows = [("u", f"p{i}", 1.0, _ts(i)) for i in range(6)] + [(f"v{i}", "q", 1.0, _ts(6)) for i in range(4)]
    df = spark.createDataFrame(rows, INTER)
    tr, te = prepare.temporal_split(df, 0.2)
    assert tr.count() == 8 and te.count() == 2
    assert sorted(r.user_id for r in te.collect()) == ["v2", "v3"]


def test_null_timestamps_sort_last(spark):
    rows = [("u", f"p{i}", 1.0, _ts(i)) for i in range(4)] + [("u", "pn", 1.0, None)]
    tr, te = prepare.temporal_split(spark.createDataFrame(rows, INTER), 0.2)
    assert [r.podcast_id for r in te.collect()] == ["pn"]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 4)), min_size=1, max_size=40),
       st.sampled_from([0.1, 0.2, 0.5]))
def test_split_equals_global_row_number(spark, rows, test_size):
    data = [(f"u{u}", f"p{p}", float(r), _ts(u % 3) if p % 4 else None) for u, p, r in rows]
    df = spark.createDataFrame(data, INTER)
    tr, te = prepare.temporal_split(df, test_size)
    n = len(data)
    cut = int(n * (1 - test_size))
    w = Window.orderBy(F.col("timestamp").asc_nulls_last(), "user_id", "podcast_id", "rating")
    ref = df.withColumn("rn", F.row_number().over(w))
    exp_train = sorted(tuple(r)[:4] for r in ref.where(F.col("rn") <= cut).drop("rn").collect())
    assert sorted(tuple(r) for r in tr.collect()) == exp_train
    assert tr.count() + te.count() == n


def test_global_row_number_partition_invariant(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 503).alias("k"), F.col("id"))
    a = ordering.global_row_number(df.repartition(1), ["k", "id"]).orderBy("rn").collect()
    b = ordering.global_row_number(df.repartition(8), ["k", "id"], num_partitions=5).orderBy("rn").collect()
    assert [(r.k, r.id, r.rn) for r in a] == [(r.k, r.id, r.rn) for r in b]
    assert [r.rn for r in a] == list(range(1, 501))
    assert [(r.k, r.id) for r in a] == sorted((r.k, r.id) for r in a)


def test_prefix_sums_match_pandas(spark):
    import pandas as pd
    pdf = pd.DataFrame({"g": ["a"] * 50 + ["b"] * 30, "v": list(range(50)) + list(range(30)),
                        "x": [float(i % 7) for i in range(80)]})
    out = ordering.prefix_sums(spark.createDataFrame(pdf), "g", "v", ["x"], num_partitions=6).toPandas()
    out = out.sort_values(["g", "v"]).reset_index(drop=True)
    exp = pdf.sort_values(["g", "v"]).groupby("g")["x"].cumsum().reset_index(drop=True)
    assert (out["cum_x"] - exp).abs().max() < 1e-9


def test_dataset_stats_long_form(spark):
    items = spark.createDataFrame([("a", "t", "d", "c1"), ("b", "t", "d", "c2")], ITEMS)
    inter = spark.createDataFrame([("u", "a", 1.0, _ts(0)), ("v", "a", 6.0, _ts(0))], INTER)
    m = {r.metric: r.value for r in prepare.dataset_stats(items, inter).collect()}
    assert m == {"n_items": 2, "n_categories": 2, "n_interactions": 2, "n_users": 2,
                 "n_interacted_items": 1, "n_bad_rating": 1}
