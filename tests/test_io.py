import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from podium.operators import collab, retrieve
from podium.sources import io

T0 = dt.datetime(2024, 1, 1, 12, 30)


def test_csv_round_trip_and_dispatch(spark, tmp_dir):
    items = spark.createDataFrame([("p1", "t", "d", "c", 30, 5, 10.0, 2020)], io.ITEMS_SCHEMA)
    inter = spark.createDataFrame([("u", "p1", 4.5, T0), ("v", "p1", 0.5, None)],
                                  "user_id string, podcast_id string, rating double, timestamp timestamp")
    items.write.option("header", True).csv(tmp_dir + "/items")
    inter.write.option("header", True).csv(tmp_dir + "/inter")
    it, ix = io.load_source(spark, "CSV", tmp_dir + "/items", tmp_dir + "/inter")
    assert it.first()["release_year"] == 2020
    got = {r.user_id: (r.rating, r.timestamp) for r in ix.collect()}
    assert got == {"u": (4.5, T0), "v": (0.5, None)}
    with pytest.raises(ValueError):
        io.load_source(spark, "excel")
    with pytest.raises(ValueError):
        io.load_source(spark, "rss", tmp_dir + "/items")


def test_parquet_scan_coerces_text_timestamps(spark, tmp_dir):
    spark.createDataFrame([("u", "p", 1.0, "2024-01-01T00:00:00Z"), ("v", "p", 1.0, "not a time")],
                          "user_id string, podcast_id string, rating double, timestamp string") \
        .write.parquet(tmp_dir + "/i")
    spark.createDataFrame([("p", "t", "d", "c")], "podcast_id string, title string, description string, category string") \
        .write.parquet(tmp_dir + "/p")
    _, inter = io.read_parquet_tables(spark, tmp_dir + "/p", tmp_dir + "/i")
    got = {r.user_id: r.timestamp for r in inter.collect()}
    assert got == {"u": dt.datetime(2024, 1, 1), "v": None}


def test_embedding_cache_reuses_vectors(spark, tmp_dir):
    texts = spark.createDataFrame([("a", "news about science"), ("b", "sports talk")], "podcast_id string, text string")
    enc = retrieve.HashingEncoder(dim=32)
    first = {r.podcast_id: r.embedding for r in io.cached_embeddings(texts, tmp_dir + "/c", enc, "h32", spark).collect()}
    n_cached = spark.read.parquet(tmp_dir + "/c").count()
    again = {r.podcast_id: r.embedding for r in io.cached_embeddings(texts, tmp_dir + "/c", enc, "h32", spark).collect()}
    assert first == again and n_cached == 2 and spark.read.parquet(tmp_dir + "/c").count() == 2
    changed = texts.withColumn("text", F.when(F.col("podcast_id") == "b", "gardening").otherwise(F.col("text")))
    io.cached_embeddings(changed, tmp_dir + "/c", enc, "h32", spark).count()
    assert spark.read.parquet(tmp_dir + "/c").count() == 3          # only the changed text was encoded


def test_latest_report(spark, tmp_dir):
    for ts, v in (("20240101_000000", 0.1), ("20240301_000000", 0.3), ("20240201_000000", 0.2)):
        io.write_report(spark.createDataFrame([(ts, v)], "timestamp string, avg_psi double"),
                        os.path.join(tmp_dir, f"drift_summary_{ts}.json"))
    r = io.latest_report(spark, tmp_dir + "/drift_summary_*.json/*.json").first()
    assert r["avg_psi"] == 0.3


def test_holdout(spark):
    rows = [(f"u{u}", f"p{(u * 7 + j) % 9}", float((u + j) % 5 + 1), T0) for u in range(12) for j in range(6)]
    train = spark.createDataFrame(rows, "user_id string, podcast_id string, rating double, timestamp timestamp")
    ui = spark.createDataFrame([(f"u{u}", i) for i, u in enumerate(sorted(range(12), key=str))], "user_id string, user_idx int")
    ids = sorted({r[1] for r in rows})
    ii = spark.createDataFrame([(p, i) for i, p in enumerate(ids)], "podcast_id string, podcast_idx int")
    m = collab.holdout_cf(train, ui, ii, 4).first()
    assert m["n"] > 0 and m["rmse"] >= m["mae"] > 0


def test_csv_columns_go_by_name(spark, tmp_dir):
    p = os.path.join(tmp_dir, "i.csv")
    with open(p, "w") as f:
        f.write('podcast_id,user_id,rating,timestamp\np1,u1,4.5,2026-01-01 00:00:00+00:00\n')
    r = io.read_interactions_csv(spark, p).head()
    assert (r.user_id, r.podcast_id, r.rating, str(r.timestamp)) == ("u1", "p1", 4.5, "2026-01-01 00:00:00")
    p = os.path.join(tmp_dir, "j.csv")
    with open(p, "w") as f:
        f.write('podcast_id,title,category,description\np1,"a\nb","c ""d""",text\n')
    r = io.read_items_csv(spark, p).head()
    assert (r.podcast_id, r.title, r.category, r.description, r.play_count) == ("p1", "a\nb", 'c "d"', "text", None)


def test_cache_does_not_mix_fits_of_the_encoder(spark, tmp_dir):
    path = tmp_dir + "/fits"
    texts = lambda rows: spark.createDataFrame(rows, "podcast_id string, text string")
    first = texts([("a", "red apple"), ("b", "green pear")])
    io.cached_embeddings(first, path, retrieve.HashingEncoder(dim=32), "h", spark).count()
    more = texts([("a", "red apple"), ("b", "green pear"), ("c", "red plum"), ("d", "red cherry")])
    cached = {r.podcast_id: r.embedding for r in io.cached_embeddings(more, path, retrieve.HashingEncoder(dim=32), "h", spark).collect()}
    fresh = {r.podcast_id: r.embedding for r in io.cached_embeddings(more, None, retrieve.HashingEncoder(dim=32), "h", spark).collect()}
    assert cached == fresh and len(cached) == 4


def test_written_csv_comes_back_as_it_was(spark, tmp_dir):
    rows = [("p1", 'say "hi", now', " a\nb ", "c,d", 30, 5, 10.0, 2020), ("p2", '"', "x", None, None, None, None, None)]
    io.write_csv(spark.createDataFrame(rows, io.ITEMS_SCHEMA), tmp_dir + "/items")
    assert sorted(tuple(r) for r in io.read_items_csv(spark, tmp_dir + "/items").collect()) == sorted(rows)


def test_cache_keeps_one_row_per_repeated_id(spark, tmp_dir):
    texts = spark.createDataFrame([("a", "red"), ("a", "blue"), ("a", "red"), ("b", "red")], "podcast_id string, text string")
    enc = retrieve.HashingEncoder(dim=8)
    got = io.cached_embeddings(texts, tmp_dir + "/c", enc, "h", spark).collect()
    assert len(got) == 4 and spark.read.parquet(tmp_dir + "/c").count() == 3


def _times(n):
    return [dt.datetime(2024, 1 + i % 6, 1 + i % 27, i % 24) for i in range(n)]


def test_month_folders_are_pruned_at_run_time(spark, tmp_dir):
    inter = spark.createDataFrame([(f"u{i % 9}", f"p{i % 5}", 1.0, t) for i, t in enumerate(_times(400))],
                                  "user_id string, podcast_id string, rating double, timestamp timestamp")
    io.write_interactions(inter, tmp_dir + "/i")
    back = spark.read.parquet(tmp_dir + "/i")
    assert back.count() == 400 and {f for f in os.listdir(tmp_dir + "/i") if "=" in f} == {f"month=2024-0{m}" for m in range(1, 7)}
    months = spark.createDataFrame([("2024-02", 1), ("2024-03", 7)], "month string, keep int")
    months.write.parquet(tmp_dir + "/m")
    rows = back.join(F.broadcast(spark.read.parquet(tmp_dir + "/m").where("keep > 5")), "month")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert rows.count() == sum(t.month == 3 for t in _times(400))
    one = back.where("month = '2024-04' and user_id = 'u3'")
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in text and "EqualTo(user_id,u3)" in text


def test_key_sorted_table_skips_row_groups(spark, tmp_dir):
    """Each file's row groups cover disjoint key ranges, so a lookup opens one of them."""
    import pyarrow.parquet as pq
    v = spark.range(20_000).select(F.format_string("k%06d", "id").alias("podcast_id"), F.array(*[F.rand(i) for i in range(8)]).alias("embedding"))
    io.write_table(v, tmp_dir + "/v", sort_by=["podcast_id"], row_group_bytes=64 * 1024)
    ranges = []
    for f in os.listdir(tmp_dir + "/v"):
        if f.endswith(".parquet"):
            meta = pq.ParquetFile(os.path.join(tmp_dir, "v", f)).metadata
            for g in range(meta.num_row_groups):
                st = meta.row_group(g).column(0).statistics
                ranges.append((st.min, st.max))
    ranges.sort()
    assert len(ranges) > 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    hit = retrieve.embedding_of(spark.read.parquet(tmp_dir + "/v"), "k012345")
    assert "EqualTo(podcast_id,k012345)" in hit._jdf.queryExecution().executedPlan().toString() and hit.count() == 1
    assert retrieve.embedding_of(spark.read.parquet(tmp_dir + "/v"), "nobody").count() == 0
