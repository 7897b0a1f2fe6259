import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from podium.operators import ingest, monitor
from podium.streaming import online


def test_online_drift_stream_equals_batch(spark, tmp_dir):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i), float((i * 37) % 101), float(i % 13))
            for i in range(400)]
    df = spark.createDataFrame(rows, "ts timestamp, value double, k double")
    ref = df.where(F.col("ts") < "2024-01-20")
    src = os.path.join(tmp_dir, "src")
    df.repartitionByRange(4, "ts").write.parquet(src)
    edges = online.reference_edges(ref, ["value", "k"])
    q = online.start_online_drift(spark, src, df.schema, edges, tmp_dir + "/sink", tmp_dir + "/ckpt")
    q.awaitTermination()
    got = {(str(r.window_start), r.feature): r.psi for r in
           online.window_psi(online.reference_counts(ref, edges), online.latest_counts(spark, tmp_dir + "/sink")).collect()}
    # batch: same windows, PSI per window against the same reference
    wins = df.select(F.window("ts", "7 days").alias("w"), "*")
    starts = [r.s for r in wins.select(F.col("w.start").alias("s")).distinct().collect()]
    assert len(got) == 2 * len(starts)
    for s in starts:
        cur = wins.where(F.col("w.start") == F.lit(s)).drop("w")
        for r in monitor.psi(ref, cur, ["value", "k"]).collect():
            assert got[(str(s), r.feature)] == pytest.approx(r.psi, abs=1e-12)


def test_feed_landing_stream_equals_batch(spark, tmp_dir):
    a = [("f1", "2024-01-01T00:00:00Z", "e1", None, None, []), ("f2", "2024-01-01T00:00:00Z", "e2", None, None, [])]
    b = [("f2", "2024-01-02T00:00:00Z", "e2b", None, None, [])]
    spark.createDataFrame(a, ingest.RAW_FEED_SCHEMA).write.json(tmp_dir + "/landing/w1")
    spark.createDataFrame(b, ingest.RAW_FEED_SCHEMA).write.json(tmp_dir + "/landing/w2")
    q = online.start_feed_landing(spark, tmp_dir + "/landing/*", ingest.RAW_FEED_SCHEMA, tmp_dir + "/log",
                                  tmp_dir + "/ckpt")
    q.awaitTermination()
    cur = {r.feed_url: r.etag for r in online.current_payloads(spark, tmp_dir + "/log").collect()}
    assert cur == {"f1": "e1", "f2": "e2b"}


def _waves(spark, tmp_dir, name, frames):
    """Feature files in landing order; returns the folder."""
    src = os.path.join(tmp_dir, name)
    for f in frames:
        f.coalesce(1).write.mode("append").parquet(src)
    return src


def _features(spark, days, late=None):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h), float((d * 5 + h) % 17), float("nan") if h % 5 == 0 else float(h))
            for d in days for h in range(0, 24, 2)]
    rows += [(late, 3.0, 4.0)] if late else []
    return spark.createDataFrame(rows, "ts timestamp, value double, k double")


def _psi(spark, ref, edges, sink):
    return {(str(r.window_start), r.feature): (round(r.psi, 12), r.n_current) for r in online.window_psi(
        online.reference_counts(ref, edges), online.latest_counts(spark, sink)).collect()}


def test_online_drift_over_several_batches_drops_and_counts_a_late_row(spark, tmp_dir):
    ref = _features(spark, range(0, 5))
    edges = online.reference_edges(ref, ["value", "k"])
    late = dt.datetime(2024, 1, 2)              # its window closed long ago when the last file lands
    plain = [_features(spark, range(a, a + 8)) for a in (0, 8, 16, 24)]
    with_late = [*plain[:3], _features(spark, range(24, 32), late)]
    out = {}
    for name, frames, files in (("plain", plain, 1), ("late", with_late, 1), ("one", plain, None)):
        src = _waves(spark, tmp_dir, name, frames)
        q = online.start_online_drift(spark, src, ref.schema, edges, f"{tmp_dir}/{name}-sink", f"{tmp_dir}/{name}-ckpt", max_files=files)
        q.awaitTermination()
        batches = len([p for p in q.recentProgress if p["numInputRows"]])
        out[name] = _psi(spark, ref, edges, f"{tmp_dir}/{name}-sink"), online.late_values(q), batches
    assert out["plain"][0] == out["late"][0] == out["one"][0]
    assert out["plain"][1] == 0 and out["late"][1] == 2 and out["plain"][2] == 4 and out["one"][2] == 1
    # NaN is missing, as in the batch form
    first = {f: n for (w, f), (_, n) in out["plain"][0].items() if w.startswith("2024-01-04")}
    week = _features(spark, range(0, 32)).where("ts >= '2024-01-04' and ts < '2024-01-11'")
    assert first == {"value": week.count(), "k": week.where("not isnan(k)").count()}


def test_online_drift_restarts_from_its_checkpoint_and_replays(spark, tmp_dir):
    ref = _features(spark, range(0, 5))
    edges = online.reference_edges(ref, ["value", "k"])
    frames = [_features(spark, range(a, a + 8)) for a in (0, 8, 16, 24)]
    start = lambda src, name: online.start_online_drift(
        spark, src, ref.schema, edges, f"{tmp_dir}/{name}-sink", f"{tmp_dir}/{name}-ckpt", max_files=1).awaitTermination()
    start(_waves(spark, tmp_dir, "all", frames), "all")
    src = _waves(spark, tmp_dir, "cut", frames[:2])
    start(src, "cut")
    _waves(spark, tmp_dir, "cut", frames[2:])
    commits = sorted((f for f in os.listdir(tmp_dir + "/cut-ckpt/commits") if f.isdigit()), key=int)
    for name in (commits[-1], f".{commits[-1]}.crc"):       # the last batch wrote its rows but not its commit
        os.remove(f"{tmp_dir}/cut-ckpt/commits/{name}")
    start(src, "cut")
    assert _psi(spark, ref, edges, tmp_dir + "/cut-sink") == _psi(spark, ref, edges, tmp_dir + "/all-sink")


def test_current_payloads_orders_scrape_times_as_instants(spark, tmp_dir):
    rows = [("f", "2024-01-01T23:30:00-05:00", "later", None, None, [], 0), ("f", "2024-01-02T01:00:00+00:00", "earlier", None, None, [], 0)]
    from pyspark.sql import types as T
    schema = T.StructType([*ingest.RAW_FEED_SCHEMA.fields, T.StructField("batch_id", T.LongType())])
    spark.createDataFrame(rows, schema).write.parquet(tmp_dir + "/log")
    assert online.current_payloads(spark, tmp_dir + "/log").first()["etag"] == "later"
