import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from podium.operators import monitor

FEATS = ["embedding_score", "collab_score", "play_count_norm"]


def _golden_frames(spark):
    rng = np.random.default_rng(42)
    ref = pd.DataFrame({"embedding_score": rng.normal(0.5, 0.15, 1000), "collab_score": rng.normal(0.6, 0.12, 1000),
                        "play_count_norm": rng.beta(2, 5, 1000)})
    cur = pd.DataFrame({"embedding_score": rng.normal(0.62, 0.20, 300), "collab_score": rng.normal(0.50, 0.16, 300),
                        "play_count_norm": rng.beta(2, 3, 300)})
    return spark.createDataFrame(ref), spark.createDataFrame(cur)


def test_psi_golden_values(spark):
    ref, cur = _golden_frames(spark)
    got = {r.feature: round(r.psi, 4) for r in monitor.psi(ref, cur, FEATS).collect()}
    assert got == {"embedding_score": 0.7192, "collab_score": 0.4846, "play_count_norm": 0.5815}
    rep = monitor.drift_report(ref, cur, FEATS).first()
    assert rep["avg_psi"] == 0.5951 and rep["has_drift"] is True and rep["n_features"] == 3


def test_psi_identical_is_zero(spark):
    ref, _ = _golden_frames(spark)
    assert all(r.psi == 0.0 for r in monitor.psi(ref, ref, FEATS).collect())


def test_psi_edge_value_lower_bin(spark):
    # range 0..10: inner edges 1, 2, ...; a value on an edge falls in the lower bin (right-closed)
    df = spark.createDataFrame([(3.0,), (3.0000001,), (0.0,), (10.0,)], "value double")
    bins = [r.bin for r in df.select(F.lit(0.0).alias("lo"), F.lit(10.0).alias("hi"), "value")
            .select(monitor._edges_expr(10).alias("bin")).collect()]
    assert bins == [3, 4, 1, 10]


def test_psi_constant_reference_and_empty_current(spark):
    ref = spark.createDataFrame([(5.0,)] * 10, "x double")
    cur = spark.createDataFrame([], "x double")
    r = monitor.psi(ref, cur, ["x"]).first()
    assert r["psi"] is None and r["n_current"] == 0
    assert monitor.drift_report(ref, cur, ["x"]).first()["has_drift"] is None


def test_decay_and_retrain(spark):
    df = spark.createDataFrame([(0.72, 0.65)], "baseline_ndcg double, current_ndcg double")
    r = monitor.performance_decay(df).first()
    assert r["relative_drop_pct"] == 9.72 and r["has_performance_decay"] is True and r["delta"] == 0.07
    flag = df.select(monitor.should_retrain(F.lit(False), F.lit(True)).alias("f")).first()["f"]
    assert flag is True


def test_windows_half_open(spark):
    t0 = dt.datetime(2024, 1, 31)
    rows = [(t0 - dt.timedelta(days=d),) for d in (0, 6, 7, 8, 36, 37, 38)]
    df = spark.createDataFrame(rows, "ts timestamp")
    ref, cur = monitor.drift_windows(df, "ts")
    assert cur.count() == 3   # days 0, 6, 7 (>= max - 7d)
    assert ref.count() == 3   # days 8, 36, 37


def test_column_drift_identical_and_shifted(spark):
    ref, cur = _golden_frames(spark)
    same = monitor.column_drift(ref, ref, FEATS, [])
    assert all(r.statistic == pytest.approx(0.0) and not r.drifted for r in same.collect())
    shifted = {r.feature: r for r in monitor.column_drift(ref, cur, FEATS, []).collect()}
    from_np = {}
    a, b = ref.toPandas(), cur.toPandas()
    for f in FEATS:
        xs = np.sort(np.concatenate([a[f], b[f]]))
        fa = np.searchsorted(np.sort(a[f]), xs, side="right") / len(a)
        fb = np.searchsorted(np.sort(b[f]), xs, side="right") / len(b)
        from_np[f] = np.abs(fa - fb).max()
    for f in FEATS:
        assert shifted[f].statistic == pytest.approx(from_np[f], abs=1e-12)
    summary = monitor.drift_share(monitor.column_drift(ref, cur, FEATS, [])).first()
    assert summary["n_columns"] == 3


def test_quality_profile(spark):
    ref = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, None)], "x double, c string")
    q = {(r.side, r.feature): r for r in monitor.quality_profile(ref, ref, ["x"], ["c"]).collect()}
    assert q[("reference", "x")].n_null == 1 and q[("reference", "x")].max_value == 3.0
    assert q[("current", "c")].n_distinct == 2


def test_psi_drops_nan(spark):
    ref = spark.createDataFrame([(float(i % 10),) for i in range(100)] + [(float("nan"),)], "v double")
    cur = spark.createDataFrame([(float(i % 3),) for i in range(60)], "v double")
    with_nan, without = (monitor.psi(r, cur, ["v"]).head().psi for r in (ref, ref.where("not isnan(v)")))
    assert with_nan == without > 1


def test_window_bounds_reach_the_scan(spark, tmp_dir):
    rows = spark.range(5000).select((F.timestamp_seconds(F.col("id") * 3600 + 1_700_000_000)).alias("ts"), F.col("id").alias("value"))
    for kind in ("timestamp", "timestamp_ntz"):
        rows.select(F.col("ts").cast(kind).alias("ts"), "value").write.parquet(f"{tmp_dir}/{kind}")
        df = spark.read.parquet(f"{tmp_dir}/{kind}")
        ref, cur = monitor.drift_windows(df, "ts")
        for side, n in ((ref, 30 * 24), (cur, 7 * 24 + 1)):
            plan = side._jdf.queryExecution().executedPlan().toString()
            assert "GreaterThanOrEqual(ts" in plan and side.count() == n


def test_quality_profile_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    r = monitor.quality_profile(df, df, ["v"], []).where("side = 'current'").first()
    assert (r.n_rows, r.n_null, r.n_distinct, r.min_value, r.max_value, r.mean_value) == (4, 2, 2, 1.0, 2.0, 1.5)
    assert r.std_value == pytest.approx(0.5 ** 0.5)
