"""Monitoring: PSI drift, drift report, data-quality profile, performance
decay, retrain flag and time windows. All features go through one unpivoted
table ``(feature, value)`` so one aggregate serves every column."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import clean_double, instant

# Fixed values of the reference monitor.
DRIFT_THRESHOLD = 0.15
PERFORMANCE_THRESHOLD = 0.05
PSI_BINS = 10
PSI_FLOOR = 1e-6
DECAY_FLOOR = 1e-6
CURRENT_WINDOW_DAYS = 7
REFERENCE_WINDOW_DAYS = 30

_NUMERIC = (T.FloatType, T.DoubleType, T.IntegerType, T.LongType)


def numeric_columns(df: DataFrame) -> list[str]:
    """float64/32 and int64/32 columns (short, byte, bool, decimal are neither)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def unpivot(df: DataFrame, features, value_type: str = "double") -> DataFrame:
    """``(feature, value)`` rows for the given columns; NULL and NaN dropped."""
    feats = list(features)
    args = []
    for f in feats:
        args += [F.lit(f), F.col(f).cast(value_type)]
    return df.select(F.stack(F.lit(len(feats)), *args).alias("feature", "value")) \
             .where(F.col("value").isNotNull() & ~F.isnan("value")
                    if value_type == "double" else F.col("value").isNotNull())


def _edges_expr(bins: int):
    """Bin index 1..bins of ``value`` for right-closed equal-width bins over
    [lo, hi], outer edges open: count of inner edges strictly below + 1."""
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    inner = F.sequence(F.lit(1), F.lit(bins - 1))
    return F.size(F.filter(inner, lambda i: F.col("lo") + i.cast("double") * step < F.col("value"))) + 1


def psi(reference: DataFrame, current: DataFrame, features=None, bins: int = PSI_BINS) -> DataFrame:
    """D1 per feature: ``(feature, psi, n_reference, n_current)``.

    Edges come from the reference range (a constant reference is widened by
    0.1% of its value each side, or by 0.001 at zero); shares are floored at
    1e-6; ``psi = |sum((c - r) * ln(c / r))|``. An empty current side gives NULL."""
    feats = features or [c for c in numeric_columns(reference) if c in current.columns]
    feats = [f for f in feats if f in reference.columns and f in current.columns]
    one = F.lit(1).cast("long")
    return psi_of_values(unpivot(reference, feats).withColumn("n", one), unpivot(current, feats).withColumn("n", one), bins)


def psi_of_values(reference: DataFrame, current: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """``psi`` of two tables ``feature, value, n`` (n: how often the value occurs)."""
    ref, cur = reference.withColumn("side", F.lit("r")), current.withColumn("side", F.lit("c"))
    rng = ref.groupBy("feature").agg(F.min("value").alias("lo0"), F.max("value").alias("hi0"))
    widen = F.when(F.col("lo0") != 0, F.abs(F.col("lo0")) * 0.001).otherwise(F.lit(0.001))
    rng = rng.select(
        "feature",
        F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - widen).otherwise(F.col("lo0")).alias("lo"),
        F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + F.when(F.col("hi0") != 0, F.abs(F.col("hi0")) * 0.001)
               .otherwise(F.lit(0.001))).otherwise(F.col("hi0")).alias("hi"))
    both = ref.unionByName(cur)
    # The range table has one row per feature: a broadcast of bounded size.
    binned = both.join(F.broadcast(rng), "feature").withColumn("bin", _edges_expr(bins))
    times = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0))
    counts = binned.groupBy("feature", "bin").agg(times("r").alias("rc"), times("c").alias("cc"))
    spine = rng.select("feature", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    # totals come from the bin counts: one row per feature and bin
    whole = Window.partitionBy("feature")
    tab = spine.join(counts, ["feature", "bin"], "left").withColumn("n_ref", F.sum("rc").over(whole)).withColumn(
        "n_cur", F.sum("cc").over(whole))
    n_ref = F.coalesce(F.col("n_ref"), F.lit(0)).cast("double")
    n_cur = F.coalesce(F.col("n_cur"), F.lit(0)).cast("double")
    rp = F.greatest(F.try_divide(F.coalesce(F.col("rc"), F.lit(0)).cast("double"), n_ref), F.lit(PSI_FLOOR))
    cp = F.greatest(F.try_divide(F.coalesce(F.col("cc"), F.lit(0)).cast("double"), n_cur), F.lit(PSI_FLOOR))
    term = F.when(n_cur > 0, (cp - rp) * F.log(cp / rp))
    return tab.groupBy("feature").agg(
        F.when(F.max(n_cur) > 0, F.abs(F.sum(term))).alias("psi"),
        F.max(n_ref).cast("long").alias("n_reference"), F.max(n_cur).cast("long").alias("n_current"))


def drift_report(reference: DataFrame, current: DataFrame, features=None,
                 threshold: float = DRIFT_THRESHOLD, bins: int = PSI_BINS) -> DataFrame:
    """One row ``(method, avg_psi, has_drift, n_features, drift_threshold,
    per_feature_psi map)``; mean over features with divisor max(n, 1)."""
    p = psi(reference, current, features, bins)
    agg = p.agg(
        (F.coalesce(F.sum("psi"), F.lit(0.0)) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("avg_psi"),
        F.count(F.lit(1)).alias("n_features"),
        F.count_if(F.col("psi").isNull()).alias("n_null"),
        F.map_from_entries(F.collect_list(F.struct("feature", F.round("psi", 4)))).alias("per_feature_psi"))
    has = F.when(F.col("n_null") > 0, F.lit(None).cast("boolean")).otherwise(F.col("avg_psi") > F.lit(threshold))
    return agg.select(F.lit("psi_fallback").alias("method"), F.round("avg_psi", 4).alias("avg_psi"),
                      has.alias("has_drift"), F.col("n_features").cast("long").alias("n_features"),
                      F.lit(threshold).alias("drift_threshold"), "per_feature_psi")


def quality_profile(reference: DataFrame, current: DataFrame, numeric=None, categorical=None) -> DataFrame:
    """Per side and column: rows, nulls, distinct, and for numeric columns
    min, max, mean, sample std. One aggregate per side over an unpivoted table."""
    numeric = list(numeric if numeric is not None else numeric_columns(reference))
    categorical = list(categorical if categorical is not None else categorical_columns(reference))

    def side(df: DataFrame, name: str) -> DataFrame:
        args = []
        for f in numeric:
            args += [F.lit(f), clean_double(f), F.lit(None).cast("string")]
        for f in categorical:
            args += [F.lit(f), F.lit(None).cast("double"), F.col(f).cast("string")]
        n = len(numeric) + len(categorical)
        long = df.select(F.stack(F.lit(n), *args).alias("feature", "num", "cat"))
        is_num = F.col("feature").isin(numeric) if numeric else F.lit(False)
        present = F.when(is_num, F.col("num").isNotNull()).otherwise(F.col("cat").isNotNull())
        return long.groupBy("feature").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~present).alias("n_null"),
            F.coalesce(F.countDistinct("num"), F.lit(0)).alias("_dn"),
            F.coalesce(F.countDistinct("cat"), F.lit(0)).alias("_dc"),
            F.min("num").alias("min_value"), F.max("num").alias("max_value"),
            F.avg("num").alias("mean_value"), F.stddev_samp("num").alias("std_value"),
        ).select(F.lit(name).alias("side"), "feature", "n_rows", "n_null",
                 (F.col("_dn") + F.col("_dc")).alias("n_distinct"),
                 "min_value", "max_value", "mean_value", "std_value")

    return side(reference, "reference").unionByName(side(current, "current"))


def performance_decay(df: DataFrame, baseline: str = "baseline_ndcg", current: str = "current_ndcg",
                      threshold: float = PERFORMANCE_THRESHOLD) -> DataFrame:
    """D5 as columns: delta, relative drop (floor 1e-6), flag, rounded 4 and 2."""
    b, c = F.col(baseline), F.col(current)
    delta = b - c
    drop = delta / F.greatest(b, F.lit(DECAY_FLOOR))
    return df.select(
        "*",
        F.round(delta, 4).alias("delta"),
        F.round(drop * 100, 2).alias("relative_drop_pct"),
        F.lit(round(threshold * 100, 2)).alias("performance_threshold_pct"),
        (drop > F.lit(threshold)).alias("has_performance_decay"))


def should_retrain(has_drift, has_decay):
    """Drift OR decay (NULL-safe: unknown counts as no)."""
    return F.coalesce(has_drift, F.lit(False)) | F.coalesce(has_decay, F.lit(False))


def _window_bounds(df: DataFrame, ts_col: str, current_days: int, reference_days: int):
    """Starts of the current and reference windows as literals of the column's
    own type, so that the bounds reach the scan; from one global aggregate (a
    single row reaches the driver)."""
    mx = df.agg(F.unix_micros(F.max(F.col(ts_col)).cast("timestamp")).alias("m")).first()["m"]
    if mx is None:
        return None
    day = 86_400_000_000
    cur_start = mx - int(current_days) * day
    kind = df.schema[ts_col].dataType
    return instant(cur_start, kind), instant(cur_start - int(reference_days) * day, kind)


def drift_windows(df: DataFrame, ts_col: str = "ts", current_days: int = CURRENT_WINDOW_DAYS,
                  reference_days: int = REFERENCE_WINDOW_DAYS):
    """current = [max_ts - current_days, max_ts]; reference = the
    ``reference_days`` before it, half-open."""
    b = _window_bounds(df, ts_col, current_days, reference_days)
    if b is None:
        return df.limit(0), df.limit(0)
    cur_start, ref_start = b
    t = F.col(ts_col)
    return df.where((t >= ref_start) & (t < cur_start)), df.where(t >= cur_start)


def window_label(df: DataFrame, ts_col: str = "ts", current_days: int = CURRENT_WINDOW_DAYS,
                 reference_days: int = REFERENCE_WINDOW_DAYS) -> DataFrame:
    """D7 as one labelled frame: ``window`` is 'current', 'reference' or NULL."""
    b = _window_bounds(df, ts_col, current_days, reference_days)
    if b is None:
        return df.withColumn("window", F.lit(None).cast("string"))
    cur_start, ref_start = b
    t = F.col(ts_col)
    lab = F.when(t >= cur_start, "current").when((t >= ref_start) & (t < cur_start), "reference")
    return df.withColumn("window", lab)


# Thresholds of the per-column drift tests (parameters, not from the reference).
KS_THRESHOLD = 0.1
JS_THRESHOLD = 0.1
DATASET_DRIFT_SHARE = 0.5


def column_drift(reference: DataFrame, current: DataFrame, numeric, categorical,
                 ks_threshold: float = KS_THRESHOLD, js_threshold: float = JS_THRESHOLD) -> DataFrame:
    """D3 per column: two-sample Kolmogorov-Smirnov distance for numeric
    columns (from cumulative counts over the distinct values, exact and
    distributed) and Jensen-Shannon distance (natural log) for categorical
    ones. ``(feature, stat_test, statistic, threshold, drifted)``."""
    from .ordering import prefix_sums
    parts = []
    if numeric:
        r = unpivot(reference, numeric).withColumn("side", F.lit("r"))
        c = unpivot(current, numeric).withColumn("side", F.lit("c"))
        cnt = r.unionByName(c).groupBy("feature", "value").agg(
            F.count_if(F.col("side") == "r").cast("double").alias("nr"),
            F.count_if(F.col("side") == "c").cast("double").alias("nc"))
        tot = cnt.groupBy("feature").agg(F.sum("nr").alias("tr"), F.sum("nc").alias("tc"))
        cum = prefix_sums(cnt, "feature", "value", ["nr", "nc"])
        d = cum.join(F.broadcast(tot), "feature").select(
            "feature", F.abs(F.try_divide(F.col("cum_nr"), F.col("tr")) - F.try_divide(F.col("cum_nc"), F.col("tc"))).alias("d"))
        ks = d.groupBy("feature").agg(F.max("d").alias("statistic"))
        parts.append(ks.select("feature", F.lit("ks").alias("stat_test"), "statistic",
                               F.lit(ks_threshold).alias("threshold")))
    if categorical:
        r = unpivot(reference, categorical, "string").withColumn("side", F.lit("r"))
        c = unpivot(current, categorical, "string").withColumn("side", F.lit("c"))
        cnt = r.unionByName(c).groupBy("feature", "value").agg(
            F.count_if(F.col("side") == "r").cast("double").alias("nr"),
            F.count_if(F.col("side") == "c").cast("double").alias("nc"))
        tot = cnt.groupBy("feature").agg(F.sum("nr").alias("tr"), F.sum("nc").alias("tc"))
        p = F.col("nr") / F.col("tr")
        q = F.col("nc") / F.col("tc")
        m = (p + q) / 2
        kl = lambda a: F.when(a > 0, a * F.log(a / m)).otherwise(F.lit(0.0))
        js = cnt.join(F.broadcast(tot), "feature").groupBy("feature").agg(
            F.sum(kl(p) / 2 + kl(q) / 2).alias("jsd"))
        parts.append(js.select("feature", F.lit("jensenshannon").alias("stat_test"),
                               F.sqrt(F.greatest(F.col("jsd"), F.lit(0.0))).alias("statistic"),
                               F.lit(js_threshold).alias("threshold")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.withColumn("drifted", F.col("statistic") > F.col("threshold"))


def drift_share(col_drift: DataFrame, drift_threshold: float = DRIFT_THRESHOLD,
                dataset_share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """D3 summary: share of drifted columns; dataset drift when the share
    reaches ``dataset_share``; ``has_drift = dataset_drift or share > threshold``."""
    a = col_drift.agg(F.count(F.lit(1)).alias("n_columns"), F.count_if("drifted").alias("n_drifted"))
    share = F.col("n_drifted") / F.greatest(F.col("n_columns"), F.lit(1))
    return a.select(F.col("n_columns").cast("long"), F.col("n_drifted").cast("long"), share.alias("drift_share"),
                    (share >= F.lit(dataset_share)).alias("dataset_drift"),
                    ((share >= F.lit(dataset_share)) | (share > F.lit(drift_threshold))).alias("has_drift"))
