"""Ranking: category preferences, ranker features, gradient-boosted ranker,
per-user min-max, closed-form diversity re-rank, top-k and tie-aware NDCG."""
from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clip, fill0, safe_div
from .collab import minmax_by_group
from .factor import drop

# The ranker's feature list, in order.
FEATURE_COLS = [
    "embedding_score", "collab_score",
    "avg_duration_min", "total_episodes",
    "play_count_norm", "release_year_norm",
    "category_match", "popularity_score",
]
ITEM_FEATURES = ["podcast_id", "category", "avg_duration_min", "total_episodes",
                 "play_count", "release_year"]
# Defaults for item columns absent from a candidate frame.
MISSING_DEFAULTS = {"avg_duration_min": 60.0, "total_episodes": 100.0,
                    "play_count": 100.0, "release_year": 100.0}
# Rows of the training frame that one boosting task handles. Every level of every
# tree is a job over all of them, so small tasks cost more to start than to run.
ROWS_PER_TASK = 250_000
# Values per feature that boosting tells apart (MLlib's own number of bins), and
# the rows up to which MLlib takes them from all rows instead of a sample.
BINS, ALL_ROWS = 32, 10_000
# Quantiles of a feature over all rows from which the values for its bins are chosen.
QUANTILES = 1_024
# Redundancy penalty per already-chosen item of the same category, and its cap.
MMR_STEP, MMR_CAP = 0.3, 0.9


def category_prefs(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Share of each user's rows per category, over non-null categories (A4).
    The window runs on the aggregated table (a few rows per user)."""
    j = interactions.select("user_id", "podcast_id").join(
        items.select("podcast_id", "category"), "podcast_id", "left")
    cnt = (j.where(F.col("category").isNotNull())
            .groupBy("user_id", "category").agg(F.count(F.lit(1)).alias("cnt")))
    tot = F.sum("cnt").over(Window.partitionBy("user_id"))
    return cnt.select("user_id", "category", (F.col("cnt") / tot).alias("share"))


@dataclass
class Norms:
    max_play: float | None
    min_year: float | None
    max_year: float | None


def ranker_norms(items: DataFrame) -> DataFrame:
    """One-row aggregate of the normalisers (A5)."""
    return items.agg(F.max("play_count").cast("double").alias("max_play"),
                     F.min("release_year").cast("double").alias("min_year"),
                     F.max("release_year").cast("double").alias("max_year"))


def collect_norms(items: DataFrame) -> Norms:
    r = ranker_norms(items).first()
    return Norms(r["max_play"], r["min_year"], r["max_year"])


def prefs_map(prefs: DataFrame) -> DataFrame:
    """Per-user map category -> share (bounded by the category count), so the
    share lookup joins on ``user_id`` alone and keeps a user partitioning."""
    return prefs.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("category", "share"))).alias("_prefs"))


def derive_features(df: DataFrame, norms: Norms, prefs: DataFrame) -> DataFrame:
    """Four derived columns plus the share lookup (J7), then NULL/NaN -> 0.
    ``prefs`` is the long table ``(user_id, category, share)`` or the per-user
    map table from ``prefs_map``."""
    for c, v in MISSING_DEFAULTS.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(v))
    for c in ("embedding_score", "collab_score"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0.0))
    max_play = F.lit(norms.max_play).cast("double")
    lo = F.lit(norms.min_year).cast("double")
    span = F.lit(max((norms.max_year or 0.0) - (norms.min_year or 0.0), 1.0))
    if norms.min_year is None or norms.max_year is None:
        span = F.lit(1.0)
    df = (df.withColumn("play_count_norm", clip(safe_div(F.col("play_count").cast("double"), max_play), 0.0, 1.0))
            .withColumn("release_year_norm", clip((F.col("release_year").cast("double") - lo) / span, 0.0, 1.0))
            .withColumn("popularity_score", safe_div(F.log1p(F.col("play_count").cast("double")), F.log1p(max_play))))
    if "_prefs" in prefs.columns:
        share = F.when(F.col("category").isNotNull(), F.try_element_at(F.col("_prefs"), F.col("category")))
        df = (df.join(prefs, "user_id", "left")
                .withColumn("category_match", F.coalesce(share, F.lit(0.0))).drop("_prefs"))
    else:
        df = (df.join(prefs.withColumnRenamed("share", "_share"), ["user_id", "category"], "left")
                .withColumn("category_match", F.coalesce(F.col("_share"), F.lit(0.0))).drop("_share"))
    for c in FEATURE_COLS:
        df = df.withColumn(c, fill0(c))
    return df


def training_frame(rows: DataFrame, items: DataFrame, norms: Norms, prefs: DataFrame) -> DataFrame:
    """Train or test rows with item features; retrieval and CF scores are
    0.0 here, as in the reference training path (R2 traps)."""
    j = rows.select("user_id", "podcast_id", "rating").join(
        items.select(*ITEM_FEATURES), "podcast_id", "left")
    j = j.withColumn("embedding_score", F.lit(0.0)).withColumn("collab_score", F.lit(0.0))
    return derive_features(j, norms, prefs)


@dataclass
class RankerModel:
    model: object            # fitted pyspark.ml PipelineModel
    norms: Norms
    prefs: DataFrame
    params: dict
    _map: DataFrame | None = None

    def prefs_by_user(self) -> DataFrame:
        """The per-user share map, written once."""
        if self._map is None:
            from ..session import shuffles_dropped, written
            with shuffles_dropped(self.prefs.sparkSession):
                self._map = written(prefs_map(self.prefs), "prefs-map")
        return self._map


def bin_values(frame: DataFrame) -> dict[str, list[float]]:
    """Ascending values that stand for the bins of each feature: all it has, or
    ``BINS`` chosen from ``QUANTILES`` quantiles over all rows. A split lies
    halfway between two of them."""
    out = {}
    for c in FEATURE_COLS:
        few = [r[0] for r in frame.select(c).distinct().limit(BINS + 1).collect()]
        out[c] = sorted(few) if len(few) <= BINS else None
    many = [c for c in FEATURE_COLS if out[c] is None]
    if many:
        probs = [(i + 0.5) / QUANTILES for i in range(QUANTILES)]
        out.update(zip(many, map(_chosen, frame.approxQuantile(many, probs, 0.25 / QUANTILES)), strict=True))
    return out


def _chosen(sample: list[float]) -> list[float]:
    """``BINS`` values of a sample, or all if it has no more: its values in order
    are dealt to bins of near equal rows, a frequent value takes a bin alone and
    leaves the others smaller; the middle row's value stands for its bin."""
    counts = sorted(Counter(sample).items())
    out, at, left = [], 0, len(sample)
    while at < len(counts):
        bins, held = BINS - len(out), []
        while at < len(counts) and (not held or (len(held) + counts[at][1] / 2 <= left / bins and len(counts) - at >= bins)):
            held += [counts[at][0]] * counts[at][1]
            at += 1
        out.append(held[len(held) // 2])
        left -= len(held)
    return out


def _bin_edges(values: list[float]) -> tuple[list[float], list[float]]:
    """(values kept, first double right of the split halfway between each two of
    them); a value whose split no double sets apart from the one before goes."""
    kept, edges = values[:1], []
    for v in values[1:]:
        e = math.nextafter((kept[-1] + v) / 2.0, math.inf)
        if (edges[-1] if edges else -math.inf) < e < math.inf:
            kept.append(v)
            edges.append(e)
    return kept, edges


def binned_groups(frame: DataFrame, values: dict[str, list[float]]) -> DataFrame:
    """The rows added up by the bins of their features: one row per combination
    that occurs, with each feature's bin value, the mean rating and the number of
    rows as ``weight``. The split halfway between two bin values parts the rows as
    it parts their values, and squared loss needs no more than number and mean of
    the rows that no split parts, so trees fitted on this are those of the rows."""
    from pyspark.ml.feature import Bucketizer
    bins = [f"_{c}" for c in FEATURE_COLS]
    kept, edges = zip(*[_bin_edges(values[c]) for c in FEATURE_COLS], strict=True)
    # a bucket begins right of the split, as a tree sends the split's own value to the left
    splits = [[-math.inf, *e, math.inf] if e else [-math.inf, 0.0, math.inf] for e in edges]
    j = Bucketizer(splitsArray=splits, inputCols=FEATURE_COLS, outputCols=bins).transform(frame)
    for b, e in zip(bins, edges, strict=True):
        j = j.withColumn(b, F.col(b).cast("int") if e else F.lit(0))
    # a missing rating is refused by the fit, so it must not vanish in the mean
    mean = F.when(F.count("rating") == F.count(F.lit(1)), F.avg("rating"))
    g = j.groupBy(*bins).agg(mean.alias("rating"), F.count(F.lit(1)).cast("double").alias("weight"))
    value = [F.element_at(F.array(*[F.lit(float(v)) for v in k]), F.col(b) + 1).alias(c)
             for c, b, k in zip(FEATURE_COLS, bins, kept, strict=True)]
    return g.select(*value, "rating", "weight")


def fit_ranker(train: DataFrame, items: DataFrame, n_trees: int = 100,
               learning_rate: float = 0.05, max_depth: int = 5, seed: int = 42) -> RankerModel:
    """R2: squared-loss gradient-boosted trees on the eight features. Beyond
    ``ALL_ROWS`` rows, where MLlib would take its split candidates from a sample,
    they come from all rows, the frame is added up by them (``binned_groups``)
    and the groups are boosted in one task, if they are not too many (``boost``).
    Else every level of every tree is a job over the frame, which is dealt evenly to as many tasks as there are cores, more once a task
    would hold over ``ROWS_PER_TASK`` rows, and persisted for the boosting
    passes; trees are shallow, so node-id caching is off."""
    from pyspark import StorageLevel
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from ..session import shuffles_dropped, written
    from .boost import GroupBoosting
    with shuffles_dropped(train.sparkSession):
        prefs = written(category_prefs(train, items), "prefs")      # re-joined at every prediction
    norms = collect_norms(items)
    tf = training_frame(train, items, norms, prefs).select(*FEATURE_COLS, "rating")
    assembler = VectorAssembler(inputCols=FEATURE_COLS, outputCol="features")
    n, held = train.count(), []
    gbt = (GroupBoosting if n > ALL_ROWS else GBTRegressor)(
        featuresCol="features", labelCol="rating", predictionCol="ranker_score", maxIter=n_trees, stepSize=learning_rate,
        maxDepth=max_depth, seed=seed, lossType="squared", cacheNodeIds=False)
    try:
        if n > ALL_ROWS:
            with shuffles_dropped(train.sparkSession):
                frame = written(tf, "ranker-frame")
                values = bin_values(frame)
                drop(frame)                 # before the groups take their place
                tf = written(binned_groups(tf, values), "ranker-groups")
            n = tf.count()
            # enough bins allowed that MLlib looks at every group for the bin values, none is drawn
            gbt = gbt.setWeightCol("weight").setMaxBins(max(BINS, math.isqrt(n) + 1))
        tasks = max(train.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
        held.append(assembler.transform(tf).drop(*FEATURE_COLS).repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK))
        gbt = gbt.fit(held[-1])
    finally:
        for d in held:
            d.unpersist()
    model = PipelineModel(stages=[assembler, gbt])
    params = {"n_trees": n_trees, "learning_rate": learning_rate, "max_depth": max_depth, "seed": seed}
    return RankerModel(model, norms, prefs, params)


def feature_importances(rm: RankerModel, spark) -> DataFrame:
    """Importances sorted descending."""
    imp = rm.model.stages[-1].featureImportances.toArray()
    rows = sorted(zip(FEATURE_COLS, [float(x) for x in imp]), key=lambda t: -t[1])
    return spark.createDataFrame(rows, "feature string, importance double")


def predict(rm: RankerModel, df: DataFrame) -> DataFrame:
    feats = derive_features(df, rm.norms, rm.prefs_by_user())
    out = rm.model.transform(feats).drop("features")
    return out


def topk_per_group(df: DataFrame, k: int, score: str, group: str = "user_id",
                   tie=("podcast_id",), out_col: str | None = None) -> DataFrame:
    """K2: ``nlargest(k)`` per group; Spark plans a partial WindowGroupLimit
    before the shuffle, so a hot group sends at most k rows per map task."""
    order = [F.col(score).desc()] + [F.col(t).asc() for t in tie]
    rn = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    out = df.withColumn("_rn", rn).filter(F.col("_rn") <= k)
    return out.withColumnRenamed("_rn", out_col) if out_col else out.drop("_rn")


def mmr_rerank(scored: DataFrame, k: int, lam: float = 0.1, score: str = "ranker_score",
               group: str = "user_id", category: str = "category", pos=("podcast_id",),
               out_col: str = "mmr_rank") -> DataFrame:
    """R4 in closed form: the j-th item of a category (score order) has value
    ``lam*score - (1-lam)*min(0.3*(j-1), 0.9)``; the selection is the top k by
    that value, first pick = top score. Valid for 0 < lam <= 1.

    Only the first k items of each category can be chosen, so the per-category
    window is cut to k rows (partial limit before the shuffle)."""
    wc = Window.partitionBy(group, category).orderBy(F.col(score).desc(), *[F.col(p).asc() for p in pos])
    j = scored.withColumn("_j", F.row_number().over(wc)).filter(F.col("_j") <= k)
    return mmr_order(j, k, lam, score, group, pos, out_col)


def mmr_order(numbered: DataFrame, k: int, lam: float, score: str = "ranker_score", group: str = "user_id",
              pos=("podcast_id",), out_col: str = "mmr_rank") -> DataFrame:
    """The selection of ``mmr_rerank`` over rows that carry their place ``_j``
    in their category already. The top-scoring item always has the largest
    value (no penalty), so it is the first pick; ties go to candidate order."""
    if not (0 < lam <= 1):
        raise ValueError("diversity penalty must satisfy 0 < lambda <= 1")
    pen = F.least(F.lit(MMR_STEP) * (F.col("_j") - 1), F.lit(MMR_CAP))
    v = F.lit(lam) * F.col(score) - F.lit(1.0 - lam) * pen
    wv = Window.partitionBy(group).orderBy(F.col("_v").desc(), *[F.col(p).asc() for p in pos])
    out = numbered.withColumn("_v", v).withColumn(out_col, F.row_number().over(wv)).filter(F.col(out_col) <= k)
    return out.drop("_j", "_v")


def rank_candidates(rm: RankerModel, candidates: DataFrame, k: int = 10,
                    diversity_penalty: float = 0.1, history: DataFrame | None = None,
                    pos=("podcast_id",), bounded: bool = False) -> DataFrame:
    """Drop history (anti join), features, predict, per-user min-max
    (hi > lo), then MMR (penalty > 0) or plain top-k. Adds ``rank``.
    ``bounded``: each user's candidate set is small (a retrieval pool)."""
    if history is not None:
        candidates = candidates.join(history.select("user_id", "podcast_id"),
                                     ["user_id", "podcast_id"], "left_anti")
    scored = predict(rm, candidates)
    keep = list(dict.fromkeys(candidates.columns + ["ranker_score"]))
    scored = scored.select(*keep)
    scored = minmax_by_group(scored, "ranker_score", "user_id", require_spread=False, bounded=bounded)
    if diversity_penalty > 0 and "category" in scored.columns:
        return mmr_rerank(scored, k, diversity_penalty, pos=pos, out_col="rank")
    return topk_per_group(scored, k, "ranker_score", tie=pos, out_col="rank")


def ndcg_at_k(df: DataFrame, k: int = 10, score: str = "score", rating: str = "rating",
              user: str = "user_id", by=()) -> DataFrame:
    """M1: mean over users (with >= 2 rows) of graded NDCG@k with tie-averaged
    gains (rows sharing a score share their mean gain), per ``by`` group.

    Work per user is bounded by k: tie groups are aggregated first (partial
    aggregation), only the top-k score groups and the top-k ratings are kept
    (partial window limits before the shuffle)."""
    by = list(by)
    key = by + [user]
    disc = lambda p: F.lit(1.0) / F.log2(p + F.lit(1.0))
    users = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
               .filter(F.col("_n") >= 2).select(*key))
    ties = df.groupBy(*key, score).agg(F.avg(rating).alias("_g"), F.count(F.lit(1)).alias("_c"))
    wg = Window.partitionBy(*key).orderBy(F.col(score).desc())
    top = ties.withColumn("_r", F.row_number().over(wg)).filter(F.col("_r") <= k)
    top = top.withColumn("_start", F.coalesce(
        F.sum("_c").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1)
    # positions start .. min(start + c - 1, k) of a tie group all earn gain g
    pos = F.sequence(F.col("_start").cast("int"), F.least(F.col("_start") + F.col("_c") - 1, F.lit(k)).cast("int"))
    dsum = F.aggregate(F.transform(pos, lambda p: F.lit(1.0) / F.log2(p.cast("double") + 1.0)),
                       F.lit(0.0), lambda a, x: a + x)
    dcg = top.filter(F.col("_start") <= k).groupBy(*key).agg(F.sum(F.col("_g") * dsum).alias("_dcg"))
    wi = Window.partitionBy(*key).orderBy(F.col(rating).desc())
    ideal = (df.select(*key, rating).withColumn("_p", F.row_number().over(wi))
               .filter(F.col("_p") <= k)
               .groupBy(*key).agg(F.sum(F.col(rating) * disc(F.col("_p").cast("double"))).alias("_idcg")))
    per_user = (users.join(dcg, key, "left").join(ideal, key, "left")
                .select(*key, F.when(F.col("_idcg") > 0, F.col("_dcg") / F.col("_idcg"))
                        .otherwise(F.lit(0.0)).alias("ndcg")))
    if by:
        return per_user.groupBy(*by).agg(F.avg("ndcg").alias("ndcg"), F.count(F.lit(1)).alias("n_users"))
    return per_user.agg(F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg"),
                        F.count(F.lit(1)).alias("n_users"))
