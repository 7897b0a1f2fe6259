"""Popularity, rating matrix, centred truncated SVD, CF scoring and RMSE/MAE.

Tables stay long (``user_idx, podcast_idx, value``). The factors come from
a truncated SVD with both sides distributed (``factor``) at every size;
alternating least squares is a second method, taken only when asked for.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import dot
from ..session import reliable_checkpoint, ship_package, shuffles_dropped, written
from . import factor
from .sampling import uniform01


def one_row(df: DataFrame):
    """First row of a global aggregate (a single row by construction)."""
    return df.first()


def popularity(train: DataFrame) -> DataFrame:
    """Per item: count ``n``, share ``n / total`` and fallback score
    ``n / max n`` (A2, A3). The two scalars come from one global aggregate
    over the per-item counts, so no single-partition window is planned."""
    counts = train.groupBy("podcast_id").agg(F.count(F.lit(1)).alias("n"))
    tot = one_row(counts.agg(F.sum("n").alias("total"), F.max("n").alias("max_n")))
    total, max_n = (tot["total"] or 0), (tot["max_n"] or 0)
    return counts.select(
        "podcast_id", "n",
        (F.col("n") / F.lit(float(total or 1))).alias("pop_share"),
        (F.col("n") / F.lit(float(max_n or 1))).alias("pop_score"))


def rating_matrix(train: DataFrame, user_index: DataFrame, item_index: DataFrame) -> DataFrame:
    """Sparse matrix cells; duplicate (user, item) ratings are summed."""
    return (train.join(user_index, "user_id").join(item_index, "podcast_id")
                 .groupBy("user_idx", "podcast_idx")
                 .agg(F.sum("rating").alias("value")))


def user_means(cells: DataFrame, user_index: DataFrame, n_items: int) -> DataFrame:
    """Row sum divided by the number of *all* items (A7); users without train
    rows get 0."""
    sums = cells.groupBy("user_idx").agg(F.sum("value").alias("row_sum"))
    return user_index.join(sums, "user_idx", "left").select(
        "user_id", "user_idx",
        (F.coalesce(F.col("row_sum"), F.lit(0.0)) / F.lit(float(n_items))).alias("mu"))


@dataclass
class CFModel:
    user_factors: DataFrame   # user_idx, factors array<double>
    item_factors: DataFrame   # podcast_idx, factors array<double>
    user_means: DataFrame     # user_id, user_idx, mu
    user_index: DataFrame
    item_index: DataFrame
    popularity: DataFrame     # podcast_id, n, pop_share, pop_score
    n_factors: int
    singular_values: list
    blocks: factor.Factors | None = None
    _tables: tuple | None = field(default=None, repr=False)

    def scoring_tables(self):
        """Per-user table (user_id, user_idx, mu, pu) and per-item table
        (podcast_id, podcast_idx, qi, pop_score), written once (lineage cut),
        plus the item count used for the broadcast size check."""
        if self._tables is None:
            users = (self.user_means.join(self.user_factors.withColumnRenamed("factors", "pu"), "user_idx", "left")
                     .select("user_id", "user_idx", "mu", "pu"))
            items = (self.item_index.join(self.item_factors.withColumnRenamed("factors", "qi"), "podcast_idx", "left")
                     .join(self.popularity.select("podcast_id", "pop_score"), "podcast_id", "full_outer"))
            users, items = reliable_checkpoint(users), reliable_checkpoint(items)
            self._tables = (users, items, items.count())
        return self._tables


def _centred_cells(train, user_index, item_index, n_items):
    """(cells less their user's mean without those that vanish, user means), both written."""
    with shuffles_dropped(train.sparkSession):
        cells = written(rating_matrix(train, user_index, item_index), "cf-cells")
        means = written(user_means(cells, user_index, n_items), "cf-means")
        centred = written(cells.join(means.select("user_idx", "mu"), "user_idx").select(
            "user_idx", "podcast_idx", (F.col("value") - F.col("mu")).alias("v")).where("v <> 0"), "cf-centred")
    factor.drop(cells)
    return centred, means


def _als_factors(centred: DataFrame, k: int, seed: int):
    """(user factors, item factors, no singular values) by alternating least squares."""
    from pyspark.ml.recommendation import ALS
    fit = ALS(rank=k, userCol="user_idx", itemCol="podcast_idx", ratingCol="v", seed=seed).fit(centred)
    side = lambda df, idx: reliable_checkpoint(df.select(
        F.col("id").alias(idx), F.col("features").cast("array<double>").alias("factors")))
    return side(fit.userFactors, "user_idx"), side(fit.itemFactors, "podcast_idx"), []


def fit_cf(train: DataFrame, user_index: DataFrame, item_index: DataFrame,
           n_factors: int = 64, method: str = "svd", seed: int = 42) -> CFModel:
    """Centre stored cells by the user mean (zeros stay zero) and factorise
    (C1): ``svd`` (default) or ``als``. ``n_factors`` is clamped to the item
    count; singular values that vanish are left out. Cells that are zero after
    centring add nothing and go; with none left all factors are zero."""
    if method not in ("svd", "als"):
        raise ValueError("method is 'svd' or 'als'")
    spark = train.sparkSession
    ship_package(spark)
    n_items = int(item_index.count())
    centred, means = _centred_cells(train, user_index, item_index, n_items)
    k, blocks = max(1, min(int(n_factors), n_items)), None
    if centred.isEmpty():
        none = lambda idx: spark.createDataFrame([], f"{idx} int, factors array<double>")
        users, items, s, k = none("user_idx"), none("podcast_idx"), [0.0], 1
    elif method == "als":
        users, items, s = _als_factors(centred, k, seed)
    else:
        blocks = factor.factorised(centred, "user_idx", "podcast_idx", user_index.count(), n_items, k, seed, spent=True)
        users, items, s = blocks.row_vectors("user_idx"), blocks.col_vectors("podcast_idx"), blocks.values
        k = len(s)
    return CFModel(users, items, means, user_index, item_index, popularity(train), k, s, blocks)


# Largest item table (index, factors, popularity) broadcast to every task.
BROADCAST_ITEM_BYTES = 64 * 1024 * 1024


def raw_cf_scores(model: CFModel, pairs: DataFrame) -> DataFrame:
    """``mu + P.Q`` for (user_id, podcast_id) pairs: unknown item 0.0 for a known
    user; unknown user gets the popularity fallback. Adds ``known_user``.

    Candidate rows are shuffled once, without arrays, against the per-user
    table; the item table is broadcast when its size (items x factors) is
    under ``BROADCAST_ITEM_BYTES`` so the dot products run in the same stage.
    Beyond that bound the products come from the model's factor blocks, and no
    vector is shuffled (a model without blocks: joined by shuffle)."""
    if model.blocks is not None and model.item_index.count() * (model.n_factors + 4) * 8 > BROADCAST_ITEM_BYTES:
        return _raw_by_blocks(model, pairs)
    zero = F.array_repeat(F.lit(0.0), model.n_factors)
    users, items, n_items = model.scoring_tables()
    if n_items * (model.n_factors + 4) * 8 <= BROADCAST_ITEM_BYTES:
        items = F.broadcast(items)
    j = pairs.join(users, "user_id", "left").join(items, "podcast_id", "left")
    known = F.col("user_idx").isNotNull()
    cf = F.when(F.col("podcast_idx").isNull(), F.lit(0.0)).otherwise(
        F.col("mu") + dot(F.coalesce("pu", zero), F.coalesce("qi", zero)))
    score = F.when(known, cf).otherwise(F.coalesce(F.col("pop_score"), F.lit(0.0)))
    return j.select(*pairs.columns, known.alias("known_user"), score.alias("collab_score"))


def _raw_by_blocks(model: CFModel, pairs: DataFrame) -> DataFrame:
    """The scores of distinct pairs step by step, each written and the one before
    dropped, so that at most one join's shuffle files lie beside the factors."""
    items = model.item_index.join(model.popularity.select("podcast_id", "pop_score"), "podcast_id", "full_outer")
    users = model.user_means.select("user_id", "user_idx", "mu")
    with shuffles_dropped(pairs.sparkSession):
        asked = written(pairs.select("user_id", "podcast_id").distinct().join(users, "user_id", "left"), "cf-asked")
        numbered = written(asked.join(items, "podcast_id", "left"), "cf-numbered")
        factor.drop(asked)
        dots = factor.pair_products(model.blocks, numbered.where("user_idx is not null and podcast_idx is not null").select(
            "user_idx", "podcast_idx").distinct(), "user_idx", "podcast_idx", "_dot")
        known = F.col("user_idx").isNotNull()
        cf = F.when(F.col("podcast_idx").isNull(), F.lit(0.0)).otherwise(F.col("mu") + F.coalesce("_dot", F.lit(0.0)))
        score = F.when(known, cf).otherwise(F.coalesce(F.col("pop_score"), F.lit(0.0)))
        scores = written(numbered.join(dots, ["user_idx", "podcast_idx"], "left").select(
            F.col("user_id").alias("_u"), F.col("podcast_id").alias("_p"), known.alias("known_user"), score.alias("collab_score")), "cf-scores")
        factor.drop(numbered)
        factor.drop(dots)
        out = written(pairs.join(scores, F.col("user_id").eqNullSafe(F.col("_u")) & F.col("podcast_id").eqNullSafe(F.col("_p")), "left").drop("_u", "_p"), "cf-raw")
    factor.drop(scores)
    return out


def minmax_by_group(df: DataFrame, score: str, group: str = "user_id",
                    require_spread: bool = True, only_when=None, bounded: bool = False) -> DataFrame:
    """Per-group min-max scaling (N8/A10/A11). Scaling applies when the group
    has more than one row and max > min (equivalent to sample std > 0);
    otherwise raw scores stay.

    Default: per-group stats as a partial aggregate joined back, which
    tolerates hot groups. ``bounded=True`` (groups known to be small, e.g. a
    candidate pool per user): a window over the group, one pass and no join,
    reusing an existing partitioning by the group key."""
    if bounded:
        w = Window.partitionBy(group)
        j = (df.withColumn("_lo", F.min(score).over(w)).withColumn("_hi", F.max(score).over(w))
               .withColumn("_n", F.count(F.lit(1)).over(w)))
    else:
        st = df.groupBy(group).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"),
                                   F.count(F.lit(1)).alias("_n"))
        j = df.join(st, group, "left")
    cond = (F.col("_hi") > F.col("_lo"))
    if require_spread:
        cond = cond & (F.col("_n") > 1)
    if only_when is not None:
        cond = cond & only_when
    scaled = (F.col(score) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    return j.withColumn(score, F.when(cond, scaled).otherwise(F.col(score))).drop("_lo", "_hi", "_n")


def score_cf(model: CFModel, pairs: DataFrame, bounded: bool = False) -> DataFrame:
    """Scores for every requested pair, min-max per known user; users
    unseen by the index keep the popularity score unscaled."""
    raw = raw_cf_scores(model, pairs)
    out = minmax_by_group(raw, "collab_score", "user_id", require_spread=True,
                          only_when=F.col("known_user"), bounded=bounded)
    return out.drop("known_user")


def ranked_cf(model: CFModel, pairs: DataFrame, bounded: bool = False) -> DataFrame:
    """The scores of ``score_cf`` with ``is_new_user`` (true for a user
    the index does not know, whose scores are popularity) and ``rank``, each
    user's place by descending score, ties by item id."""
    raw = raw_cf_scores(model, pairs)
    out = minmax_by_group(raw, "collab_score", "user_id", require_spread=True, only_when=F.col("known_user"), bounded=bounded)
    order = Window.partitionBy("user_id").orderBy(F.col("collab_score").desc(), F.col("podcast_id").asc())
    return out.withColumn("is_new_user", ~F.col("known_user")).drop("known_user").withColumn("rank", F.row_number().over(order))


def error_metrics(pred: DataFrame, pred_col: str = "pred", actual_col: str = "rating") -> DataFrame:
    """RMSE and MAE in one aggregate."""
    d = F.col(pred_col) - F.col(actual_col)
    return pred.agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"),
                    F.count(F.lit(1)).alias("n"))


def evaluate_cf(model: CFModel, test: DataFrame) -> DataFrame:
    """C4: each row is scored alone, so predictions are the raw scores."""
    pred = raw_cf_scores(model, test.select("user_id", "podcast_id", "rating"))
    return error_metrics(pred.withColumnRenamed("collab_score", "pred"))


def holdout_cf(train: DataFrame, user_index: DataFrame, item_index: DataFrame, n_factors: int = 64,
               fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """C5 as a real hold-out: split the training rows by a seeded hash of all
    their columns (equal rows stay together, and a re-run task splits alike),
    refit on the rest and evaluate on the held-out part (the reference
    evaluates rows the model was fitted on). One row: rmse, mae, n."""
    u = uniform01(seed, *train.columns)
    fit_rows, held = train.where(u >= fraction), train.where(u < fraction)
    model = fit_cf(fit_rows, user_index, item_index, n_factors)
    return evaluate_cf(model, held)
