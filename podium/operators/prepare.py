"""Validation, sparse-user filtering, id encoding and the temporal split."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import instant
from .ordering import global_row_number, prefix_sums

# Required columns of the two canonical tables.
ITEM_REQUIRED = ["podcast_id", "title", "description", "category"]
INTERACTION_REQUIRED = ["user_id", "podcast_id", "rating", "timestamp"]
RATING_MIN, RATING_MAX = 0.0, 5.0


def missing_columns(df: DataFrame, required) -> list[str]:
    """Set difference of required and actual columns (schema only)."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required, name: str) -> None:
    miss = missing_columns(df, required)
    if miss:
        raise ValueError(f"table {name!r} lacks required columns: {', '.join(miss)}")


def item_checks(items: DataFrame) -> DataFrame:
    """One aggregate: rows, distinct ids, null ids, null descriptions, categories."""
    return items.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("podcast_id").alias("n_distinct_ids"),
        F.count_if(F.col("podcast_id").isNull()).alias("n_null_ids"),
        F.count_if(F.col("description").isNull()).alias("n_null_description"),
        F.countDistinct("category").alias("n_categories"))


def interaction_checks(df: DataFrame) -> DataFrame:
    """One aggregate: rows, users, items, and ratings outside [0, 5] (null fails)."""
    bad = F.col("rating").isNull() | ~F.col("rating").between(RATING_MIN, RATING_MAX)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("podcast_id").alias("n_items"),
        F.count_if(bad).alias("n_bad_rating"))


def validate_items(items: DataFrame) -> dict:
    require_columns(items, ITEM_REQUIRED, "podcasts")
    r = item_checks(items).first().asDict()
    # A null id fails uniqueness: distinct ignores it, the row count does not.
    if r["n_distinct_ids"] != r["n_rows"]:
        raise AssertionError("item ids must be present and unique")
    if r["n_null_description"]:
        raise AssertionError("every item needs a description")
    return r


def validate_interactions(df: DataFrame) -> dict:
    require_columns(df, INTERACTION_REQUIRED, "interactions")
    r = interaction_checks(df).first().asDict()
    if r["n_bad_rating"]:
        raise AssertionError(f"{r['n_bad_rating']} ratings are absent or outside {RATING_MIN}..{RATING_MAX}")
    return r


def duplicate_ids(items: DataFrame, key: str = "podcast_id") -> DataFrame:
    """Offending ids: those seen more than once, plus NULL ids."""
    return (items.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                 .filter((F.col("n") > 1) | F.col(key).isNull()))


def range_violations(df: DataFrame, col: str = "rating",
                     lo: float = RATING_MIN, hi: float = RATING_MAX) -> DataFrame:
    return df.filter(F.col(col).isNull() | ~F.col(col).between(lo, hi))


def filter_active_users(df: DataFrame, min_interactions: int = 5) -> DataFrame:
    """Keep rows of users with at least ``min_interactions`` rows (not distinct
    items). The per-user counts are a partial aggregate; the semi join lets AQE
    broadcast them when small or split a hot user's rows when skewed."""
    active = (df.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") >= min_interactions).select("user_id"))
    return df.join(active, "user_id", "left_semi")


def encode_ids(df: DataFrame, key: str, idx_col: str) -> DataFrame:
    """Dense 0-based index over the sorted distinct values of ``key``
    (LabelEncoder semantics) as a mapping table ``(key, idx_col)``."""
    ids = df.select(key).where(F.col(key).isNotNull()).distinct()
    ranked = global_row_number(ids, [key], out_col="_rn")
    return ranked.select(key, (F.col("_rn") - 1).cast("int").alias(idx_col))


def _boundary(df: DataFrame, ts_col: str, n_train: int, n: int, n_dated: int):
    """Where the cumulative count reaches ``n_train`` in time order (nulls
    last): (epoch micros or None for NULL, rows needed from it, its size). The
    counts per timestamp stay distributed; one row reaches the driver."""
    per_ts = df.where(F.col(ts_col).isNotNull()).groupBy(
        F.lit(0).alias("_g"), F.unix_micros(F.col(ts_col).cast("timestamp")).alias("_t")).agg(F.count(F.lit(1)).alias("_c"))
    reached = prefix_sums(per_ts, "_g", "_t", ["_c"]).where(F.col("cum__c") >= n_train)
    at = reached.agg(F.min(F.struct("_t", "_c", "cum__c")).alias("at")).first()["at"]
    if at is None:
        return None, n_train - n_dated, n - n_dated
    return at["_t"], n_train - int(at["cum__c"]) + at["_c"], at["_c"]


def temporal_split(df: DataFrame, test_size: float = 0.2, ts_col: str = "timestamp", tie_cols=None):
    """Global time split: order all rows by timestamp (nulls last); the first
    ``int(n * (1 - test_size))`` rows are train. Ties on the boundary
    timestamp are broken by ``tie_cols`` (default: the other columns).

    One count pass and one pass over the counts per timestamp find the
    boundary; both sides compare the bare column with a literal of its type,
    so the bound reaches the scan, and only rows on the boundary are ranked."""
    tie_cols = tie_cols or [c for c in df.columns if c != ts_col]
    size = df.agg(F.count(F.lit(1)).alias("n"), F.count(ts_col).alias("dated")).first()
    n_train = int(size["n"] * (1 - test_size))
    if n_train <= 0:
        return df.limit(0), df
    if n_train >= size["n"]:
        return df, df.limit(0)
    t_star, need, group_size = _boundary(df, ts_col, n_train, size["n"], size["dated"])
    ts = F.col(ts_col)
    at = None if t_star is None else instant(t_star, df.schema[ts_col].dataType)
    on_b = ts.isNull() if at is None else (ts == at)
    before = ts.isNotNull() if at is None else (ts < at)
    after = F.lit(False) if at is None else (ts > at) | ts.isNull()
    if need >= group_size:
        return (df if at is None else df.filter(ts <= at)), df.filter(after)
    ranked = global_row_number(df.filter(on_b), list(tie_cols), out_col="_rn")
    b_train = ranked.filter(F.col("_rn") <= need).drop("_rn")
    b_test = ranked.filter(F.col("_rn") > need).drop("_rn")
    return (df.filter(before).unionByName(b_train),
            b_test.unionByName(df.filter(after)))


def dataset_stats(items: DataFrame, interactions: DataFrame) -> DataFrame:
    """Validation statistics in long form ``(metric, value)``: two single-row
    aggregates stacked, exact distinct counts."""
    i = item_checks(items).select(
        F.stack(F.lit(2), F.lit("n_items"), F.col("n_rows"),
                F.lit("n_categories"), F.col("n_categories")).alias("metric", "value"))
    x = interaction_checks(interactions).select(
        F.stack(F.lit(4), F.lit("n_interactions"), F.col("n_rows"),
                F.lit("n_users"), F.col("n_users"),
                F.lit("n_interacted_items"), F.col("n_items"),
                F.lit("n_bad_rating"), F.col("n_bad_rating")).alias("metric", "value"))
    return i.unionByName(x).select("metric", F.col("value").cast("long").alias("value"))


@dataclass
class Dataset:
    items: DataFrame
    interactions: DataFrame
    train: DataFrame
    test: DataFrame
    user_index: DataFrame
    item_index: DataFrame


def load_dataset(items: DataFrame, interactions: DataFrame, test_size: float = 0.2,
                 min_interactions: int = 5, validate: bool = True) -> Dataset:
    """Validate, drop sparse users, encode ids on all remaining rows, split."""
    if validate:
        validate_items(items)
        validate_interactions(interactions)
    active = filter_active_users(interactions, min_interactions)
    user_index = encode_ids(active, "user_id", "user_idx")
    item_index = encode_ids(active, "podcast_id", "podcast_idx")
    train, test = temporal_split(active, test_size)
    return Dataset(items, active, train, test, user_index, item_index)
