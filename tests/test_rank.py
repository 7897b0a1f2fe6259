import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from podium.operators import rank

SCORED = "user_id string, podcast_id string, category string, ranker_score double"


def test_mmr_example(spark):
    df = spark.createDataFrame([("u", "a1", "A", .9), ("u", "a2", "A", .8), ("u", "a3", "A", .7),
                                ("u", "b1", "B", .1)], SCORED)
    out = rank.mmr_rerank(df, 2, 0.1).orderBy("mmr_rank").collect()
    assert [r.podcast_id for r in out] == ["a1", "b1"]


def test_mmr_lambda_out_of_range(spark):
    df = spark.createDataFrame([("u", "a", "A", .5)], SCORED)
    with pytest.raises(ValueError):
        rank.mmr_rerank(df, 2, 1.3)


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([0.05, 0.1, 0.5, 1.0]), st.integers(1, 6))
def test_mmr_rows_are_the_best_left(spark, seed, lam, k):
    rnd = random.Random(seed)
    users = {}
    for u in range(3):
        n = rnd.randint(1, 12)
        users[f"u{u}"] = [(f"p{u}_{i:02d}", rnd.choice("ABC"), round(rnd.random(), 1)) for i in range(n)]
    data = [(u, p, c, s) for u, rows in users.items() for p, c, s in rows]
    out = rank.mmr_rerank(spark.createDataFrame(data, SCORED), k, lam).collect()
    for u, rows in users.items():
        chosen = [r.podcast_id for r in sorted(out, key=lambda r: r.mmr_rank) if r.user_id == u]
        assert len(chosen) == min(k, len(rows)) == len(set(chosen))
        facts = {p: (c, x) for p, c, x in rows}
        for at, pick in enumerate(chosen):
            taken = [facts[p][0] for p in chosen[:at]]

            def worth(p):
                c, x = facts[p]
                return lam * x - (1 - lam) * min(0.3 * taken.count(c), 0.9) if taken else x  # noqa: B023
            assert worth(pick) >= max(worth(p) for p in facts if p not in chosen[:at]) - 1e-12


def test_ndcg_perfect_is_one_and_ties(spark):
    perfect = spark.createDataFrame([("u", 5.0, 5.0), ("u", 3.0, 3.0), ("u", 1.0, 1.0)],
                                    "user_id string, rating double, score double")
    assert rank.ndcg_at_k(perfect, 10).first()["ndcg"] == pytest.approx(1.0)
    # equal scores, ratings 5 and 1: tie-averaged gain 3 at both positions
    tie = spark.createDataFrame([("u", 5.0, 0.5), ("u", 1.0, 0.5)], "user_id string, rating double, score double")
    import math
    exp = (3 / math.log2(2) + 3 / math.log2(3)) / (5 / math.log2(2) + 1 / math.log2(3))
    assert rank.ndcg_at_k(tie, 10).first()["ndcg"] == pytest.approx(exp)
    swapped = spark.createDataFrame([("u", 1.0, 0.5), ("u", 5.0, 0.5)], "user_id string, rating double, score double")
    assert rank.ndcg_at_k(swapped, 10).first()["ndcg"] == pytest.approx(exp)


def test_ndcg_skips_short_users(spark):
    df = spark.createDataFrame([("u", 5.0, 0.1), ("v", 5.0, 0.1), ("v", 1.0, 0.9)],
                               "user_id string, rating double, score double")
    r = rank.ndcg_at_k(df, 10).first()
    assert r["n_users"] == 1 and r["ndcg"] < 1.0


def test_ndcg_matches_bruteforce(spark):
    import math
    rnd = random.Random(7)
    data = [(f"u{u}", float(rnd.randint(0, 5)), float(rnd.randint(0, 3))) for u in range(6) for _ in range(rnd.randint(1, 15))]
    df = spark.createDataFrame(data, "user_id string, rating double, score double")
    by = {}
    for u, r, s in data:
        by.setdefault(u, []).append((r, s))
    vals = []
    for u, rows in by.items():
        if len(rows) < 2:
            continue
        order = sorted(rows, key=lambda x: -x[1])
        dcg, pos = 0.0, 0
        for s in sorted({x[1] for x in rows}, reverse=True):
            grp = [x[0] for x in order if x[1] == s]
            g = sum(grp) / len(grp)
            for _ in grp:
                pos += 1
                if pos <= 3:
                    dcg += g / math.log2(pos + 1)
        ideal = sorted((x[0] for x in rows), reverse=True)
        idcg = sum(r / math.log2(i + 2) for i, r in enumerate(ideal[:3]))
        vals.append(dcg / idcg if idcg > 0 else 0.0)
    assert rank.ndcg_at_k(df, 3).first()["ndcg"] == pytest.approx(sum(vals) / len(vals))


def test_features_and_ranker(spark):
    items = spark.createDataFrame(
        [(f"p{i}", "AB"[i % 2], 30 + i, 10 + i, float(i * 10), 2000 + i) for i in range(20)],
        "podcast_id string, category string, avg_duration_min int, total_episodes long, play_count double, release_year int")
    train = spark.createDataFrame([(f"u{u}", f"p{(u * 3 + j) % 20}", float((u + j) % 5 + 1)) for u in range(8) for j in range(6)],
                                  "user_id string, podcast_id string, rating double")
    prefs = rank.category_prefs(train, items)
    tot = prefs.groupBy("user_id").agg(F.sum("share").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in tot)
    rm = rank.fit_ranker(train, items, n_trees=5)
    cand = spark.createDataFrame([("u0", f"p{i}") for i in range(20)], "user_id string, podcast_id string") \
        .join(items, "podcast_id")
    hist = train.where("user_id = 'u0'")
    plain = rank.rank_candidates(rm, cand, 5, 0.0, history=hist).orderBy("rank").collect()
    assert len(plain) == 5
    assert [r.ranker_score for r in plain] == sorted([r.ranker_score for r in plain], reverse=True)
    seen = {r.podcast_id for r in hist.collect()}
    assert not seen & {r.podcast_id for r in plain}
    assert 0.0 <= min(r.ranker_score for r in plain) and max(r.ranker_score for r in plain) <= 1.0


def test_boosting_rows_are_dealt_by_cores_and_number(spark, monkeypatch):
    """One task per core, whatever the joins left; more once a task would hold too many rows."""
    from pyspark.ml.regression import GBTRegressor
    items = spark.createDataFrame([(f"p{i}", f"c{i % 3}", 10 * i, i, float(i), 2000 + i) for i in range(10)],
                                  "podcast_id string, category string, avg_duration_min int, total_episodes long, play_count double, release_year int")
    train = spark.createDataFrame([(f"u{i % 7}", f"p{i % 10}", float(i % 5)) for i in range(100)], "user_id string, podcast_id string, rating double")
    seen, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, data: seen.append((data.rdd.getNumPartitions(), data.count())) or fit(self, data))
    for rows in (rank.ROWS_PER_TASK, 10):
        monkeypatch.setattr(rank, "ROWS_PER_TASK", rows)
        rank.fit_ranker(train, items, n_trees=1)
    assert seen == [(spark.sparkContext.defaultParallelism, 100), (10, 100)]


def _ranker_tables(spark, n_items, times=1):
    rng = np.random.default_rng(3)
    items = spark.createDataFrame([(f"p{i}", f"c{i % 4}", int(rng.integers(1, 60)), int(rng.integers(1, 90)), float(rng.lognormal(3, 2)), int(rng.integers(2000, 2005)))
                                   for i in range(n_items)],
                                  "podcast_id string, category string, avg_duration_min int, total_episodes long, play_count double, release_year int")
    rows = [(f"u{rng.integers(0, 40)}", f"p{rng.integers(0, n_items)}", float(rng.integers(1, 51)) / 10) for _ in range(1500)]
    train = spark.createDataFrame(rows * times, "user_id string, podcast_id string, rating double")
    return train, items


def test_boosting_on_groups_is_boosting_on_rows(spark, monkeypatch):
    """Up to 32 values a feature: same trees. The groups do not grow with copies of the rows."""
    from pyspark.ml.regression import GBTRegressor
    seen, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, data: seen.append(data.count()) or fit(self, data))
    # shares of five values only, so that every feature has at most 32
    monkeypatch.setattr(rank, "category_prefs", lambda t, i, real=rank.category_prefs: real(t, i).withColumn("share", F.round(F.col("share") * 10) / 10))
    scores = []
    for rows, times in ((10_000, 1), (1_000, 1), (1_000, 3)):
        monkeypatch.setattr(rank, "ALL_ROWS", rows)
        train, items = _ranker_tables(spark, 30, times)
        rm = rank.fit_ranker(train, items, n_trees=6)
        df = train.distinct().select("user_id", "podcast_id").join(items, "podcast_id")
        scores.append({(r.user_id, r.podcast_id): r.ranker_score for r in rank.predict(rm, df).collect()})
    assert seen[0] == 1500 and seen[1] < 700 and seen[2] == seen[1]
    for other in scores[1:]:
        assert other == pytest.approx(scores[0], abs=1e-9)
    assert len(set(scores[0].values())) > 10


def test_splits_part_rows_as_they_part_groups(spark, monkeypatch):
    """More than 32 values a feature: a row and the group it was added to get the same score."""
    train, items = _ranker_tables(spark, 400)
    monkeypatch.setattr(rank, "ALL_ROWS", 100)
    kept = []
    groups = rank.binned_groups
    monkeypatch.setattr(rank, "binned_groups", lambda frame, values: kept.append((frame, values)) or groups(frame, values))
    rm = rank.fit_ranker(train, items, n_trees=6)
    (frame, values), = kept
    assert max(len(v) for v in values.values()) == rank.BINS and values["collab_score"] == [0.0]
    raw = rm.model.transform(frame).agg(F.count("*").alias("n"), F.sum("ranker_score").alias("s"), F.sum("rating").alias("r")).first()
    g = rm.model.transform(groups(frame, values))
    got = g.agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("ranker_score")).alias("s"), F.sum(F.col("weight") * F.col("rating")).alias("r")).first()
    assert (got.n, got.s, got.r) == (raw.n, pytest.approx(raw.s, abs=1e-6), pytest.approx(raw.r, abs=1e-6))
    nearest = [[min(values[c], key=lambda v, x=r[c]: (abs(v - x), v)) for c in rank.FEATURE_COLS] for r in frame.collect()]
    assert {tuple(r[c] for c in rank.FEATURE_COLS) for r in groups(frame, values).collect()} == {tuple(x) for x in nearest}


def test_a_missing_rating_is_refused_by_the_grouped_fit_too(spark, monkeypatch):
    train, items = _ranker_tables(spark, 30)
    train = train.unionByName(train.limit(1).withColumn("rating", F.lit(None).cast("double")))
    for rows in (10_000, 100):
        monkeypatch.setattr(rank, "ALL_ROWS", rows)
        with pytest.raises(Exception):
            rank.fit_ranker(train, items, n_trees=1)


def test_bin_values_use_every_bin():
    """Frequent values take one bin and leave the rest to the others; few values keep one each."""
    assert rank._chosen([1.0, 2.0, 2.0, 5.0]) == [1.0, 2.0, 5.0] and rank._chosen([]) == []
    assert rank._chosen([float(i) for i in range(1_024)]) == [32.0 * i + 16 for i in range(32)]
    for sample in ([0.0] * 900 + [float(i) for i in range(124)], [float(i) for i in range(100)] + [200.0] * 900, [float(i) for i in range(33)]):
        got = rank._chosen(sample)
        assert len(got) == rank.BINS and got == sorted(set(got)) and set(got) <= set(sample)


def test_bins_with_splits_that_no_double_sets_apart():
    a = 1.0
    b = np.nextafter(a, 2.0)
    c = np.nextafter(b, 2.0)
    for values in ([a, b, c, 2.0], [0.0], [-np.inf, 0.0, np.inf], [5e-324, 1e-323, 1.0]):
        kept, edges = rank._bin_edges([float(v) for v in values])
        assert len(edges) == len(kept) - 1 and edges == sorted(set(edges)) and all(np.isfinite(edges))


def test_response_joins_items_to_the_first_rows_only(spark, monkeypatch):
    """An id with two item rows takes two places; items join what the top-k left."""
    from types import SimpleNamespace

    from podium.plans import catalog
    ids = [f"p{i:02d}" for i in range(30)]
    items = spark.createDataFrame([(i, f"t{i}", f"c{i}", f"d{i}") for i in [*ids, "p03"]], "podcast_id string, title string, category string, description string")
    train = spark.createDataFrame([("v", i) for n, i in enumerate(ids) for _ in range(30 - n)] + [("u", "p00")], "user_id string, podcast_id string")
    test = spark.createDataFrame([("u", i) for i in ids] * 2, "user_id string, podcast_id string")
    monkeypatch.setattr(catalog, "prepared", lambda s, d: SimpleNamespace(items=items, train=train, test=test))
    joined = []
    topk = rank.topk_per_group
    monkeypatch.setattr(rank, "topk_per_group", lambda df, *a, **k: joined.append("category" in df.columns) or topk(df, *a, **k))
    got = sorted((r["rank"], r.podcast_id) for r in catalog.q_response_shape(spark, "").collect())
    # p03 holds places 3 and 4, and each of these meets both its rows
    assert [p for _, p in got] == ["p01", "p02", "p03", "p03", "p03", "p03", "p04", "p05", "p06", "p07", "p08", "p09"]
    assert joined == [False, True]
