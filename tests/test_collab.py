import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.operators import collab, prepare

INTER = "user_id string, podcast_id string, rating double, timestamp timestamp"
T0 = dt.datetime(2024, 1, 1)


def _index(spark, ids, key, idx):
    return spark.createDataFrame([(v, i) for i, v in enumerate(sorted(ids))], f"{key} string, {idx} int")


def test_duplicate_pair_is_summed(spark):
    train = spark.createDataFrame([("u", "p", 2.0, T0), ("u", "p", 3.0, T0)], INTER)
    cells = collab.rating_matrix(train, _index(spark, ["u"], "user_id", "user_idx"),
                                 _index(spark, ["p"], "podcast_id", "podcast_idx")).collect()
    assert [(c.value) for c in cells] == [5.0]


def test_user_mean_divides_by_all_items(spark):
    train = spark.createDataFrame([("u", "p0", 4.0, T0)], INTER)
    ui = _index(spark, ["u"], "user_id", "user_idx")
    ii = _index(spark, [f"p{i}" for i in range(8)], "podcast_id", "podcast_idx")
    mu = collab.user_means(collab.rating_matrix(train, ui, ii), ui, 8).first()["mu"]
    assert mu == pytest.approx(0.5)


def _fit_small(spark, n_factors=64):
    rows = [("u1", "a", 5.0), ("u1", "b", 3.0), ("u2", "a", 4.0), ("u2", "c", 1.0), ("u3", "b", 2.0),
            ("u3", "c", 5.0), ("u1", "c", 2.0)]
    train = spark.createDataFrame([(u, p, r, T0) for u, p, r in rows], INTER)
    ui = _index(spark, ["u1", "u2", "u3", "u4"], "user_id", "user_idx")   # u4: test-only user
    ii = _index(spark, ["a", "b", "c"], "podcast_id", "podcast_idx")
    return collab.fit_cf(train, ui, ii, n_factors), rows


def test_factors_clamped_and_reconstruct(spark):
    cf, rows = _fit_small(spark, 64)
    assert cf.n_factors <= 3
    users, items = ["u1", "u2", "u3", "u4"], ["a", "b", "c"]
    A = np.zeros((4, 3))
    for u, p, r in rows:
        A[users.index(u), items.index(p)] += r
    mu = A.sum(axis=1) / 3
    C = np.where(A != 0, A - mu[:, None], 0.0)
    P = np.zeros((4, cf.n_factors))
    for r in cf.user_factors.collect():
        P[r.user_idx] = r.factors
    Q = np.zeros((3, cf.n_factors))
    for r in cf.item_factors.collect():
        Q[r.podcast_idx] = r.factors
    assert np.abs(P @ Q.T - C).max() < 1e-9  # full rank: exact reconstruction


def _fit_wide(spark, n_items, method="svd", k=6):
    rng = np.random.default_rng(5)
    rows = [(f"u{u}", f"p{int(i):05d}", float(rng.integers(1, 6))) for u in range(6)
            for i in rng.choice(n_items, 40, replace=False)]
    train = spark.createDataFrame([(u, p, r, T0) for u, p, r in rows], INTER)
    ui = _index(spark, [f"u{u}" for u in range(6)], "user_id", "user_idx")
    ii = _index(spark, [f"p{i:05d}" for i in range(n_items)], "podcast_id", "podcast_idx")
    cf = collab.fit_cf(train, ui, ii, k, method=method)
    a = np.zeros((6, n_items))
    for u, p, r in rows:
        a[int(u[1:]), int(p[1:])] += r
    c = np.where(a != 0, a - a.sum(axis=1, keepdims=True) / n_items, 0.0)
    P, Q = np.zeros((6, cf.n_factors)), np.zeros((n_items, cf.n_factors))
    for r in cf.user_factors.collect():
        P[r.user_idx] = r.factors
    for r in cf.item_factors.collect():
        Q[r.podcast_idx] = r.factors
    return cf, c, P, Q


@pytest.mark.parametrize("n_items", [150, 4300])
def test_one_solver_at_every_item_count(spark, n_items):
    cf, c, P, Q = _fit_wide(spark, n_items)
    assert np.allclose(cf.singular_values, np.linalg.svd(c, compute_uv=False), atol=1e-6)
    assert np.abs(P @ Q.T - c).max() < 1e-6


def test_truncated_factors_are_the_best_ones(spark):
    cf, c, P, Q = _fit_wide(spark, 150, k=3)
    u, s, vt = np.linalg.svd(c, full_matrices=False)
    assert cf.n_factors == 3 and np.abs(P @ Q.T - (u[:, :3] * s[:3]) @ vt[:3]).max() < 1e-6


def test_als_only_when_asked_for(spark):
    cf, _, P, Q = _fit_wide(spark, 150, method="als")
    assert P.shape[1] == 6 and np.abs(P).max() > 0 and cf.singular_values == []
    with pytest.raises(ValueError):
        _fit_wide(spark, 150, method="other")


def test_all_cells_zero_after_centring(spark):
    train = spark.createDataFrame([("u", "p", 4.0, T0)], INTER)
    cf = collab.fit_cf(train, _index(spark, ["u"], "user_id", "user_idx"), _index(spark, ["p"], "podcast_id", "podcast_idx"))
    pairs = spark.createDataFrame([("u", "p")], "user_id string, podcast_id string")
    assert collab.raw_cf_scores(cf, pairs).first()["collab_score"] == pytest.approx(4.0)


def test_scores_cold_and_test_only_users(spark):
    cf, _ = _fit_small(spark)
    pairs = spark.createDataFrame([("u4", "a"), ("u4", "b"), ("ghost", "a"), ("ghost", "b"), ("ghost", "c"),
                                   ("u1", "zzz"), ("u1", "a"), ("u1", "b")], "user_id string, podcast_id string")
    s = {(r.user_id, r.podcast_id): r.collab_score for r in collab.score_cf(cf, pairs).collect()}
    # test-only user: zero mean and zero factors -> 0.0, not popularity
    assert s[("u4", "a")] == 0.0 and s[("u4", "b")] == 0.0
    # cold user: popularity n / max n, unscaled; a, b, c each have count 2 or 3
    assert max(s[("ghost", p)] for p in "abc") == pytest.approx(1.0)
    # known user: min-max scaled to [0, 1]
    vals = [s[("u1", p)] for p in ("zzz", "a", "b")]
    assert min(vals) == pytest.approx(0.0) and max(vals) == pytest.approx(1.0)


def test_single_candidate_keeps_raw_score(spark):
    cf, _ = _fit_small(spark)
    pairs = spark.createDataFrame([("u1", "a")], "user_id string, podcast_id string")
    raw = collab.raw_cf_scores(cf, pairs).first()["collab_score"]
    scaled = collab.score_cf(cf, pairs).first()["collab_score"]
    assert scaled == pytest.approx(raw) and raw != 0.0


def test_evaluate_positive(spark):
    cf, _ = _fit_small(spark)
    test = spark.createDataFrame([("u1", "a", 4.0, T0), ("u2", "b", 2.0, T0), ("new", "a", 3.0, T0)], INTER)
    m = collab.evaluate_cf(cf, test).first()
    assert m["rmse"] > 0 and m["mae"] > 0 and m["rmse"] >= m["mae"]


def test_popularity(spark):
    train = spark.createDataFrame([("u", "a", 1.0, T0), ("v", "a", 1.0, T0), ("u", "b", 1.0, T0)], INTER)
    pop = {r.podcast_id: (r.pop_share, r.pop_score) for r in collab.popularity(train).collect()}
    assert pop["a"] == (pytest.approx(2 / 3), 1.0) and pop["b"][1] == 0.5


def test_random_matrix_is_close_to_the_best_rank_k(spark, monkeypatch):
    """Several blocks on both sides, packs of few cells, a popular item, gaps in the ids."""
    from podium.operators import factor
    monkeypatch.setattr(factor, "IDS", 400)
    monkeypatch.setattr(factor, "CELLS", 1500)
    rng = np.random.default_rng(8)
    a = np.zeros((1500, 1300))
    a[rng.integers(0, 1500, 9000), rng.integers(0, 1300, 9000)] = rng.normal(size=9000)
    a[:, 7] = rng.normal(size=1500)
    a += 4 * np.outer(rng.normal(size=1500), (np.arange(1300) % 97 == 0))
    a[40:90], a[:, 100:1050] = 0.0, 0.0
    cells = spark.createDataFrame([(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))], "user_idx int, podcast_idx int, v double")
    users, items, s = factor.truncated_svd(cells, "user_idx", "podcast_idx", 1500, 1300, 20)
    P, Q = np.zeros((1500, 20)), np.zeros((1300, 20))
    for r in users.collect():
        P[r.user_idx] = r.factors
    for r in items.collect():
        Q[r.podcast_idx] = r.factors
    exact = np.linalg.svd(a, compute_uv=False)
    best = np.sqrt((exact[20:] ** 2).sum())
    assert np.abs(Q.T @ Q - np.eye(20)).max() < 1e-8
    assert np.linalg.norm(P @ Q.T - a) < 1.01 * best
    assert np.allclose(s[:5], exact[:5], rtol=1e-3) and not P[45].any() and not Q[500].any()


def test_partial_sums_are_one_per_id_and_group(spark, monkeypatch):
    """Ids meet one group of many blocks, not each block; small groups give the
    same factors, and shuffled and superseded products leave no files behind."""
    import glob
    from podium.operators import factor
    from podium.session import checkpoint_dir
    monkeypatch.setattr(factor, "IDS", 16)
    rng = np.random.default_rng(3)
    cells = spark.createDataFrame([(int(i), int(j), float(rng.normal())) for i in range(60) for j in rng.choice(200, 25, replace=False)],
                                  "user_idx int, podcast_idx int, v double")
    where = checkpoint_dir(spark).removeprefix("file:")
    found = []
    for size in (factor.GROUP_BYTES, 2 * 16 * 15 * 8):          # all blocks, two blocks
        monkeypatch.setattr(factor, "GROUP_BYTES", size)
        packed = factor._packed(cells, "user_idx", "podcast_idx", 15)
        assert packed.select("g").distinct().count() == (1 if size > 1 << 20 else 7)
        assert packed.groupBy("block").count().agg(F.max("count")).first()[0] == packed.select("g").distinct().count()
        before = set(glob.glob(where + "/**/factor-product-*/part-*", recursive=True))
        users, items, s = factor.truncated_svd(cells, "user_idx", "podcast_idx", 60, 200, 5, rounds=1)
        assert set(glob.glob(where + "/**/factor-product-*/part-*", recursive=True)) == before
        P, Q = np.zeros((60, 5)), np.zeros((200, 5))
        for r in users.collect():
            P[r.user_idx] = r.factors
        for r in items.collect():
            Q[r.podcast_idx] = r.factors
        found.append(P @ Q.T)
    assert np.abs(found[0] - found[1]).max() < 1e-9


def test_holdout_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    rows = [(f"u{rng.integers(20)}", f"p{rng.integers(12)}", float(rng.integers(1, 6)), T0) for _ in range(300)]
    train = spark.createDataFrame(rows, INTER)
    ui, ii = _index(spark, {r[0] for r in rows}, "user_id", "user_idx"), _index(spark, {r[1] for r in rows}, "podcast_id", "podcast_idx")
    one = collab.holdout_cf(train.repartition(1), ui, ii, 4).first()
    many = collab.holdout_cf(train.repartition(7, "rating"), ui, ii, 4).first()
    assert one["n"] == many["n"] > 20 and one["rmse"] == pytest.approx(many["rmse"])


def test_ranked_scores_and_new_users(spark):
    cf, _ = _fit_small(spark)
    pairs = spark.createDataFrame([(u, p) for u in ("u1", "u4", "ghost") for p in ("a", "b", "c", "zzz")], "user_id string, podcast_id string")
    rows = {}
    for r in collab.ranked_cf(cf, pairs).collect():
        rows.setdefault(r.user_id, []).append(r)
    plain = {(r.user_id, r.podcast_id): r.collab_score for r in collab.score_cf(cf, pairs).collect()}
    for u, rs in rows.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == [1, 2, 3, 4] and {r.is_new_user for r in rs} == {u == "ghost"}
        assert [(-r.collab_score, r.podcast_id) for r in rs] == sorted((-plain[u, r.podcast_id], r.podcast_id) for r in rs)
