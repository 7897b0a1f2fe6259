import dataclasses

import pytest
from pyspark.sql import functions as F

from podium.operators import blocks, collab, prepare, rank
from podium.plans import catalog, pipeline, serve

SF = "/root/testdata/sf0.001"
PARAMS = {"n_factors": 16, "n_trees": 5, "top_k": 5, "candidate_pool_size": 20, "diversity_penalty": 0.1,
          "encoder_dim": 64}


@pytest.fixture(scope="module")
def fitted(spark):
    p = catalog.Prepared(spark, SF)
    ds = prepare.Dataset(p.items, p.active, p.train, p.test, p.user_index, p.item_index)
    model, metrics = pipeline.fit_pipeline(ds, PARAMS)
    return model, metrics, ds


def _brute_force(model, users, k, lam, excluded=None):
    """Every user against every item, scored and ranked row by row."""
    cand = users.crossJoin(model.items).withColumn("embedding_score", F.lit(0.0))
    if excluded is not None:
        cand = cand.join(excluded, ["user_id", "podcast_id"], "left_anti")
    cf = collab.score_cf(model.cf, cand.select("user_id", "podcast_id"))
    cand = cand.join(cf, ["user_id", "podcast_id"], "left").withColumn(
        "collab_score", F.coalesce("collab_score", F.lit(0.0)))
    return rank.rank_candidates(model.ranker, cand, k, lam, pos=("podcast_id",))


def _same(fast, slow):
    key = lambda r: (r.user_id, r.rank)
    fast, slow = sorted(fast.collect(), key=key), sorted(slow.collect(), key=key)
    assert fast and [(r.user_id, r.rank, r.podcast_id) for r in fast] == [(r.user_id, r.rank, r.podcast_id) for r in slow]
    for a, b in zip(fast, slow):
        assert a.ranker_score == pytest.approx(b.ranker_score, abs=1e-9)
        assert a.collab_score == pytest.approx(b.collab_score, abs=1e-9)


def test_metrics(fitted):
    _, m, _ = fitted
    assert m["ndcg_at_10"] > 0 and m["cf_rmse"] > 0 and m["cf_mae"] > 0
    assert m["n_podcasts"] == 200


def test_all_items_path_equals_brute_force(spark, fitted):
    model, _, ds = fitted
    users = ds.user_index.select("user_id").orderBy("user_id").limit(40)
    _same(serve.recommend_batch(model, users), _brute_force(model, users, 5, 0.1))


def test_exclusions_without_query_equal_brute_force(spark, fitted):
    model, _, ds = fitted
    users = ds.user_index.select("user_id").orderBy("user_id").limit(20).unionByName(spark.createDataFrame([("nobody",)], "user_id string"))
    seen = ds.train.join(users, "user_id", "left_semi").select("user_id", "podcast_id").distinct()
    best = spark.createDataFrame([("nobody", r.podcast_id) for r in _brute_force(model, users.where("user_id = 'nobody'"), 3, 0.1).collect()],
                                 "user_id string, podcast_id string")
    excluded = seen.unionByName(best)
    lists = excluded.groupBy("user_id").agg(F.collect_list("podcast_id").alias("exclude"))
    req = users.join(lists, "user_id", "left").withColumn("exclude", F.concat(F.col("exclude"), F.array(F.lit("no such item"))))
    _same(serve.recommend_batch(model, req), _brute_force(model, users, 5, 0.1, excluded))


@pytest.mark.parametrize("lam", [0.1, 0.9, 0.0])
def test_many_and_null_categories(spark, fitted, monkeypatch, lam):
    """A category per few items and null ones, unindexed items, hot-key joins by shuffle."""
    model, _, ds = fitted
    h = F.pmod(F.xxhash64("podcast_id"), F.lit(60))
    extra = model.items.orderBy("podcast_id").limit(3).withColumn("podcast_id", F.concat(F.lit("new-"), F.col("podcast_id")))
    items = model.items.unionByName(extra).withColumn("category", F.when(h > 2, F.concat(F.lit("c"), h.cast("string"))))
    users = ds.user_index.select("user_id").orderBy("user_id").limit(8)
    prefs = rank.category_prefs(ds.train, items)
    own = dataclasses.replace(model, items=items, ranker=dataclasses.replace(model.ranker, prefs=prefs, _map=None),
                              params={**model.params, "diversity_penalty": lam})
    excluded = ds.train.join(users, "user_id", "left_semi").select("user_id", "podcast_id").distinct().where(
        F.pmod(F.xxhash64("podcast_id"), F.lit(2)) == 0)
    req = users.join(excluded.groupBy("user_id").agg(F.collect_list("podcast_id").alias("exclude")), "user_id", "left")
    monkeypatch.setattr(serve, "BROADCAST_ROWS", 0)
    _same(serve.recommend_batch(own, req), _brute_force(own, users, 5, lam, excluded))


@pytest.mark.parametrize("sent", [True, False])
def test_cf_extremes_equal_brute_force(spark, fitted, monkeypatch, sent):
    """Items sent to every task or searched through the block index; users of
    any taste, one who excludes all indexed items, one unknown."""
    model, _, ds = fitted
    monkeypatch.setattr(collab, "BROADCAST_ITEM_BYTES", 1 << 26 if sent else 0)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 16)
    users = ds.user_index.select("user_id").orderBy("user_id").limit(30)
    all_out = users.orderBy("user_id").limit(1)
    pool = model.items.select("podcast_id").unionByName(spark.createDataFrame([("not indexed",)], "podcast_id string"))
    excluded = ds.train.join(users, "user_id", "left_semi").select("user_id", "podcast_id").unionByName(
        all_out.crossJoin(model.items.select("podcast_id"))).distinct()
    users = users.unionByName(spark.createDataFrame([("nobody",)], "user_id string"))
    got = {r.user_id: (r.clo, r.chi) for r in serve._cf_minmax(model.cf, users, excluded, pool).collect()}
    pairs = users.crossJoin(pool).join(excluded, ["user_id", "podcast_id"], "left_anti")
    want = {r.user_id: (r.lo, r.hi) for r in collab.raw_cf_scores(model.cf, pairs).where("known_user").groupBy("user_id").agg(
        F.min("collab_score").alias("lo"), F.max("collab_score").alias("hi")).collect()}
    assert set(got) == set(want) and "nobody" not in got
    for u in want:
        assert got[u] == pytest.approx(want[u], abs=1e-9)


def test_ranker_that_splits_on_the_cf_score(spark, fitted):
    """Such a ranker is served as well, by scoring every pair."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import GBTRegressor
    model, _, ds = fitted
    rows = collab.score_cf(model.cf, ds.train.select("user_id", "podcast_id", "rating"))
    feats = rank.derive_features(rows.join(model.items.select(*rank.ITEM_FEATURES), "podcast_id"), model.ranker.norms, model.ranker.prefs)
    assembler = model.ranker.model.stages[0]
    gbt = GBTRegressor(featuresCol="features", labelCol="collab_score", predictionCol="ranker_score", maxIter=3, maxDepth=3, seed=1)
    stages = [assembler, gbt.fit(assembler.transform(feats))]
    own = dataclasses.replace(model, ranker=dataclasses.replace(model.ranker, model=PipelineModel(stages=stages)))
    assert serve._uses_feature(own.ranker, serve.COLLAB_INDEX)
    users = ds.user_index.select("user_id").orderBy("user_id").limit(6)
    excluded = ds.train.join(users, "user_id", "left_semi").select("user_id", "podcast_id").distinct()
    req = users.join(excluded.groupBy("user_id").agg(F.collect_list("podcast_id").alias("exclude")), "user_id", "left")
    _same(serve.recommend_batch(own, req), _brute_force(own, users, 5, 0.1, excluded))


def test_last_request_and_own_k(spark, fitted):
    model, _, ds = fitted
    u = ds.user_index.orderBy("user_id").first()["user_id"]
    req = spark.createDataFrame([(u, 5, 1), (u, 2, 2), ("nobody", 3, 1), ("", 3, 1), ("far", 51, 1), (None, 3, 1)],
                                "user_id string, k int, request_order long")
    out = serve.recommend_batch(model, req).groupBy("user_id").count().collect()
    assert {r.user_id: r["count"] for r in out} == {u: 2, "nobody": 3}
    none = serve.recommend_batch(model, req.limit(0))
    assert none.count() == 0


def test_cold_user_and_batch_dedup(spark, fitted):
    model, _, ds = fitted
    req = spark.createDataFrame([("nobody",), ("nobody",)], "user_id string")
    out = serve.recommend_batch(model, req).collect()
    assert len(out) == 5 and {r.user_id for r in out} == {"nobody"}
    # cold user: CF falls back to popularity, unscaled, within [0, 1]
    assert all(0.0 <= r.collab_score <= 1.0 for r in out)


def test_query_path_and_history(spark, fitted):
    model, _, ds = fitted
    u = ds.user_index.orderBy("user_id").first()["user_id"]
    seen = [r.podcast_id for r in ds.train.where(F.col("user_id") == u).select("podcast_id").distinct().collect()]
    out = serve.recommend(model, u, query="small ring", history=seen[:3], k=5).collect()
    assert 0 < len(out) <= 5 and not set(seen[:3]) & {r.podcast_id for r in out}
    nq = serve.recommend(model, u, history=seen, k=5).collect()
    assert len(nq) == 5 and not set(seen) & {r.podcast_id for r in nq}


def test_save_load_same_output(spark, fitted, tmp_dir):
    model, _, ds = fitted
    pipeline.save_model(model, tmp_dir + "/model")
    loaded = pipeline.load_model(spark, tmp_dir + "/model")
    assert loaded.params["n_trees"] == 5        # trained hyper-parameters survive
    users = ds.user_index.select("user_id").orderBy("user_id").limit(10)
    a = sorted((r.user_id, r.rank, r.podcast_id) for r in serve.recommend_batch(model, users).collect())
    b = sorted((r.user_id, r.rank, r.podcast_id) for r in serve.recommend_batch(loaded, users).collect())
    assert a == b


def test_request_validation(spark):
    req = spark.createDataFrame([("u", 5), ("", 5), ("v", 0), ("w", 51)], "user_id string, k int")
    ok, bad = serve.validate_requests(req)
    assert [r.user_id for r in ok.collect()] == ["u"] and bad.count() == 3
