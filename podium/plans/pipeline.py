"""Pipeline fit (V5), the ``runs`` table (S14, S15) and model persistence."""
from __future__ import annotations

import json
import os
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import collab, prepare, rank, retrieve
from ..session import shuffles_dropped
from .serve import RecommenderModel

# Fixed defaults of the reference pipeline.
DEFAULT_PARAMS = {
    "n_factors": 128, "n_trees": 300, "learning_rate": 0.05, "top_k": 10,
    "candidate_pool_size": 100, "diversity_penalty": 0.1, "encoder_dim": 384,
}

RUNS_SCHEMA = ("run_id string, started timestamp, params map<string,string>, ndcg_at_10 double, "
               "cf_rmse double, cf_mae double, embedder_fit_time_s double, cf_fit_time_s double, "
               "ranker_fit_time_s double, n_podcasts bigint, n_users bigint, n_train_interactions bigint")


def fit_pipeline(ds: prepare.Dataset, params: dict | None = None):
    """Embed items, factorise, evaluate CF, fit the ranker, evaluate NDCG.
    Returns (model, metrics dict)."""
    p = dict(DEFAULT_PARAMS)
    p.update(params or {})
    t0 = time.time()
    enc = retrieve.HashingEncoder(dim=int(p["encoder_dim"]))
    texts = retrieve.item_text(ds.items)
    item_vectors = retrieve.embed_text(texts, "podcast_id", encoder=enc)
    t1 = time.time()
    # the ranker first: its frame is gone before the factors take their place on disk
    t3 = time.time()
    rm = rank.fit_ranker(ds.train, ds.items, int(p["n_trees"]), float(p["learning_rate"]))
    t4 = time.time()
    with shuffles_dropped(ds.train.sparkSession):
        test_scored = rank.predict(rm, ds.test.select("user_id", "podcast_id", "rating").join(
            ds.items.select(*rank.ITEM_FEATURES), "podcast_id", "left"))
        ndcg = rank.ndcg_at_k(test_scored, 10, score="ranker_score", rating="rating").first()["ndcg"]
        t_cf = time.time()
        cf = collab.fit_cf(ds.train, ds.user_index, ds.item_index, int(p["n_factors"]))
        t2 = time.time()
        cfm = collab.evaluate_cf(cf, ds.test).first()
    metrics = {
        "ndcg_at_10": float(ndcg), "cf_rmse": float(cfm["rmse"] or 0.0), "cf_mae": float(cfm["mae"] or 0.0),
        "embedder_fit_time_s": round(t1 - t0, 3), "cf_fit_time_s": round(t2 - t_cf, 3),
        "ranker_fit_time_s": round(t4 - t3, 3),
        "n_podcasts": ds.items.count(), "n_users": ds.user_index.count(), "n_train_interactions": ds.train.count(),
    }
    model = RecommenderModel(ds.items, item_vectors, enc, cf, rm, p)
    return model, metrics


def run_record(spark: SparkSession, params: dict, metrics: dict, run_id: str | None = None) -> DataFrame:
    """One row of the ``runs`` table."""
    row = (run_id or uuid.uuid4().hex, datetime.now(timezone.utc).replace(tzinfo=None),
           {k: str(v) for k, v in params.items()},
           metrics["ndcg_at_10"], metrics["cf_rmse"], metrics["cf_mae"], metrics["embedder_fit_time_s"],
           metrics["cf_fit_time_s"], metrics["ranker_fit_time_s"], int(metrics["n_podcasts"]),
           int(metrics["n_users"]), int(metrics["n_train_interactions"]))
    return spark.createDataFrame([row], RUNS_SCHEMA)


def append_run(record: DataFrame, runs_path: str) -> None:
    record.write.mode("append").parquet(runs_path)


def leaderboard(runs: DataFrame, n: int = 20) -> DataFrame:
    """Best runs by NDCG, run id cut to 8 characters, seven fields."""
    return (runs.orderBy(F.desc_nulls_last("ndcg_at_10"), F.col("run_id"))
                .limit(n)
                .select(F.substring("run_id", 1, 8).alias("run_id"), "started", "ndcg_at_10", "cf_rmse",
                        "cf_mae", "n_podcasts", "n_train_interactions"))


def save_model(model: RecommenderModel, path: str) -> None:
    """Tables as Parquet, the ranker and encoder as Spark ML models, the
    parameters (including the trained hyper-parameters) as JSON."""
    w = lambda df, name: df.write.mode("overwrite").parquet(os.path.join(path, name))
    w(model.items, "items")
    w(model.item_vectors, "item_vectors")
    cf = model.cf
    w(cf.user_factors, "cf/user_factors")
    w(cf.item_factors, "cf/item_factors")
    w(cf.user_means, "cf/user_means")
    w(cf.user_index, "cf/user_index")
    w(cf.item_index, "cf/item_index")
    w(cf.popularity, "cf/popularity")
    w(model.ranker.prefs, "ranker/prefs")
    model.ranker.model.write().overwrite().save(os.path.join(path, "ranker/model"))
    model.encoder.model.write().overwrite().save(os.path.join(path, "encoder"))
    meta = {"params": model.params, "ranker_params": model.ranker.params,
            "norms": model.ranker.norms.__dict__, "cf": {"n_factors": cf.n_factors, "s": cf.singular_values},
            "encoder_dim": model.encoder.dim}
    spark = model.items.sparkSession
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(
        os.path.join(path, "meta"))


def load_model(spark: SparkSession, path: str) -> RecommenderModel:
    from pyspark.ml import PipelineModel
    r = lambda name: spark.read.parquet(os.path.join(path, name))
    meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
    cf = collab.CFModel(r("cf/user_factors"), r("cf/item_factors"), r("cf/user_means"), r("cf/user_index"),
                        r("cf/item_index"), r("cf/popularity"), int(meta["cf"]["n_factors"]), meta["cf"]["s"])
    rm = rank.RankerModel(PipelineModel.load(os.path.join(path, "ranker/model")),
                          rank.Norms(**meta["norms"]), r("ranker/prefs"), meta["ranker_params"])
    enc = retrieve.HashingEncoder(dim=int(meta["encoder_dim"]))
    enc.model = PipelineModel.load(os.path.join(path, "encoder"))
    return RecommenderModel(r("items"), r("item_vectors"), enc, cf, rm, meta["params"])
