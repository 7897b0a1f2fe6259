import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.operators import retrieve


def _vectors(spark, n=60, d=8, seed=3):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    rows = [(f"i{i:03d}", [float(x) for x in m[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "item_id string, embedding array<double>"), m


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_exact_topk_matches_numpy(spark, limit):
    items, m = _vectors(spark)
    q = spark.createDataFrame([("q0", [float(x) for x in m[5]], ["i005"]), ("q1", [float(x) for x in m[7]], None)],
                              "query_id string, embedding array<double>, exclude array<string>")
    out = retrieve.exact_topk(q, items, 5, exclude_col="exclude", block_size=16,
                              broadcast_bytes=limit).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.item_id)
    s0 = m @ m[5]
    s0[5] = -np.inf
    assert got["q0"] == [f"i{i:03d}" for i in np.argsort(-s0)[:5]]
    assert got["q1"] == [f"i{i:03d}" for i in np.argsort(-(m @ m[7]))[:5]]
    assert all(-1 - 1e-9 <= r.score <= 1 + 1e-9 for r in out)


def test_similar_items_excludes_self(spark):
    items, m = _vectors(spark, n=30)
    out = retrieve.similar_items(items, 3).collect()
    assert len(out) == 90 and all(r.item_id != r.similar_id for r in out)
    with pytest.raises(ValueError):
        retrieve.similar_items(items, 0)


def test_embed_text_unit_norm(spark):
    df = spark.createDataFrame([("a", "hello world podcast"), ("b", "science and technology news"), ("c", "")],
                               "doc_id string, text string")
    out = retrieve.embed_text(df, "doc_id").collect()
    norms = {r.doc_id: float(np.linalg.norm(r.embedding)) for r in out}
    assert norms["a"] == pytest.approx(1.0, abs=1e-5) and norms["b"] == pytest.approx(1.0, abs=1e-5)


def test_item_text_null_as_empty(spark):
    df = spark.createDataFrame([("p", "T", None, "D")], "podcast_id string, title string, category string, description string")
    assert retrieve.item_text(df).first()["text"] == "T [SEP]  [SEP] D"


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_blocked_both_sides_matches_numpy(spark, limit):
    items, m = _vectors(spark, n=50, d=6, seed=11)
    q = items.withColumnRenamed("item_id", "query_id")
    out = retrieve.exact_topk(q, items, 4, exclude_self=True, block_size=8, broadcast_bytes=limit).collect()   # 0: 7 x 7 block pairs
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.item_id)
    s = m @ m.T
    np.fill_diagonal(s, -np.inf)
    for i in range(50):
        assert got[f"i{i:03d}"] == [f"i{j:03d}" for j in np.argsort(-s[i], kind="stable")[:4]]


def test_ties_go_to_the_smaller_id_in_both_plans(spark):
    items = spark.createDataFrame([(f"t{i:02d}", [1.0, 0.0]) for i in range(40)] + [("none", None)], "item_id string, embedding array<double>")
    q = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<double>")
    for limit in (0, 1 << 20):
        out = retrieve.exact_topk(q, items.repartition(7), 3, block_size=9, broadcast_bytes=limit).collect()
        assert sorted((r["rank"], r.item_id) for r in out) == [(1, "t00"), (2, "t01"), (3, "t02")]


def test_few_queries_leave_the_items_in_place(spark):
    items, m = _vectors(spark)
    q = items.limit(2).withColumnRenamed("item_id", "query_id")
    plan = retrieve.exact_topk(q, items, 3)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "CoGroup" not in plan
    assert plan.index("Exchange") < plan.index("MapInPandas")      # the only exchange is above the local lists
    assert plan.count("Exchange") == 1
