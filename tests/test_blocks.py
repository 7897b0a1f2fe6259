"""The bound-pruned block index against plain numpy products."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.operators import blocks, retrieve


def frame(spark, m, name, vec, dtype="array<double>"):
    rows = [(f"{name}{i:04d}", None if v is None else [float(x) for x in v]) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, f"{name}_id string, {vec} {dtype}")


def clustered(n, d=12, groups=25, seed=1, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    m = centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, d))
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def expected(q, it, k, excluded=None):
    s = q @ it.T
    for i, ids in enumerate(excluded or []):
        s[i, ids] = -np.inf
    return [[(f"i{j:04d}") for j in np.lexsort((np.arange(len(it)), -s[i]))[:k] if np.isfinite(s[i, j])] for i in range(len(q))]


def ranked(rows):
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.item_id)
    return got


def prepared(spark, q, it):
    return (frame(spark, q, "q", "qvec").withColumnRenamed("q_id", "query_id").withColumn("exclude", F.lit(None).cast("array<string>")),
            frame(spark, it, "i", "ivec").withColumnRenamed("i_id", "item_id"))


def test_clustered_vectors_cost_under_half_of_the_products(spark):
    q, it = clustered(300, seed=2), clustered(1500, seed=2)
    qs, items = prepared(spark, q, it)
    index = blocks.build(items, 64)
    work = {}
    hits = blocks.search(index, qs, 5, work=work)
    hits = hits.withColumn("rank", F.row_number().over(blocks.best_first())).where("rank <= 5")
    got = ranked(hits.collect())
    assert [got[f"q{i:04d}"] for i in range(300)] == expected(q, it, 5)
    assert work["full"] == 300 * 1500 and work["products"] < work["full"] / 2
    wanted = blocks._pairs(index, blocks.sliced(index, qs).withColumn("floor", F.lit(0.9)), 5, False, True)
    slices = wanted.select("slice").distinct().count()
    assert wanted.groupBy("cell").count().agg(F.max("count")).first()[0] < slices      # no item meets all slices


@pytest.mark.parametrize("scale", [1.0, 30.0])
def test_spread_vectors_exclusions_and_one_spot(spark, scale):
    """Vectors without structure and of any length, a third of the items on one
    spot, exclusions longer than a cell, a query that excludes all but two."""
    rng = np.random.default_rng(4)
    it = rng.normal(size=(240, 5)) * rng.uniform(0.1, scale, size=(240, 1))
    it[:80] = it[0]
    q = np.vstack([rng.normal(size=(30, 5)), np.zeros((1, 5)), it[:2]])
    gone = [list(rng.choice(240, int(rng.integers(0, 60)), replace=False)) for _ in range(len(q))]
    gone[3] = list(range(238))
    qs, items = prepared(spark, q, it)
    ex = spark.createDataFrame([(f"q{i:04d}", [f"i{j:04d}" for j in g]) for i, g in enumerate(gone)], "query_id string, exclude array<string>")
    qs = qs.drop("exclude").join(ex, "query_id").withColumnRenamed("qvec", "embedding")
    items = items.withColumnRenamed("ivec", "embedding")
    got = ranked(retrieve.exact_topk(qs, items, 4, exclude_col="exclude", block_size=16, broadcast_bytes=0).collect())
    want = expected(q, it, 4, gone)
    assert {k: v for k, v in got.items()} == {f"q{i:04d}": w for i, w in enumerate(want)}


def test_empty_sides_and_null_vectors(spark):
    qs, items = prepared(spark, np.ones((3, 2)), np.ones((4, 2)))
    qs, items = qs.withColumnRenamed("qvec", "embedding"), items.withColumnRenamed("ivec", "embedding")
    run = lambda a, b: retrieve.exact_topk(a, b, 2, broadcast_bytes=0).count()
    assert run(qs.limit(0), items) == 0 and run(qs, items.limit(0)) == 0
    null = items.withColumn("embedding", F.when(F.col("item_id") > "i0000", F.col("embedding")))
    got = ranked(retrieve.exact_topk(qs, null, 2, broadcast_bytes=0).collect())
    assert got == {f"q000{i}": ["i0001", "i0002"] for i in range(3)}


def test_queries_meet_few_cells_and_slices_go_in_turn(spark, monkeypatch):
    """Vectors without structure: no more cells than blocks of items, so a query is
    sent at most once per block; small turns give the same neighbours."""
    rng = np.random.default_rng(6)
    it = rng.normal(size=(600, 8)).astype(np.float32)
    items = frame(spark, it, "i", "embedding", "array<float>").withColumnRenamed("i_id", "item_id")
    index = blocks.build(items.withColumnRenamed("embedding", "ivec"), 100)
    assert len(index.cell) <= 6 + 6 and dict(index.items.dtypes)["ivec"] == "array<float>"
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 100)
    turns = []
    written = blocks.written
    monkeypatch.setattr(blocks, "written", lambda df, name: turns.append(name) or written(df, name))
    want = [[f"i{j:04d}" for j in row] for row in np.argsort(-np.where(np.eye(600), -np.inf, it.astype(float) @ it.T.astype(float)), axis=1, kind="stable")[:, :3]]
    for size in (blocks.ROUND_BYTES, 100_000):
        monkeypatch.setattr(blocks, "ROUND_BYTES", size)
        hits = retrieve.exact_topk(items.withColumnRenamed("item_id", "query_id"), items, 3, exclude_self=True, broadcast_bytes=0)
        got = ranked(hits.collect())
        assert [got[f"i{i:04d}"] for i in range(600)] == want
    assert len(turns) > 1
