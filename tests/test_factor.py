import glob

import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.operators import collab, factor
from podium.session import checkpoint_dir


def _cells(spark, n_rows=90, n_cols=140, per_row=12, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, int(j), float(rng.normal())) for i in range(n_rows) for j in rng.choice(n_cols, per_row, replace=False)]
    rows += [(7, j, float(rng.normal())) for j in range(n_cols) if (7, j) not in {(a, b) for a, b, _ in rows}]      # one full row
    return spark.createDataFrame(rows, "user_idx int, podcast_idx int, v double"), rows


def _dense(df, key, n, k):
    out = np.zeros((n, k))
    for r in df.collect():
        out[r[key]] = r.factors
    return out


@pytest.mark.parametrize("group, share", [(128 << 20, 1 << 16), (128 << 20, 40), (2 * 16 * 15 * 8, 60)])
def test_products_need_no_shuffle_and_leave_two_tables(spark, monkeypatch, group, share):
    """One task per group and share, whatever the packing; only the final blocks stay."""
    monkeypatch.setattr(factor, "IDS", 16)
    monkeypatch.setattr(factor, "GROUP_BYTES", group)
    monkeypatch.setattr(factor, "SHARE_CELLS", share)
    cells, rows = _cells(spark)
    plans, made = [], []
    real = factor.written
    monkeypatch.setattr(factor, "written", lambda df, name, options=None: plans.append((name, df._jdf.queryExecution().executedPlan().toString(), df.rdd.getNumPartitions()))
                        or made.append(real(df, name, options)) or made[-1])
    f = factor.factorised(cells, "user_idx", "podcast_idx", 90, 140, 5, rounds=2)
    products = [x for x in plans if x[0] == "factor-product"]
    assert products and not any("Exchange" in plan for name, plan, _ in plans)
    assert {n for _, _, n in products} == ({1} if share > 1000 else {4} if group > 1 << 20 else {3 * 4, 5 * 4}) or share == 60
    where = checkpoint_dir(spark).removeprefix("file:")
    left = {p for df in made for p in df.inputFiles()} & {"file://" + p for p in glob.glob(where + "/**/part-*", recursive=True)}
    assert left == set(f.rows.inputFiles()) | set(f.cols.inputFiles()) and left
    P, Q = _dense(f.row_vectors("user_idx"), "user_idx", 90, 5), _dense(f.col_vectors("podcast_idx"), "podcast_idx", 140, 5)
    a = np.zeros((90, 140))
    for i, j, v in rows:
        a[i, j] = v
    assert np.abs(Q.T @ Q - np.eye(5)).max() < 1e-9
    assert np.allclose(a.T @ P, Q * np.array(f.values) ** 2, atol=1e-9)         # the matrix itself was multiplied


@pytest.mark.parametrize("group, share", [(128 << 20, 1 << 16), (2 * 16 * 15 * 8, 60)])
def test_pair_products_are_those_of_the_vectors(spark, monkeypatch, group, share):
    monkeypatch.setattr(factor, "IDS", 16)
    monkeypatch.setattr(factor, "GROUP_BYTES", group)
    monkeypatch.setattr(factor, "SHARE_CELLS", share)
    cells, _ = _cells(spark)
    f = factor.factorised(cells, "user_idx", "podcast_idx", 90, 140, 5, rounds=1)
    P, Q = _dense(f.row_vectors("user_idx"), "user_idx", 95, 5), _dense(f.col_vectors("podcast_idx"), "podcast_idx", 150, 5)
    rng = np.random.default_rng(5)
    pairs = sorted({(int(i), int(j)) for i, j in zip(rng.integers(0, 95, 900), rng.integers(0, 150, 900))})
    got = factor.pair_products(f, spark.createDataFrame(pairs, "user_idx int, podcast_idx int"), "user_idx", "podcast_idx").collect()
    assert sorted((r.user_idx, r.podcast_idx) for r in got) == [(i, j) for i, j in pairs if i < 90 and j < 140 and Q[j].any()]
    assert np.allclose([r["product"] for r in got], [P[r.user_idx] @ Q[r.podcast_idx] for r in got], atol=1e-10)


def test_scores_from_blocks_equal_scores_from_joined_vectors(spark, monkeypatch):
    import datetime as dt
    t0, rng = dt.datetime(2024, 1, 1), np.random.default_rng(9)
    rows = [(f"u{rng.integers(30)}", f"p{rng.integers(40)}", float(rng.integers(1, 6)), t0) for _ in range(400)]
    train = spark.createDataFrame(rows, "user_id string, podcast_id string, rating double, timestamp timestamp")
    ui = spark.createDataFrame([(f"u{i}", i) for i in range(32)], "user_id string, user_idx int")
    ii = spark.createDataFrame([(f"p{i}", i) for i in range(41)], "podcast_id string, podcast_idx int")
    cf = collab.fit_cf(train, ui, ii, 6)
    # repeated pairs, a user and an item without train rows, unknown ids, null ids
    pairs = spark.createDataFrame([(f"u{i}", f"p{j}", i * j) for i in (0, 1, 31, 99) for j in (0, 1, 40, 77)] * 2 + [(None, "p1", 5), ("u1", None, 6)],
                                  "user_id string, podcast_id string, extra int")
    found = []
    for most in (collab.BROADCAST_ITEM_BYTES, 0):
        monkeypatch.setattr(collab, "BROADCAST_ITEM_BYTES", most)
        out = collab.raw_cf_scores(cf, pairs)
        found.append(sorted([(str(r.user_id), str(r.podcast_id), r.extra, r.known_user, round(r.collab_score, 9)) for r in out.collect()]))
    assert "factors" not in out._jdf.queryExecution().executedPlan().toString()
    assert found[0] == found[1] and len(found[0]) == 34 and out.where(F.col("known_user")).count() == 25


def test_large_rows_lie_in_small_row_groups(spark):
    """A reader holds one row group at a time; 40 rows of 1 MB in one would be 40 MB for each task."""
    import pyarrow.parquet as pq

    def megabytes(batches):
        import os

        import pyarrow as pa
        for b in batches:
            for i in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([os.urandom(1 << 20)])], ["id", "m"])
    df = spark.range(40, numPartitions=1).mapInArrow(megabytes, "id long, m binary")
    found = [pq.ParquetFile("/" + f.removeprefix("file:").lstrip("/")).metadata for f in factor.written(df, "large", factor._PLAIN).inputFiles()]
    sizes = [m.row_group(i).total_byte_size for m in found for i in range(m.num_row_groups)]
    assert sum(sizes) > 40 << 20 and max(sizes) <= 24 << 20


@pytest.mark.parametrize("group, share", [(128 << 20, 1 << 16), (2 * 16 * 15 * 8, 60)])
def test_extremes_over_a_pool_less_own_exclusions(spark, monkeypatch, group, share):
    monkeypatch.setattr(factor, "IDS", 16)
    monkeypatch.setattr(factor, "GROUP_BYTES", group)
    monkeypatch.setattr(factor, "SHARE_CELLS", share)
    cells, _ = _cells(spark)
    f = factor.factorised(cells, "user_idx", "podcast_idx", 90, 140, 5, rounds=1)
    P, Q = _dense(f.row_vectors("user_idx"), "user_idx", 95, 5), _dense(f.col_vectors("podcast_idx"), "podcast_idx", 150, 5)
    rng = np.random.default_rng(6)
    asked = [*range(0, 88, 3), 92]                              # 92 has no vector
    pool = [int(j) for j in rng.choice(150, 70, replace=False)]  # from 140 on: no vector
    out = {(int(i), int(j)) for i, j in zip(rng.choice(asked, 400), rng.integers(0, 150, 400))} | {(3, j) for j in pool}
    out |= {(6, j) for j in pool if j != pool[0]} | {(4, pool[0])}      # one left; a user nobody asked for
    got = factor.extremes(f, spark.createDataFrame([(i,) for i in asked], "user_idx int"), spark.createDataFrame(sorted(out), "user_idx int, podcast_idx int"),
                          spark.createDataFrame([(j,) for j in pool], "podcast_idx int"), "user_idx", "podcast_idx").collect()
    assert sorted(r.user_idx for r in got) == asked
    for r in got:
        left = [P[r.user_idx] @ Q[j] for j in pool if (r.user_idx, j) not in out]
        assert (r.lo, r.hi) == (pytest.approx(min(left), abs=1e-10), pytest.approx(max(left), abs=1e-10)) if left else (r.lo, r.hi) == (np.inf, -np.inf)
    assert any(r.user_idx == 3 and r.lo == np.inf for r in got)
