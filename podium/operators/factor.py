"""Truncated SVD of a sparse matrix given as cells, both sides distributed.

Randomised subspace iteration: a random block of directions is multiplied by
the matrix and its transpose in turn, made orthonormal in between, and the
small projected matrix is decomposed. A side's vectors are a table of *factor
blocks*: rows of up to ``IDS`` consecutive ids with a dense matrix. The cells are
packed once, per side, by a *group* of blocks of the side whose product is
wanted (as many as fit ``GROUP_BYTES`` when dense) and a block of the other. A
task holds the sums and the cells of one group, or of a share of its ids, and
the blocks of the other side pass by, read from their table: products and
partial sums are never shuffled, so a product takes no disk beside its result.
A product goes when the next one is made. Only matrices of
(directions x directions) reach the driver, whatever the number of rows or columns.

The final blocks stay as they are; rows of vectors are made of them when asked
for, and products of given pairs of ids go by the same scheme (``pair_products``).
"""
from __future__ import annotations

import functools
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import LARGE_ROWS, conf_set, scratch_path, ship_package, shuffles_dropped, written

IDS = 2048
#: Cells of one packed row (16 bytes each), and of one numpy pass over it.
CELLS, PASS_CELLS = 1 << 17, 512
#: Bytes of the dense sums of one group, held by one task at a time, and most cells that it holds beside them.
GROUP_BYTES, HELD_CELLS = 128 << 20, 8 << 20
#: A group with more cells is dealt to several tasks if there are cores for them.
SHARE_CELLS = 1 << 16
#: Directions beside those asked for, most rounds of multiplying by matrix and
#: transpose, and the mean relative gain of a direction's energy below which they end.
EXTRA, ROUNDS, GAIN = 10, 5, 2e-3
#: A Gram matrix's eigenvalues below this share of the greatest count as zero.
_TINY = 1e-13
_FACTORS = "block int, ids binary, m binary"
_PLAIN = {**LARGE_ROWS, "compression": "none"}


def drop(df: DataFrame | None) -> None:
    """Deletes the files of a written table that nothing reads any more."""
    if df is None:
        return
    spark = df.sparkSession
    for f in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def _group_blocks(width: int) -> int:
    """Blocks of ids whose dense factors fit ``GROUP_BYTES``."""
    return max(1, GROUP_BYTES // (IDS * width * 8))


def _packed(cells: DataFrame, by: str, over: str, width: int) -> DataFrame:
    """``g, shares, share, block, by, over, v`` (binary): the cells of each group of
    ``over`` blocks, share of its ids and block of ``by`` ids, dealt by hash to as
    many rows as they need. Folders ``p`` hold one group's share each."""
    spark = cells.sparkSession
    size = cells.agg(F.count(F.lit(1)).alias("n"), F.max(over).alias("last")).first()
    n, per = size["n"], IDS * _group_blocks(width)
    groups = max(1, -(-((size["last"] or 0) + 1) // per))
    shares = max(min(-(-spark.sparkContext.defaultParallelism // groups), -(-n // (groups * SHARE_CELLS))), -(-n // (groups * HELD_CELLS)), 1)
    group = F.floor(F.col(over) / per).cast("int")
    placed = cells.select(group.alias("g"), F.pmod(F.col(over), F.lit(shares)).cast("int").alias("share"), F.floor(F.col(by) / IDS).cast("int").alias("block"),
                          F.col(by).alias("by"), F.col(over).alias("over"), "v")
    key = ["g", "share", "block"]
    sizes = placed.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / CELLS).cast("int").alias("parts")).where("parts > 1")
    dealt = placed.join(sizes, key, "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("by", "over"), "parts"), F.lit(0))).drop("parts")

    def pack(key, rows):
        rows = rows.sort_values(["over", "by"], kind="stable")
        return pd.DataFrame({"g": [key[0]], "shares": [shares], "share": [key[1]], "block": [key[2]], "by": [rows["by"].to_numpy(np.int32).tobytes()],
                             "over": [rows["over"].to_numpy(np.int32).tobytes()], "v": [rows["v"].to_numpy(np.float64).tobytes()],
                             "p": [key[0] * shares + key[1]]})
    out = dealt.groupBy(*key, "part").applyInPandas(pack, "g int, shares int, share int, block int, by binary, over binary, v binary, p int")
    path = scratch_path(spark, f"factor-cells-{uuid.uuid4().hex}")
    out.write.partitionBy("p").options(**LARGE_ROWS, compression="zstd").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def _streamed(parts: DataFrame, stream: DataFrame | None, task, schema: str, name: str, beside=None) -> DataFrame:
    """The written result of one task per folder ``p`` of ``parts``: ``task(rows, passing)`` gets the
    rows of the folder, then those of ``stream`` one after the other, as tuples of
    buffers, and yields record batches. Tasks read both tables from the shared
    folder; nothing is shuffled. ``stream`` has the columns of ``parts`` but ``p``.
    ``beside(p)`` gives more rows of the folder's own and their number."""
    spark = parts.sparkSession
    counts = {r["p"]: r["n"] for r in parts.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}      # one row a task
    columns = [c for c in parts.columns if c != "p"]
    more = {p: beside(p) for p in counts} if beside else {}
    counts = {p: n + (more[p][1] if more else 0) for p, n in counts.items()}

    def run(batches):
        def rows():
            for b in batches:
                kinds, ps, data = b.column(0).to_pylist(), b.column(1).to_pylist(), [b.column(i) for i in range(2, b.num_columns)]
                for r in range(b.num_rows):
                    yield kinds[r], ps[r], tuple(c[r].as_buffer() if pa.types.is_binary(c.type) else c[r].as_py() for c in data)
        at, own, early = rows(), [], []
        for kind, p, row in at:         # the folder's rows come first, unless the scheduler deals them otherwise
            (early if kind else own).append(row)
            if not kind and len(own) == counts[p]:
                break
        passing = (row for source in (early, (r for _, _, r in at)) for row in source)
        yield from task(own, passing)
    made = []
    for p in sorted(counts):
        one = parts.where(F.col("p") == p).select(F.lit(0).alias("_kind"), F.lit(p).alias("_p"), *columns)
        if more:
            one = one.union(more[p][0].select(F.lit(0).alias("_kind"), F.lit(p).alias("_p"), *columns))
        if stream is not None:
            one = one.union(stream.select(F.lit(1).alias("_kind"), F.lit(p).alias("_p"), *columns))
        made.append(one.coalesce(1).mapInArrow(run, schema))
    # a union of single partitions would else become one task
    with conf_set(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20), "spark.sql.unionOutputPartitioning": "false"}):
        return written(functools.reduce(DataFrame.union, made) if made else spark.createDataFrame([], schema), name, _PLAIN)


def _matrix(ids: bytes, m: bytes):
    ids = np.frombuffer(ids, np.int32)
    return ids, np.frombuffer(m, np.float64).reshape(len(ids), -1)


def _passing(factors: DataFrame) -> DataFrame:
    """Factor blocks under the column names of packed cells."""
    none = F.lit(None)
    return factors.select(none.cast("int").alias("g"), none.cast("int").alias("shares"), none.cast("int").alias("share"), "block",
                          F.col("ids").alias("by"), none.cast("binary").alias("over"), F.col("m").alias("v"))


def _by_block(rows: list, size: int):
    """Cells (by, over, v) of each streamed block of ``size`` ids, ``by`` as the place in
    the block; those that are the first of their ``over`` id, then the rest; how many are first."""
    lists: dict = {}
    for _, _, _, block, by, over, v in rows:
        lists.setdefault(block, []).append((np.frombuffer(by, np.int32), np.frombuffer(over, np.int32), np.frombuffer(v, np.float64)))
    out = {}
    for block, found in lists.items():
        by, over, v = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(over, kind="stable")
        first = np.concatenate([[True], over[order][1:] != over[order][:-1]])
        order = np.concatenate([order[first], order[~first]])
        out[block] = (by[order] - block * size, over[order], v[order], int(first.sum()))
        found.clear()
    return out


def _add(sums: np.ndarray, x: np.ndarray, by, over, v, alone: int) -> None:
    """Adds ``x[by] * v`` to ``sums[over]``; the first ``alone`` have different ids, the rest are sorted by id."""
    for i in range(0, alone, PASS_CELLS):
        j = min(alone, i + PASS_CELLS)
        m = x[by[i:j]]
        m *= v[i:j, None]
        sums[over[i:j]] += m
    for i in range(alone, len(by), PASS_CELLS):
        at = over[i:i + PASS_CELLS]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        m = x[by[i:i + PASS_CELLS]]
        m *= v[i:i + PASS_CELLS, None]
        sums[at[first]] += np.add.reduceat(m, first, axis=0)


def _product(cells: DataFrame, factors: DataFrame | None, turn: np.ndarray | None, width: int, seed: int, name: str = "factor-product") -> DataFrame:
    """Factor blocks of (matrix x factors x turn) for the side that ``cells`` are
    grouped by; without factors, those of (matrix x random), where a block's
    random numbers depend on its number alone."""
    spark = cells.sparkSession
    per = IDS * _group_blocks(width)
    shared = spark.sparkContext.broadcast(turn)             # directions x directions
    columns = width if factors is None else (turn.shape[0] if turn is not None else width)
    ids_at, random = IDS, factors is None

    def task(own, passing):
        g, shares, share = own[0][:3]
        base = g * per
        held = _by_block(own, ids_at)
        own.clear()
        # the ids of a share: base + share', in steps of ``shares``
        start = base + (share - base) % shares
        last = max(int(x[1].max()) for x in held.values())
        sums = np.zeros(((last - start) // shares + 1, columns))
        seen = np.zeros(len(sums), bool)
        for block, (by, over, v, alone) in held.items():
            over = (over - start) // shares
            seen[over] = True
            held[block] = (by, over, v, alone)
        if random:
            for block, (by, over, v, alone) in held.items():
                _add(sums, np.random.default_rng((seed, block)).standard_normal((ids_at, width)), by, over, v, alone)
        else:
            for row in passing:
                ids, m = _matrix(row[4], row[6])
                block = int(ids[0]) // ids_at
                if block not in held:
                    continue
                by, over, v, alone = held[block]
                if len(ids) == ids_at:
                    _add(sums, m, by, over, v, alone)
                    continue
                place = np.full(ids_at, -1, np.int32)
                place[ids - block * ids_at] = np.arange(len(ids), dtype=np.int32)
                at = place[by]
                ok = at >= 0
                _add(sums, m, at[ok], over[ok], v[ok], int(ok[:alone].sum()))
        ids = np.flatnonzero(seen) * shares + start
        blocks = ids // ids_at
        for block in np.unique(blocks).tolist():
            mine = ids[blocks == block]
            m = sums[(mine - start) // shares]
            m = m if shared.value is None else m @ shared.value
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([mine.astype(np.int32).tobytes()], pa.binary()),
                                              pa.array([np.ascontiguousarray(m).tobytes()], pa.binary())], ["block", "ids", "m"])
    return _streamed(cells, None if factors is None else _passing(factors), task, _FACTORS, name)


def _gram(factors: DataFrame) -> np.ndarray:
    """The (directions x directions) Gram matrix of a side; tasks send one each, added up by Spark."""
    def run(batches):
        g = None
        for b in batches:
            for r in b.itertuples(index=False):
                _, m = _matrix(r.ids, r.m)
                g = m.T @ m if g is None else g + m.T @ m
        if g is not None:
            i, j = np.indices(g.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "x": g.ravel()})
    rows = factors.mapInPandas(run, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    n = int(rows["i"].max()) + 1 if len(rows) else 0
    g = np.zeros((n, n))
    g[rows["i"], rows["j"]] = rows["x"]
    return (g + g.T) / 2


def _whitening(g: np.ndarray) -> np.ndarray:
    """T such that the columns of (factors x T) are orthonormal."""
    e, w = np.linalg.eigh(g)
    keep = e > _TINY * max(e[-1], 0.0)
    return w[:, keep] / np.sqrt(e[keep])


def _turned(factors: DataFrame, turn: np.ndarray, name: str) -> DataFrame:
    """Factor blocks times ``turn``, written."""
    shared = factors.sparkSession.sparkContext.broadcast(turn)

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                ids, m = _matrix(b.column(1)[r].as_buffer(), b.column(2)[r].as_buffer())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(r, 1), b.column(1).slice(r, 1), pa.array([(m @ shared.value).tobytes()], pa.binary())],
                                                 ["block", "ids", "m"])
    return written(factors.select("block", "ids", "m").mapInArrow(run, _FACTORS), name, _PLAIN)


def _as_rows(factors: DataFrame, turn: np.ndarray, name: str) -> DataFrame:
    """``name, factors``: one row per id, its vector times ``turn``."""
    shared = factors.sparkSession.sparkContext.broadcast(turn)

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                ids, m = _matrix(b.column(0)[r].as_buffer(), b.column(1)[r].as_buffer())
                m = m @ shared.value
                for i in range(0, len(ids), 256):
                    part = m[i:i + 256]
                    offsets = np.arange(len(part) + 1, dtype=np.int32) * m.shape[1]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i:i + 256]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(part.ravel()))],
                                                     [name, "factors"])
    return factors.select("ids", "m").mapInArrow(run, f"{name} int, factors array<double>")


@dataclass
class Factors:
    """Both sides' factor blocks, what they are to be multiplied by, and the singular values."""

    rows: DataFrame
    cols: DataFrame
    row_turn: np.ndarray
    col_turn: np.ndarray
    values: list

    def row_vectors(self, name: str) -> DataFrame:
        return _as_rows(self.rows, self.row_turn, name)

    def col_vectors(self, name: str) -> DataFrame:
        return _as_rows(self.cols, self.col_turn, name)


def pair_products(f: Factors, pairs: DataFrame, row: str, col: str, name: str = "product") -> DataFrame:
    """``row, col, name``: the product of the two ids' vectors, for given pairs of ids
    (present, not repeated). A task holds the vectors of one group of rows and its
    pairs while the column blocks pass by. Pairs with an id that has no vector are left out."""
    spark = pairs.sparkSession
    ship_package(spark)
    turn = f.row_turn @ f.col_turn.T
    width = turn.shape[1]
    per_blocks = _group_blocks(width)
    per, ids_at = IDS * per_blocks, IDS
    shared = spark.sparkContext.broadcast(turn)

    def task(own, passing):
        vectors, wanted = [r for r in own if r[5] is None], [r for r in own if r[5] is not None]
        own.clear()
        g, shares, share = wanted[0][:3]
        start = g * per + (share - g * per) % shares
        held = _by_block(wanted, ids_at)
        last = max(int(x[1].max()) for x in held.values())
        x, seen = np.zeros(((last - start) // shares + 1, width)), np.zeros((last - start) // shares + 1, bool)
        for r in vectors:
            ids, m = _matrix(r[4], r[6])
            mine = (ids % shares == share) & (ids <= last)
            at = (ids[mine] - start) // shares
            x[at], seen[at] = m[mine] @ shared.value, True
        vectors.clear()
        for r in passing:
            ids, m = _matrix(r[4], r[6])
            block = int(ids[0]) // ids_at
            if block not in held:
                continue
            by, over = held[block][:2]
            place = np.full(ids_at, -1, np.int32)
            place[ids - block * ids_at] = np.arange(len(ids), dtype=np.int32)
            ok = (place[by] >= 0) & seen[(over - start) // shares]
            by, over = by[ok], over[ok]
            for i in range(0, len(by), PASS_CELLS * 128):
                b, o = by[i:i + PASS_CELLS * 128], over[i:i + PASS_CELLS * 128]
                dots = np.concatenate([np.einsum("ij,ij->i", x[(o[j:j + PASS_CELLS] - start) // shares], m[place[b[j:j + PASS_CELLS]]])
                                       for j in range(0, len(b), PASS_CELLS)])
                yield pa.RecordBatch.from_arrays([pa.array(o), pa.array(b + np.int32(block * ids_at)), pa.array(dots)], [row, col, name])
    with shuffles_dropped(spark):
        parts = _packed(pairs.select(row, col, F.lit(0.0).alias("v")), col, row, width)
        shares = (parts.agg(F.max("shares")).first()[0]) or 1
        rows_of = {r["g"]: r["n"] for r in f.rows.groupBy(F.floor(F.col("block") / per_blocks).cast("int").alias("g")).agg(F.count(F.lit(1)).alias("n")).collect()}

        def beside(p):
            g = p // shares
            return _passing(f.rows.where((F.col("block") >= g * per_blocks) & (F.col("block") < (g + 1) * per_blocks))), rows_of.get(g, 0)
        out = _streamed(parts, _passing(f.cols), task, f"{row} int, {col} int, {name} double", "factor-pairs", beside)
    drop(parts)
    return out


def extremes(f: Factors, asked: DataFrame, left_out: DataFrame, pool: DataFrame, row: str, col: str) -> DataFrame:
    """``row, lo, hi``: least and greatest product of each asked row id with the column
    ids of ``pool``, less those in ``left_out`` (row, col); an id without a vector counts 0,
    and with nothing left lo is infinite. All pairs are multiplied, block by block: a task
    holds the vectors of one group of rows while the column blocks pass by."""
    spark = asked.sparkSession
    ship_package(spark)
    turn = f.row_turn @ f.col_turn.T
    width = turn.shape[1]
    per_blocks = _group_blocks(width)
    per, ids_at = IDS * per_blocks, IDS
    shared = spark.sparkContext.broadcast(turn)

    def mark(key, rows):
        return pd.DataFrame({"block": [key[0]], "ids": [np.sort(rows["id"].to_numpy(np.int32)).tobytes()], "m": [None]})

    def task(own, passing):
        beside, wanted = [r for r in own if r[5] is None], [r for r in own if r[5] is not None]
        own.clear()
        g, shares, share = wanted[0][:3]
        start = g * per + (share - g * per) % shares
        held = _by_block(wanted, ids_at)
        users = np.unique(np.concatenate([x[1] for x in held.values()]))
        x = np.zeros((len(users), width))
        for r in (r for r in beside if r[6] is not None):
            ids, m = _matrix(r[4], r[6])
            mine = np.isin(ids, users)
            x[np.searchsorted(users, ids[mine])] = m[mine] @ shared.value
        bare = {}                       # ids of the pool whose vector has not passed by
        for r in (r for r in beside if r[6] is None):
            bare.setdefault(r[3], np.zeros(ids_at, bool))[np.frombuffer(r[4], np.int32) - r[3] * ids_at] = True
        lo, hi = np.full(len(users), np.inf), np.full(len(users), -np.inf)
        for r in passing:
            ids, m = _matrix(r[4], r[6])
            block = int(ids[0]) // ids_at
            at = ids - block * ids_at
            keep = bare[block][at] if block in bare else np.zeros(len(ids), bool)
            if not keep.any():
                continue
            at, m = at[keep], m[keep]
            bare[block][at] = False
            place = np.full(ids_at, -1, np.int32)
            place[at] = np.arange(len(at), dtype=np.int32)
            by, over = held[block][:2] if block in held else (np.zeros(0, np.int32), np.zeros(0, np.int32))
            gone = place[by] >= 0
            who, which = np.searchsorted(users, over[gone]), place[by[gone]]
            for i in range(0, len(users), ids_at):
                s = x[i:i + ids_at] @ m.T
                mine = (who >= i) & (who < i + ids_at)
                a, b = who[mine] - i, which[mine]
                s[a, b] = -np.inf
                hi[i:i + ids_at] = np.maximum(hi[i:i + ids_at], s.max(axis=1))
                s[a, b] = np.inf
                lo[i:i + ids_at] = np.minimum(lo[i:i + ids_at], s.min(axis=1))
        zeros = np.full(len(users), sum(int(b.sum()) for b in bare.values()))
        for block, b in bare.items():
            if block in held and b.any():
                by, over = held[block][:2]
                zeros -= np.bincount(np.searchsorted(users, over[b[by]]), minlength=len(users))
        lo, hi = np.where(zeros > 0, np.minimum(lo, 0.0), lo), np.where(zeros > 0, np.maximum(hi, 0.0), hi)
        yield pa.RecordBatch.from_arrays([pa.array(users.astype(np.int32)), pa.array(lo), pa.array(hi)], [row, "lo", "hi"])
    with shuffles_dropped(spark):
        block = F.floor(F.col(col) / IDS).cast("int")
        marks = written(pool.select(block.alias("block"), F.col(col).alias("id")).distinct().groupBy("block").applyInPandas(mark, _FACTORS), "factor-pool")
        # every asked row is there: the pair with block -1 meets no column
        pairs = left_out.select(row, col).join(asked.select(row), row, "left_semi").unionByName(asked.select(row, F.lit(-1).alias(col))).distinct()
        parts = _packed(pairs.withColumn("v", F.lit(0.0)), col, row, width)
        n_marks = marks.count()
        rows_of = {r["g"]: r["n"] for r in f.rows.groupBy(F.floor(F.col("block") / per_blocks).cast("int").alias("g")).agg(F.count(F.lit(1)).alias("n")).collect()}
        shares = (parts.agg(F.max("shares")).first()[0]) or 1

        def beside(p):
            g = p // shares
            own = f.rows.where((F.col("block") >= g * per_blocks) & (F.col("block") < (g + 1) * per_blocks))
            return _passing(own).union(_passing(marks)), rows_of.get(g, 0) + n_marks
        out = _streamed(parts, _passing(f.cols), task, f"{row} int, lo double, hi double", "factor-ends", beside)
    drop(parts)
    drop(marks)
    return out


def truncated_svd(cells: DataFrame, row: str, col: str, n_rows: int, n_cols: int, k: int, seed: int = 42, rounds: int = ROUNDS):
    """(row factors ``U S``, column factors ``V``, singular values) of the
    sparse matrix ``row, col, v`` (no repeated cells): the ``k`` greatest, less
    those that vanish. Where all directions fit the smaller side the result is
    exact; else at most ``rounds`` rounds approach the leading ones. Ids without cells
    get no factors."""
    f = factorised(cells, row, col, n_rows, n_cols, k, seed, rounds)
    return f.row_vectors(row), f.col_vectors(col), f.values


def factorised(cells: DataFrame, row: str, col: str, n_rows: int, n_cols: int, k: int, seed: int = 42, rounds: int = ROUNDS, spent: bool = False) -> Factors:
    """``truncated_svd`` as factor blocks. ``spent``: nothing else reads the
    cells, a written table, and its files go when they are packed."""
    ship_package(cells.sparkSession)
    with shuffles_dropped(cells.sparkSession):
        return _iterated(cells, row, col, n_rows, n_cols, k, seed, rounds, spent)


def _gain(e: np.ndarray, before: np.ndarray | None) -> float:
    """Mean relative gain of each direction's energy; one great direction does not outweigh the rest."""
    if before is None or len(before) != len(e):
        return np.inf
    return float(np.mean((e - before) / np.maximum(e, _TINY * e[-1])))


def _iterated(cells: DataFrame, row: str, col: str, n_rows: int, n_cols: int, k: int, seed: int, rounds: int, spent: bool) -> Factors:
    width = min(k + EXTRA, n_rows, n_cols)
    by_row, by_col = _packed(cells, col, row, width), _packed(cells, row, col, width)
    if spent:
        drop(cells)
    y = _product(by_row, None, None, width, seed)
    turn, e = _whitening(_gram(y)), None
    for _ in range(rounds if width < min(n_rows, n_cols) else 0):
        z = _product(by_col, y, turn, width, seed)
        drop(y)
        y = _product(by_row, z, _whitening(_gram(z)), width, seed)
        drop(z)
        g = _gram(y)
        turn, before, e = _whitening(g), e, np.linalg.eigvalsh(g)[-k:]
        if _gain(e, before) <= GAIN:
            break
    drop(by_row)
    q = _turned(y, turn, "factors")
    drop(y)
    b = _product(by_col, q, None, turn.shape[1], seed, "factors")             # transposed projection: columns x directions
    drop(by_col)
    e, u = np.linalg.eigh(_gram(b))
    order = np.argsort(-e)[:k]
    order = order[e[order] > _TINY * e[order[0]]]
    s, u = np.sqrt(e[order]), u[:, order]
    return Factors(q, b, u * s, u / s, [float(x) for x in s])
