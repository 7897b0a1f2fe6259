"""Serving as batch jobs: one request table in, one result table out.

Requests are ``(user_id, query, exclude, k)``, all but the first optional; one
request per user counts. With a query, retrieval cuts the pool to
``candidate_pool_size`` items per distinct (query, exclude) pair and the pool
is joined to its users. Without a query every item that is not excluded is a
candidate; instead of users x items or users x categories, the plan uses the
fitted model's structure:

* the ranker sees the user only through ``category_match``, hence a user's raw
  score for an item equals the score at the representative share of the split
  interval (band) their share falls in; items are scored once per band;
* a user's *own* categories are those they have a share in or an excluded item
  of. Of these their first k rows are taken, after as many more as they exclude;
* all other categories have share 0, so their order is common to all users. The
  redundancy penalty has few levels; per level the best k rows of one common
  list are enough, fetched past the rows of the user's own categories;
* the least and greatest score come from the same two sources, CF extremes from
  a threshold search over items in descending order of their factors' length.

A ranker that splits on the CF score has no such structure: its requests are
scored against every item, in blocks.
"""
from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import blocks, collab, factor, rank, retrieve
from ..session import reliable_checkpoint, ship_package

CATEGORY_MATCH_INDEX = rank.FEATURE_COLS.index("category_match")
COLLAB_INDEX = rank.FEATURE_COLS.index("collab_score")
# Places in a category with a penalty of their own; all later places share the last.
LEVELS = round(rank.MMR_CAP / rank.MMR_STEP) + 1
# Common tables of up to this many slim rows are broadcast; larger ones are
# joined by shuffle, with the users of one key spread over SALTS tasks.
BROADCAST_ROWS, SALTS = 200_000, 32


@dataclass
class RecommenderModel:
    items: DataFrame
    item_vectors: DataFrame            # podcast_id, embedding
    encoder: object
    cf: collab.CFModel
    ranker: rank.RankerModel
    params: dict = field(default_factory=dict)


def validate_requests(requests: DataFrame, max_k: int = 50):
    """V3: (valid, rejects). k in [1, max_k]; user id present and non-empty."""
    bad_user = F.col("user_id").isNull() | (F.trim(F.col("user_id")) == "")
    bad_k = F.col("k").isNull() | (F.col("k") < 1) | (F.col("k") > max_k)
    reason = F.when(bad_user, "empty user_id").when(bad_k, "k out of range")
    tagged = requests.withColumn("reject_reason", reason)
    return (tagged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.where(F.col("reject_reason").isNotNull()))


def _split_thresholds(model, feature: int) -> list[float]:
    """Split thresholds on one feature over all trees of a fitted ensemble."""
    gbt = model.model.stages[-1]
    txt = gbt.toDebugString
    pat = re.compile(rf"feature {feature} <= ([-+0-9.eE]+|Infinity|-Infinity)\)")
    return sorted({float(x) for x in pat.findall(txt)})


def _uses_feature(model, feature: int) -> bool:
    return f"feature {feature} " in model.model.stages[-1].toDebugString


def _representatives(th: list[float]) -> list[float]:
    """One share value per split interval (-inf, t1], (t1, t2], ..., (tn, inf)."""
    return list(th) + [(th[-1] + 1.0) if th else 0.0]


def _lookup(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Join many users' rows to a common table on a few hot keys; same rows
    whichever way the measured size allows."""
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), keys)
    salted = table.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("user_id"), F.lit(SALTS)).cast("int"))
    return rows.join(salted, keys + ["_salt"]).drop("_salt")


def _upto(n):
    return F.explode(F.sequence(F.lit(1), n.cast("int")))


def _norm_ordered_ends(users: DataFrame, index: DataFrame) -> DataFrame:
    """``user_id, lo, hi`` of the users' products with the items' factors.
    Items come in descending length of their factors; since |p.q| <= |p| |q|, a
    user is done when the next length cannot beat the least and greatest so
    far. The items (checked size) go to every task, users stay where they are."""
    rows = index.select("podcast_idx", "qi").collect()      # at most BROADCAST_ITEM_BYTES, checked by the caller
    q = np.array([r["qi"] for r in rows], np.float64).reshape(len(rows), -1)
    length = np.sqrt((q * q).sum(axis=1))
    order = np.argsort(-length, kind="stable")
    shared = users.sparkSession.sparkContext.broadcast(
        (q[order], length[order], {rows[i]["podcast_idx"]: place for place, i in enumerate(order.tolist())}))

    def run(batches):
        q, length, place = shared.value
        for batch in batches:
            for i in range(0, len(batch), 1024):
                b = batch.iloc[i:i + 1024]
                p = np.vstack(b["pu"].to_numpy())
                reach = np.sqrt((p * p).sum(axis=1)) * (1 + 1e-9)
                at, gone = [], []
                for r, ex in enumerate(b["ex"]):
                    found = [place[x] for x in ex if x in place]
                    at += [r] * len(found)
                    gone += found
                at, gone = np.array(at, np.int64), np.array(gone, np.int64)
                lo, hi = np.full(len(b), np.inf), np.full(len(b), -np.inf)
                rest, start, step = np.arange(len(b)), 0, 64
                while start < len(q):
                    top = reach[rest] * length[start]
                    rest = rest[(top > hi[rest]) | (-top < lo[rest])]
                    if not len(rest):
                        break
                    s = p[rest] @ q[start:start + step].T
                    low = s
                    mine = (gone >= start) & (gone < start + step) & np.isin(at, rest)
                    if mine.any():
                        low, row = s.copy(), np.searchsorted(rest, at[mine])
                        s[row, gone[mine] - start], low[row, gone[mine] - start] = -np.inf, np.inf
                    hi[rest], lo[rest] = np.maximum(hi[rest], s.max(axis=1)), np.minimum(lo[rest], low.min(axis=1))
                    start, step = start + step, min(4096, 2 * step)
                yield pd.DataFrame({"user_id": b["user_id"].to_numpy(), "lo": lo, "hi": hi})
    return users.select("user_id", "pu", "ex").mapInPandas(run, "user_id string, lo double, hi double")


def _indexed_ends(users: DataFrame, index: DataFrame) -> DataFrame:
    """The same ends where the items are too large to send around: the best
    item for the user's factors and for their negative, by the block index."""
    tree = blocks.build(index.select(F.col("podcast_idx").cast("string").alias("item_id"), F.col("qi").alias("ivec")))
    ends = None
    for sign, name in ((-1.0, "lo"), (1.0, "hi")):
        q = users.select(F.col("user_id").alias("query_id"), F.transform("pu", lambda x: x * F.lit(sign)).alias("qvec"),  # noqa: B023
                         F.transform("ex", lambda x: x.cast("string")).alias("exclude"))
        best = blocks.search(tree, q, 1).groupBy(F.col("query_id").alias("user_id")).agg((F.max("score") * F.lit(sign)).alias(name))
        ends = best if ends is None else ends.join(best, "user_id", "full_outer")
    return ends


def _cf_minmax(cf: collab.CFModel, users: DataFrame, excluded: DataFrame, pool: DataFrame) -> DataFrame:
    """``user_id, clo, chi``: least and greatest CF score of each known user
    over the items of the pool they do not exclude. Unindexed items score 0.0."""
    ship_package(users.sparkSession)
    if cf.blocks is not None and cf.item_index.count() * (cf.n_factors + 4) * 8 > collab.BROADCAST_ITEM_BYTES:
        return _cf_minmax_by_blocks(cf, users, excluded, pool)
    zero = F.array_repeat(F.lit(0.0), cf.n_factors)
    known, items, _ = cf.scoring_tables()
    items = pool.select("podcast_id").join(items, "podcast_id", "left")
    index = reliable_checkpoint(items.where("podcast_idx IS NOT NULL").select("podcast_id", "podcast_idx", F.coalesce("qi", zero).alias("qi")))
    n_bare = items.where("podcast_idx IS NULL").count()
    left_out = excluded.join(index.select("podcast_id", "podcast_idx"), "podcast_id", "left").groupBy("user_id").agg(
        F.collect_list("podcast_idx").alias("ex"), F.sum(F.col("podcast_idx").isNull().cast("int")).alias("bare"))
    uf = users.select("user_id").join(known, "user_id").join(left_out, "user_id", "left").select(
        "user_id", "mu", F.coalesce("pu", zero).alias("pu"), F.coalesce("ex", F.array().cast("array<int>")).alias("ex"),
        (F.lit(n_bare) - F.coalesce("bare", F.lit(0))).alias("n_bare"))
    uf = reliable_checkpoint(uf)
    small = index.count() * (cf.n_factors + 4) * 8 <= collab.BROADCAST_ITEM_BYTES
    ends = _norm_ordered_ends(uf, index) if small else _indexed_ends(uf, index)
    bare = F.when(F.col("n_bare") > 0, F.lit(0.0))
    return uf.join(ends, "user_id", "left").select(
        "user_id", F.least(F.col("mu") + F.col("lo"), bare).alias("clo"), F.greatest(F.col("mu") + F.col("hi"), bare).alias("chi"))


def _cf_minmax_by_blocks(cf: collab.CFModel, users: DataFrame, excluded: DataFrame, pool: DataFrame) -> DataFrame:
    """The same from the model's factor blocks: no vector is collected or shuffled."""
    pool = reliable_checkpoint(pool.select("podcast_id").join(cf.item_index, "podcast_id", "left"))
    n_bare = pool.where("podcast_idx IS NULL").count()
    asked = reliable_checkpoint(users.select("user_id").join(cf.user_means, "user_id"))
    out = excluded.join(pool, "podcast_id").join(asked.select("user_id", "user_idx"), "user_id")
    out = reliable_checkpoint(out.select("user_id", "user_idx", "podcast_idx"))
    bare = out.where("podcast_idx IS NULL").groupBy("user_id").agg(F.count(F.lit(1)).alias("bare"))
    ends = factor.extremes(cf.blocks, asked.select("user_idx").distinct(), out.where("podcast_idx IS NOT NULL"),
                           pool.where("podcast_idx IS NOT NULL"), "user_idx", "podcast_idx")
    some = F.when(F.lit(n_bare) - F.coalesce("bare", F.lit(0)) > 0, F.lit(0.0))
    return asked.join(ends, "user_idx", "left").join(bare, "user_id", "left").select(
        "user_id", F.least(F.col("mu") + F.col("lo"), some).alias("clo"), F.greatest(F.col("mu") + F.col("hi"), some).alias("chi"))


def _finish(model: RecommenderModel, ranked: DataFrame) -> DataFrame:
    return ranked.select("user_id", "rank", "podcast_id", "title", "category", "description",
                         "embedding_score", "collab_score", "ranker_score")


def _query_key():
    ex = F.array_join(F.coalesce(F.col("exclude"), F.array().cast("array<string>")), "\u0001")
    return F.sha2(F.concat_ws("\u0001", F.col("query"), ex), 256)


def _query_path(model: RecommenderModel, req: DataFrame, k: int, pool: int, lam: float) -> DataFrame:
    """Retrieve once per distinct (query, exclude), then CF + rank per user."""
    r = reliable_checkpoint(req.withColumn("query_id", _query_key()))   # one row per request
    qs = r.select("query_id", "query", "exclude").dropDuplicates(["query_id"])
    qv = retrieve.embed_text(qs.select("query_id", F.col("query").alias("text")), "query_id", encoder=model.encoder)
    qv = qv.join(qs.select("query_id", "exclude"), "query_id")
    # The retrieval result is bounded (distinct queries x pool): write it once.
    hits = reliable_checkpoint(retrieve.retrieve(qv, model.item_vectors, model.items, pool, exclude_col="exclude"))
    cand = r.select("user_id", "query_id").join(hits, "query_id").drop("query_id")
    cand = cand.withColumnRenamed("rank", "pos")
    meta = model.items.select("podcast_id", *[c for c in rank.MISSING_DEFAULTS if c in model.items.columns],
                              F.col("category").alias("category_meta"))
    cand = cand.join(meta, "podcast_id", "left").withColumn(
        "category", F.coalesce("category", "category_meta")).drop("category_meta")
    # CF scores computed on the candidate rows themselves (no join back).
    cand = collab.score_cf(model.cf, cand, bounded=True).withColumn(
        "collab_score", F.coalesce("collab_score", F.lit(0.0)))
    ranked = rank.rank_candidates(model.ranker, cand, k, lam, pos=("pos", "podcast_id"), bounded=True)
    return _finish(model, ranked)


def _every_item_path(model: RecommenderModel, req: DataFrame, k: int, lam: float, block: int = 2048) -> DataFrame:
    """Requests against every item where the ranker splits on the CF score, so
    that each pair has a score of its own: the stated requests meet the items
    in blocks of about ``block`` rows."""
    n = max(1, -(-model.items.count() // block))
    it = model.items.withColumn("_b", F.pmod(F.xxhash64("podcast_id"), F.lit(n)).cast("int"))
    asked = req.select("user_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_b"))
    out = req.select("user_id", F.explode("exclude").alias("podcast_id"))
    cand = asked.join(it, "_b").drop("_b").join(out, ["user_id", "podcast_id"], "left_anti")
    cand = collab.score_cf(model.cf, cand.withColumn("embedding_score", F.lit(0.0)))
    cand = reliable_checkpoint(cand.withColumn("collab_score", F.coalesce("collab_score", F.lit(0.0))))
    return _finish(model, rank.rank_candidates(model.ranker, cand, k, lam, pos=("podcast_id",)))


def _all_items_path(model: RecommenderModel, req: DataFrame, k: int, lam: float) -> DataFrame:
    """Requests (user_id, exclude) against every item; see the module's text."""
    rm = model.ranker
    if _uses_feature(rm, COLLAB_INDEX):
        return _every_item_path(model, req, k, lam)
    th = _split_thresholds(rm, CATEGORY_MATCH_INDEX)
    band_of = lambda s: F.size(F.filter(F.array(*[F.lit(t) for t in th]), lambda t: t < s)) if th else F.lit(0)
    band0 = sum(t < 0.0 for t in th)
    # Items scored once per share band (items x bands, bands bounded by the tree splits).
    it = model.items.select("podcast_id", "category", *[c for c in rank.MISSING_DEFAULTS if c in model.items.columns])
    bands = F.array(*[F.struct(F.lit(i).alias("band"), F.lit(float(v)).alias("rep")) for i, v in enumerate(_representatives(th))])
    feats = it.withColumn("_b", F.explode(bands)).select("*", "_b.band", "_b.rep").drop("_b")
    feats = rank.derive_features(feats.withColumn("user_id", F.lit(None).cast("string")), rm.norms, rm.prefs.limit(0))
    scored = rm.model.transform(feats.withColumn("category_match", F.col("rep")))
    ckey = F.coalesce(F.col("category"), F.lit("\u0000null")).alias("ckey")
    scored = reliable_checkpoint(scored.select(ckey, "band", "podcast_id", "ranker_score"))
    pool = model.items.select("podcast_id", ckey)

    users = req.select("user_id")
    excluded = req.select("user_id", F.explode(F.array_distinct("exclude")).alias("podcast_id"))
    excluded = reliable_checkpoint(excluded.join(pool, "podcast_id"))
    gone = excluded.groupBy("user_id", "ckey").agg(F.count(F.lit(1)).alias("e"))
    prefs = rm.prefs.join(users, "user_id", "left_semi").select("user_id", F.col("category").alias("ckey"), "share")
    own_cats = prefs.join(gone, ["user_id", "ckey"], "full_outer").select(
        "user_id", "ckey", band_of(F.coalesce("share", F.lit(0.0))).cast("int").alias("band"), F.coalesce("e", F.lit(0)).alias("e"))
    own_cats = reliable_checkpoint(own_cats)
    counts = reliable_checkpoint(users.join(own_cats.groupBy("user_id").agg(F.count(F.lit(1)).alias("s"), F.sum("e").alias("e")), "user_id", "left")
                                 .select("user_id", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("e", F.lit(0)).alias("e")))
    top = counts.agg(F.max("s"), F.max("e")).first()
    s_max, e_max = int(top[0] or 0), int(top[1] or 0)
    not_excluded = lambda df: df.join(excluded.select("user_id", "podcast_id"), ["user_id", "podcast_id"], "left_anti")
    foreign = lambda df: df.join(own_cats.select("user_id", "ckey"), ["user_id", "ckey"], "left_anti")
    number = lambda by, *order: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    down = (F.col("ranker_score").desc(), F.col("podcast_id").asc())

    # Own categories: the first k rows that are left, and the least one left.
    best = reliable_checkpoint(scored.withColumn("r", number(("ckey", "band"), *down)).where(F.col("r") <= k + e_max))
    worst = scored.withColumn("r", number(("ckey", "band"), F.col("ranker_score").asc(), F.col("podcast_id").asc()))
    worst = reliable_checkpoint(worst.where(F.col("r") <= 1 + e_max))
    own = not_excluded(_lookup(own_cats.withColumn("r", _upto(F.col("e") + k)), best, ["ckey", "band", "r"]))
    own = own.withColumn("_j", number(("user_id", "ckey"), *down)).where(F.col("_j") <= k)
    low = not_excluded(_lookup(own_cats.withColumn("r", _upto(F.col("e") + 1)), worst, ["ckey", "band", "r"]))

    # All others: one common list per penalty level. Of an own category at most
    # one row stands before a needed row (the last level: all its other rows).
    last = LEVELS if lam > 0 else 1
    lists = best.where((F.col("band") == band0) & (F.col("r") <= k)).withColumn("level", F.least("r", F.lit(last)))
    lists = lists.withColumn("_j", F.col("r")).withColumn("r", number(("level",), *down)).drop("band")
    lists = reliable_checkpoint(lists.where(F.col("r") <= k + s_max * k))
    skip = F.when(F.col("level") < last, 1).otherwise(max(k - last + 1, 0))
    asked = counts.withColumn("level", F.explode(F.array(*[F.lit(i + 1) for i in range(last)])))
    rest = foreign(_lookup(asked.withColumn("r", _upto(F.col("s") * skip + k)), lists, ["level", "r"]))
    ends = scored.where(F.col("band") == band0).groupBy("ckey").agg(F.min("ranker_score").alias("lo"), F.max("ranker_score").alias("hi"))
    ends = ends.select("ckey", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("lo").alias("value")),
                                                 F.struct(F.lit(1).alias("side"), F.col("hi").alias("value")))).alias("x")).select("ckey", "x.*")
    outward = F.when(F.col("side") == 1, -F.col("value")).otherwise(F.col("value"))
    ends = reliable_checkpoint(ends.withColumn("r", number(("side",), outward.asc(), F.col("ckey").asc())).where(F.col("r") <= 1 + s_max))
    sides = counts.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("r", _upto(F.col("s") + 1))
    sides = foreign(_lookup(sides, ends, ["side", "r"]))

    rows = reliable_checkpoint(own.select("user_id", "ckey", "podcast_id", "ranker_score", "_j").unionByName(
        rest.select("user_id", "ckey", "podcast_id", "ranker_score", "_j")))
    mm = rows.select("user_id", F.col("ranker_score").alias("value")).unionByName(
        low.select("user_id", F.col("ranker_score").alias("value"))).unionByName(sides.select("user_id", "value"))
    mm = mm.groupBy("user_id").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    rows = rows.join(mm, "user_id").withColumn(
        "ranker_score", F.when(F.col("hi") > F.col("lo"), (F.col("ranker_score") - F.col("lo")) / (F.col("hi") - F.col("lo")))
        .otherwise(F.col("ranker_score"))).drop("lo", "hi")
    if lam > 0:
        ranked = rank.mmr_order(rows, k, lam, out_col="rank")
    else:
        ranked = rank.topk_per_group(rows.drop("_j"), k, "ranker_score", out_col="rank")
    ranked = ranked.drop("ckey").join(model.items.select("podcast_id", "title", "category", "description"), "podcast_id")
    # CF scores only for the chosen rows, scaled by the user's extremes over their pool.
    raw = collab.raw_cf_scores(model.cf, ranked.select("user_id", "podcast_id"))
    raw = raw.join(_cf_minmax(model.cf, users, excluded, pool), "user_id", "left").join(counts.select("user_id", "e"), "user_id")
    cs = F.when(F.col("known_user") & (F.lit(model.items.count()) - F.col("e") > 1) & (F.col("chi") > F.col("clo")),
                (F.col("collab_score") - F.col("clo")) / (F.col("chi") - F.col("clo"))).otherwise(F.col("collab_score"))
    raw = raw.select("user_id", "podcast_id", cs.alias("collab_score"))
    out = ranked.join(raw, ["user_id", "podcast_id"], "left").withColumn("embedding_score", F.lit(0.0))
    return _finish(model, out)


def recommend_batch(model: RecommenderModel, requests: DataFrame, k: int | None = None) -> DataFrame:
    """V2: ``(user_id, rank, podcast_id, title, category, description,
    embedding_score, collab_score, ranker_score)``. Requests carry ``user_id``
    and optional ``query``, ``exclude``, ``k`` and ``request_order`` columns.

    Of several requests of a user the one with the greatest ``request_order``
    counts (then, or without the column, the greatest query, exclusions and
    k). With a ``k`` column, requests that ``validate_requests`` rejects get no
    rows, and each other request as many as it asks for. Requests without a
    user id get no rows."""
    p = model.params
    k = int(k or p.get("top_k", 10))
    pool = int(p.get("candidate_pool_size", 100))
    lam = float(p.get("diversity_penalty", 0.1))
    own_k = "k" in requests.columns
    if own_k:
        requests, _ = validate_requests(requests)
    for name, kind in (("query", "string"), ("exclude", "array<string>"), ("k", "int"), ("request_order", "long")):
        if name not in requests.columns:
            requests = requests.withColumn(name, F.lit(None).cast(kind))
    req = requests.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.max(F.struct("request_order", "query", "exclude", "k")).alias("_r")).select("user_id", "_r.query", "_r.exclude", "_r.k")
    req = reliable_checkpoint(req)
    if own_k:
        k = int(req.agg(F.max("k")).first()[0] or k)
    has_q = F.col("query").isNotNull() & (F.col("query") != "")
    with_q, no_q = req.where(has_q), req.where(~has_q)
    parts = []
    if not with_q.isEmpty():
        parts.append(_query_path(model, with_q.drop("k"), k, pool, lam))
    if not no_q.isEmpty() or not parts:
        parts.append(_all_items_path(model, no_q.select("user_id", "exclude"), k, lam))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    if own_k:       # a shorter list is the beginning of a longer one
        out = out.join(req.select("user_id", F.col("k").alias("_k")), "user_id").where(F.col("rank") <= F.col("_k")).drop("_k")
    return out


def recommend(model: RecommenderModel, user_id: str, query: str = "", history=None, k: int | None = None):
    """V1: one user: the batch job with one request row."""
    spark = model.items.sparkSession
    req = spark.createDataFrame([(user_id, query or None, list(history or []) or None)],
                                "user_id string, query string, exclude array<string>")
    return recommend_batch(model, req, k)
