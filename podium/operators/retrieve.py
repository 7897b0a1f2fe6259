"""Retrieval: item text, text embedding job, exact inner-product top-k.

Exact search: where the query side is small (its bytes are measured first)
it is broadcast, every task keeps each query's local top-k while its items
stream by, and only those rows are shuffled. Beyond that a bound-pruned block
index (``blocks``) sends items only to the slices of queries that can want
them. A per-query window merges the local lists. No row-level cross join is
planned and no table passes whole through the driver.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import l2_normalize
from ..session import ship_package
from . import blocks

SEP = " [SEP] "


def item_text(items: DataFrame) -> DataFrame:
    """``title [SEP] category [SEP] description`` with NULL as ''."""
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    return items.select("podcast_id", F.concat(c("title"), F.lit(SEP), c("category"),
                                               F.lit(SEP), c("description")).alias("text"))


def similar_item_text(items: DataFrame) -> DataFrame:
    """E4 query text: title, category and description joined by blanks."""
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    return items.select("podcast_id", F.concat_ws(" ", c("title"), c("category"), c("description")).alias("text"))


class HashingEncoder:
    """Default text encoder, all JVM-side: tokenize, hash to ``dim`` buckets,
    IDF weight, L2 normalise. ``fit`` learns document frequencies once; the
    same fitted model encodes item texts and query texts."""

    def __init__(self, dim: int = 256, min_doc_freq: int = 0):
        self.dim, self.min_doc_freq = dim, min_doc_freq
        self.model = None

    def _pipeline(self):
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
        return Pipeline(stages=[
            RegexTokenizer(inputCol="text", outputCol="_tok", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
            HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=self.dim),
            IDF(inputCol="_tf", outputCol="_idf", minDocFreq=self.min_doc_freq),
            Normalizer(inputCol="_idf", outputCol="_vec", p=2.0)])

    def fit(self, texts: DataFrame) -> "HashingEncoder":
        self.model = self._pipeline().fit(texts.select("text"))
        return self

    def fingerprint(self) -> str:
        """Digest of what was learnt: equal for equal document frequencies."""
        return hashlib.sha256(self.model.stages[2].idf.toArray().tobytes()).hexdigest()[:16]

    def save(self, path: str) -> None:
        """Keeps the fitted encoder (``load_hashing_encoder`` reads it back)."""
        self.model.write().overwrite().save(path)

    def transform(self, df: DataFrame, id_col: str) -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        out = self.model.transform(df)
        return out.select(id_col, vector_to_array("_vec", "float32").alias("embedding"))


def load_hashing_encoder(path: str) -> HashingEncoder:
    from pyspark.ml import PipelineModel
    model = PipelineModel.load(path)
    enc = HashingEncoder(dim=model.stages[1].getNumFeatures(), min_doc_freq=model.stages[2].getMinDocFreq())
    enc.model = model
    return enc


_LOADED: dict[str, object] = {}     # the encoders of this Python worker


def worker_encoder(name: str, load):
    """The encoder ``name`` of this Python worker, loaded when first asked for;
    it stays for the worker's later tasks."""
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


def first_tokens(text: str | None, limit: int) -> str:
    """At most ``limit`` blank-separated tokens from the start of a text."""
    return " ".join((text or "").split(None, limit)[:limit])


class WorkerEncoder:
    """An encoder that lives in the Python workers: ``load()`` gives a function
    from a list of texts to a matrix of vectors. It is called once per worker,
    the function with up to ``batch`` texts at a time, each cut to its first
    ``max_tokens`` tokens. Vectors are L2-normalised; a zero vector stays.
    ``name`` tells one model from another."""

    model = "worker"                # nothing is left to fit

    def __init__(self, name: str, load, batch: int = 64, max_tokens: int = 256):
        self.name, self.load, self.batch, self.max_tokens = name, load, batch, max_tokens

    def transform(self, df: DataFrame, id_col: str) -> DataFrame:
        ship_package(df.sparkSession)
        name, load, size, limit = self.name, self.load, self.batch, self.max_tokens

        def run(batches):
            encode = worker_encoder(name, load)
            for b in batches:
                vectors = []
                for i in range(0, len(b), size):
                    m = np.asarray(encode([first_tokens(t, limit) for t in b["text"].iloc[i:i + size]]), np.float64)
                    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
                    vectors += list((m / np.where(length > 0, length, 1.0)).astype(np.float32))
                yield pd.DataFrame({id_col: b[id_col], "embedding": vectors})
        return df.select(id_col, "text").mapInPandas(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, embedding array<float>")


def embed_text(df: DataFrame, id_col: str, text_col: str = "text", encoder=None) -> DataFrame:
    """``(id, embedding array<float>)``, L2-normalised. ``encoder`` is any
    object with ``fit(df[text])`` and ``transform(df, id_col)``; the default is
    the JVM-side hashing encoder."""
    enc = encoder or HashingEncoder()
    src = df.select(id_col, F.col(text_col).alias("text"))
    if getattr(enc, "model", None) is None:
        enc.fit(src)
    return enc.transform(src, id_col)


# Largest query side (vectors and excluded ids) that is broadcast.
BROADCAST_QUERY_BYTES = 16 * 1024 * 1024
_CELLS = 1 << 22    # scores held at once by one product


def _local_topk(qids, qm, excluded, ids, im, k: int, exclude_self: bool) -> pd.DataFrame:
    """Each query's k best of one block of items, ties by item id. The
    excluded ids of a query are looked up in the block, and lose."""
    rank_of_id = np.empty(len(ids), np.int64)
    rank_of_id[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    place = {v: i for i, v in enumerate(ids)} if exclude_self or excluded is not None else {}
    step = max(1, _CELLS // max(1, len(ids)))
    rows, cols, vals = [], [], []
    for a in range(0, len(qids), step):
        s = qm[a:a + step] @ im.T
        for r, qid in enumerate(qids[a:a + step]) if place else ():
            out = list(excluded[a + r]) if excluded is not None and excluded[a + r] is not None else []
            gone = [place[x] for x in out + ([qid] if exclude_self else []) if x in place]
            s[r, gone] = -np.inf
        kk = min(k, s.shape[1])
        least = np.partition(s, s.shape[1] - kk, axis=1)[:, s.shape[1] - kk]
        r, c = np.nonzero((s >= least[:, None]) & np.isfinite(s))
        v = s[r, c]
        order = np.lexsort((rank_of_id[c], -v, r))
        r, c, v = r[order], c[order], v[order]
        first = np.searchsorted(r, r, "left")
        keep = np.arange(len(r)) - first < kk
        rows.append(r[keep] + a)
        cols.append(c[keep])
        vals.append(v[keep])
    r, c, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, cols, vals))
    return pd.DataFrame({"query_id": qids[r].astype(object), "item_id": ids[c].astype(object), "score": v.astype(float)})


def _broadcast_topk(q: DataFrame, it: DataFrame, k: int, exclude_self: bool, has_exclude: bool) -> DataFrame:
    """Local top-k lists against a broadcast query side; items are not shuffled."""
    rows = q.collect()      # at most BROADCAST_QUERY_BYTES, checked by the caller
    side = it.sparkSession.sparkContext.broadcast((
        np.array([r["query_id"] for r in rows], object), np.array([r["qvec"] for r in rows], np.float64),
        [r["exclude"] for r in rows] if has_exclude else None))

    def run(batches):
        qids, qm, excluded = side.value
        best = None
        for b in batches:
            if b.empty:
                continue
            hits = _local_topk(qids, qm, excluded, b["item_id"].to_numpy().astype(object), blocks.matrix(b["ivec"]), k, exclude_self)
            best = hits if best is None else pd.concat([best, hits], ignore_index=True).sort_values(
                ["query_id", "score", "item_id"], ascending=[True, False, True]).groupby("query_id", sort=False).head(k)
        if best is not None:
            yield best
    return it.mapInPandas(run, blocks.HITS)


def exact_topk(queries: DataFrame, items: DataFrame, k: int, query_id: str = "query_id",
               item_id: str = "item_id", query_vec: str = "embedding", item_vec: str = "embedding",
               exclude_col: str | None = None, exclude_self: bool = False,
               block_size: int | None = None, broadcast_bytes: int = BROADCAST_QUERY_BYTES) -> DataFrame:
    """E3 core: for every query, the k items with the largest inner product,
    descending, ties by item id; excluded ids (an array column on the query
    side) and optionally the query's own id never appear. Rows without a
    vector take no part.
    Returns ``(query_id, item_id, score, rank)``."""
    ship_package(items.sparkSession)
    qcols = [F.col(query_id).cast("string").alias("query_id"), F.col(query_vec).alias("qvec")]
    if exclude_col:
        qcols.append(F.col(exclude_col).alias("exclude"))
    q = queries.select(*qcols)
    it = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_vec).alias("ivec")).where("ivec is not null")
    ids = F.coalesce(F.octet_length(F.array_join("exclude", " ")), F.lit(0)) if exclude_col else F.lit(0)
    size = q.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("qvec") * 8 + F.octet_length("query_id") + ids).alias("bytes")).first()
    if size["n"] and (size["bytes"] or 0) <= broadcast_bytes:
        local = _broadcast_topk(q.where("qvec is not null"), it, k, exclude_self, bool(exclude_col))
    else:
        q = q.where("qvec is not null")
        if not exclude_col:
            q = q.withColumn("exclude", F.lit(None).cast("array<string>"))
        local = blocks.search(blocks.build(it, block_size), q, k, exclude_self)
    w = blocks.best_first()
    return (local.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                 .withColumnRenamed("query_id", query_id).withColumnRenamed("item_id", item_id))


def retrieve(query_vectors: DataFrame, item_vectors: DataFrame, items: DataFrame, k: int,
             exclude_col: str | None = None) -> DataFrame:
    """Top-k items per query with title, category, description and
    ``embedding_score``. Always a typed frame, empty or not."""
    hits = exact_topk(query_vectors, item_vectors.withColumnRenamed("podcast_id", "item_id"), k,
                      exclude_col=exclude_col)
    meta = items.select(F.col("podcast_id").alias("item_id"), "title", "category", "description")
    return (hits.join(meta, "item_id", "left")
                .select("query_id", F.col("item_id").alias("podcast_id"), "title", "category",
                        "description", F.col("score").alias("embedding_score"), "rank"))


def similar_items(item_vectors: DataFrame, k: int, item_id: str = "item_id",
                  vec: str = "embedding") -> DataFrame:
    """E4, all-items form over stored vectors: each item's k nearest other
    items (self excluded). ``(item_id, similar_id, score, rank)``."""
    if not 1 <= k <= 50:
        raise ValueError("k must be in [1, 50]")
    q = item_vectors.select(F.col(item_id).alias("query_id"), F.col(vec).alias("embedding"))
    it = item_vectors.select(F.col(item_id).alias("item_id"), F.col(vec).alias("embedding"))
    hits = exact_topk(q, it, k, exclude_self=True)
    return hits.select(F.col("query_id").alias(item_id), F.col("item_id").alias("similar_id"),
                       "score", "rank")


def similar_by_text(items: DataFrame, item_vectors: DataFrame, encoder, requested: DataFrame, k: int) -> DataFrame:
    """E4, request form: for each requested ``podcast_id`` the k items nearest
    to its own title, category and description as a query text, itself left
    out. ``(podcast_id, status, similar_id, title, category, score, rank)``;
    an id that is not among the items is answered by one row with status
    ``unknown``, a known one without any neighbour by one row ``none``."""
    if not 1 <= k <= 50:
        raise ValueError("k must be in [1, 50]")
    asked = requested.select("podcast_id").where("podcast_id is not null").distinct()
    texts = similar_item_text(items).dropDuplicates(["podcast_id"]).join(asked, "podcast_id")
    vectors = embed_text(texts, "podcast_id", encoder=encoder).select(F.col("podcast_id").alias("query_id"), "embedding")
    hits = exact_topk(vectors, item_vectors.withColumnRenamed("podcast_id", "item_id"), k, exclude_self=True)
    meta = items.select(F.col("podcast_id").alias("similar_id"), "title", "category")
    found = hits.select(F.col("query_id").alias("podcast_id"), F.col("item_id").alias("similar_id"), "score", "rank").join(
        meta, "similar_id", "left")
    status = F.when(F.col("known").isNull(), "unknown").when(F.col("similar_id").isNull(), "none").otherwise("ok")
    return asked.join(texts.select("podcast_id", F.lit(True).alias("known")), "podcast_id", "left").join(
        found, "podcast_id", "left").select("podcast_id", status.alias("status"), "similar_id", "title", "category", "score", "rank")


def label_centroids(vectors: DataFrame, group: str = "category", vec: str = "embedding") -> DataFrame:
    """Unit-norm mean vector per group: a query vector per category. The sum
    of arrays is a per-dimension aggregate (posexplode + groupBy), so a hot
    group is combined map-side."""
    ex = vectors.select(group, F.posexplode(vec).alias("d", "x"))
    agg = ex.groupBy(group, "d").agg(F.avg(F.col("x").cast("double")).alias("m"))
    arr = agg.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("d", "m"))).alias("dm"))
    return arr.select(F.col(group).alias("query_id"),
                      l2_normalize(F.transform("dm", lambda s: s["m"])).alias("embedding"))


def embedding_of(item_vectors: DataFrame, item_id: str, id_col: str = "podcast_id") -> DataFrame:
    """E5: one item's vector (an empty frame when unknown); a pushed-down
    filter on the id."""
    return item_vectors.where(F.col(id_col) == F.lit(item_id))
