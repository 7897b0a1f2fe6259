"""Stupid-backoff language-model scores over the corpus' own n-gram counts.

A document is scored by the counts of all *other* documents (its own n-grams
are taken out), so novelty shows as backoff: with K = min(n, place) and L the
counts left, a word is scored by the longest n-gram ending there that others
hold too, of k words, S = ALPHA**(K - k) x L(n-gram) / L(n-gram without its
last word), for k = 1 by ALPHA**(K - 1) x L(word) / N, and by
ALPHA**K / (N + 1) where others do not hold the word either.

Everything is a relation. Documents are exploded to (text key, n-gram, own
count) rows; a count table per order is grouped by n-gram hash and joined back
to them. Whoever holds an n-gram also holds its parts, so a log score is a sum
of one term per n-gram that is left:

    log L(g) - log L(g without last) - log L(g without first)
             + log L(g without both) - log ALPHA

which is added up per document without bringing the words back in order. An
n-gram of one document only is never left, so the count tables keep the others
alone; each row of a table carries the counts of the n-gram's parts.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, hashed_words, map_arrow, materialize, mix64, passes, text_buffers

ALPHA = 0.4
ORDER = 2
#: Hash slices of the n-grams of two words and more. One slice is on disk at a
#: time; each reads the texts again. All slices together are all n-grams.
SLICES = 3
#: Shuffle bytes up to which a partition of a count table may be joined from memory; beyond, by sorting.
JOIN_IN_MEMORY = "64m"


def _keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers per text, from 128 bits of its content."""
    raw = memoryview(np.ascontiguousarray(data))
    out = b"".join(xxhash.xxh3_128_digest(raw[a:z]) for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
    return np.frombuffer(out, np.int64).reshape(-1, 2)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, k1, k2, n_words`` per row."""
    def run(batches):
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            keys, n = _keys(data, offsets), np.zeros(b.num_rows, np.int64)
            for i, j in passes(offsets):
                row = hashed_words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])[1]
                n[i:j] = np.bincount(row, minlength=j - i)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(n)],
                                             ["doc_id", "k1", "k2", "n_words"])
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col), run,
                     "doc_id long, k1 long, k2 long, n_words long")


def _own(row: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first occurrence of each (row, id), count of its own (row, id) for every
    occurrence). Rows ascend, so a stable sort by id puts equal pairs side by side."""
    order = np.argsort(ids, kind="stable")
    r, x = row[order], ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = (x[1:] != x[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    n = np.diff(at, append=len(ids))
    held = np.empty(len(ids), np.int64)
    held[order] = np.repeat(n, n)
    return order[at], held


def _levels(data: np.ndarray, offsets: np.ndarray, k: int, stays: np.ndarray | None = None):
    """(row, ids, at): ids[m][x] is the hash of the m + 1 words that end at word
    x, ``at`` are the words that end an n-gram of k words of their row. Only
    rows marked in ``stays``."""
    h, row = hashed_words(data, offsets)
    if stays is not None and len(row):
        use = stays[row]
        h, row = h[use], row[use]
    ids, at = [h], np.arange(len(h))
    for m in range(1, k):
        ids.append(np.zeros(len(h), np.uint64))
        at = np.flatnonzero(row[m:] == row[:len(row) - m]) + m
        ids[m][at] = mix64(ids[m - 1][at - 1] * np.uint64(0x9E3779B97F4A7C15) + ids[m - 1][at] + np.uint64(m))
    return row, ids, at


def gram_counts(docs: DataFrame, k: int, part: int = 0, parts: int = 1, text_col: str = "text") -> DataFrame:
    """``head, tail, c``: how often all documents hold an n-gram of k words (see
    ``grams``), for those that more than one document holds. Occurrences are
    added up per batch of texts, then per task, then by the n-gram."""
    def run(batches):
        for b in batches:
            data, offsets = text_buffers(b.column(0))
            found = []
            for i, j in passes(offsets):
                row, ids, at = _levels(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
                at = at[ids[-1][at] % np.uint64(parts) == part]
                zero = np.zeros(len(at), np.uint64)
                found.append((row[at] + i, ids[-1][at], ids[k - 2][at - 1] if k > 1 else zero, ids[max(k - 2, 0)][at]))
            if not found:
                continue
            row, ids, head, tail = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(ids, kind="stable")      # rows ascend within an n-gram
            r, x = row[order], ids[order]
            new = np.ones(len(x), bool)
            new[1:] = x[1:] != x[:-1]
            more = np.ones(len(x), np.int64)
            more[1:] = new[1:] | (r[1:] != r[:-1])
            at = np.flatnonzero(new)
            if not len(at):
                continue
            yield pa.RecordBatch.from_arrays([pa.array(head[order[at]].view(np.int64)), pa.array(tail[order[at]].view(np.int64)),
                                              pa.array(np.diff(at, append=len(x))), pa.array(np.add.reduceat(more, at))],
                                             ["head", "tail", "c", "n"])
    rows = map_arrow(docs.select(text_col), run, "head long, tail long, c long, n long")
    return rows.groupBy("head", "tail").agg(F.sum("c").alias("c"), F.sum("n").alias("_n")).where("_n > 1").drop("_n")


def grams(docs: DataFrame, k: int, part: int = 0, parts: int = 1, text_col: str = "text") -> DataFrame:
    """Exploded n-grams of k words: one row per different text of a batch and
    different n-gram in it. ``copies`` is how often the batch holds the text,
    ``own`` how often the text holds the n-gram; ``head`` and ``tail`` are the
    hashes of it without its last and first word, followed by the own counts of
    head, tail and middle (k = 1: ``tail`` is the word, and nothing after it but
    ``own`` and ``copies``; k = 2: no middle). Only n-grams whose hash falls
    into slice ``part`` of ``parts``."""
    names = ["k1", "k2", "tail", "own", "copies", "head", "own_head", "own_tail", "own_mid"][:{1: 5, 2: 8}.get(k, 9)]

    def run(batches):
        for b in batches:
            data, offsets = text_buffers(b.column(0))
            keys = _keys(data, offsets)
            _, first, back, n = np.unique(keys.view("V16").ravel(), return_index=True, return_inverse=True, return_counts=True)
            stays = np.zeros(len(keys), bool)
            stays[first] = True
            copies = n[back]
            for i, j in passes(offsets):
                row, ids, at = _levels(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k, stays[i:j])
                at = at[ids[-1][at] % np.uint64(parts) == part]
                if not len(at):
                    continue
                first, own = _own(row[at], ids[-1][at])
                g, own = at[first], own[first]
                cols = [keys[i + row[g], 0], keys[i + row[g], 1], ids[max(k - 2, 0)][g].view(np.int64), own, copies[i + row[g]]]
                if k > 1:
                    held = _held(row, ids[k - 2], k - 2)
                    cols += [ids[k - 2][g - 1].view(np.int64), held[g - 1], held[g]]
                if k > 2:
                    cols.append(_held(row, ids[k - 3], k - 3)[g - 1])
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in cols], names)
    return map_arrow(docs.select(text_col), run, ", ".join(f"{n} long" for n in names))


def _held(row: np.ndarray, ids: np.ndarray, m: int) -> np.ndarray:
    """Own count of the n-gram of m + 1 words ending at each word (0 where a row has not so many)."""
    out = np.zeros(len(ids), np.int64)
    at = np.flatnonzero(row[m:] == row[:len(row) - m]) + m
    if len(at):
        out[at] = _own(row[at], ids[at])[1]
    return out


def _gram_id(k: int):
    """Hash of an n-gram of k words from its head and tail, as ``grams`` makes it."""
    @F.pandas_udf("long")
    def made(head, tail):
        import pandas as pd
        a, b = head.to_numpy().view(np.uint64), tail.to_numpy().view(np.uint64)
        return pd.Series(mix64(a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(k - 1)).view(np.int64))
    return made


def _joined(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows of n-grams of two words and more with their counts. Both sides carry
    96 bits of (head, tail) in their place: 64 to join by, 32 more to compare
    (as no key, so that the join has a single long)."""
    def short(df, check):
        return df.withColumns({"id": F.xxhash64("head", "tail"), check: F.hash("head", "tail")}).drop("head", "tail")
    return short(rows, "check").join(short(counts, "_check"), "id").where(F.col("check").bitwiseXOR(F.col("_check")) == 0)


def _text_key(texts: DataFrame) -> list[str]:
    """The columns that tell texts apart: half of the key where no two different texts share it."""
    shared = texts.groupBy("k1").agg(F.min("k2").alias("a"), F.max("k2").alias("z")).where("a <> z")
    return ["k1", "k2"] if shared.limit(1).count() else ["k1"]


def _added(joined: DataFrame, key: list[str], term) -> DataFrame:
    """Per text the number of n-grams left and the sum of ``term`` over them; copies count each time."""
    times = F.col("own") * F.col("copies")
    return joined.groupBy(*key).agg(F.sum(times).alias("n"), F.sum(times * term).alias("s"))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
                    order: int = ORDER, slices: int = SLICES) -> DataFrame:
    """``doc_id, n_words, n_<name>_left..., log_score, mean_log_score`` per row.

    Words are lower-cased (A-Z) runs of non-blanks. ``n_bigrams_left`` (for
    ``order`` above 2 also ``n_3grams_left`` and so on) counts the positions
    whose n-gram other documents hold too. Null and empty texts have no words,
    a log score of 0 and a null mean. Rows repeating an id or a text are
    documents of their own and vouch for each other. An empty table gives an
    empty result. Texts are scored whole; other columns are not read.

    Copies of a text have one score: their rows are added up and divided by
    their number. A frequent n-gram is summed per task before the shuffle of
    its count, and the join back may split it (adaptive skew join).
    """
    spark = docs.sparkSession
    # each slice's shuffle files go when its table is written; where all partitions of a count
    # table are small, the join keeps them in memory and does not sort the exploded side
    conf = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
            "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": JOIN_IN_MEMORY}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        texts = materialize(_texts(docs, id_col, text_col), "lm-texts")
        key = _text_key(texts)
        known = materialize(gram_counts(docs, 1, text_col=text_col).select(
            F.col("tail").alias("id"), "c", F.lit(None).cast("long").alias("c_tail")), "lm-words")
        words = grams(docs, 1, text_col=text_col).join(known.select(F.col("id").alias("tail"), "c"), "tail")
        found = [materialize(_added(words, key, F.log(F.col("c") - F.col("own"))), "lm-found").withColumn("k", F.lit(1))]
        for k in range(2, order + 1):
            tables = []
            for part in range(slices):
                head = known.select(F.col("id").alias("head"), F.col("c").alias("c_head"), F.col("c_tail").alias("c_mid"))
                tail = known.select(F.col("id").alias("tail"), F.col("c").alias("c_tail"))
                counts = gram_counts(docs, k, part, slices, text_col).join(head, "head").join(tail, "tail")
                tables.append(materialize(counts, "lm-counts"))
                left = F.col("c") - F.col("own")
                term = F.log(left) - F.log(F.col("c_head") - F.col("own_head")) - F.log(F.col("c_tail") - F.col("own_tail"))
                if k > 2:
                    term = term + F.log(F.col("c_mid") - F.col("own_mid"))
                joined = _joined(grams(docs, k, part, slices, text_col), tables[-1])
                found.append(materialize(_added(joined, key, term), "lm-found").withColumn("k", F.lit(k)))
            if k < order:
                every = tables[0]
                for t in tables[1:]:
                    every = every.unionByName(t)
                known = materialize(every.select(_gram_id(k)("head", "tail").alias("id"), "c", "c_tail"), "lm-known")
        return _scores(texts, found, key, alpha, order)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _scores(texts: DataFrame, found: list[DataFrame], key: list[str], alpha: float, order: int) -> DataFrame:
    total = texts.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("total"))
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    copies = texts.groupBy(*key).agg(F.count("*").alias("m"))
    sums = rows.groupBy(*key).agg(F.sum("s").alias("s"), *[
        F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(1, order + 1)])
    sums = copies.join(sums, key).select(*key, (F.col("s") / F.col("m")).alias("s"), *[
        F.coalesce((F.col(f"n{k}") / F.col("m")).cast("long"), F.lit(0)).alias(f"n{k}") for k in range(1, order + 1)])
    out = texts.join(sums, key, "left").crossJoin(F.broadcast(total)).fillna(0, ["s", *[f"n{k}" for k in range(1, order + 1)]])
    left = F.col("total") - F.col("n_words")
    lost = F.col("n_words") - F.col("n1")
    # every word as if by its own count, backed off from the longest n-gram there ...
    backed = sum((F.greatest(F.col("n_words") - m, F.lit(0)) for m in range(1, order)), F.lit(0))
    # ... and one step less for each n-gram left; an n-gram of two words also takes its N back
    log_left = F.log(F.greatest(left, F.lit(1)).cast("double"))
    s = F.col("s") + F.lit(math.log(alpha)) * (backed + lost) - F.col("n1") * log_left - lost * F.log((left + 1).cast("double"))
    for k in range(2, order + 1):
        s = s - F.lit(math.log(alpha)) * F.col(f"n{k}")
    if order > 1:
        s = s + F.col("n2") * log_left
    score = F.when(F.col("n_words") > 0, s).otherwise(0.0)
    names = {k: "n_bigrams_left" if k == 2 else f"n_{k}grams_left" for k in range(2, order + 1)}
    return out.select("doc_id", "n_words", *[F.col(f"n{k}").alias(v) for k, v in names.items()], score.alias("log_score"),
                      F.when(F.col("n_words") > 0, score / F.col("n_words")).alias("mean_log_score"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(documents(spark, sf_dir))
    return scored.withColumns({"log_score": F.round("log_score", 3), "mean_log_score": F.round("mean_log_score", 6)})


QUERIES = {"op4_lm_score": op4_lm_score}
SQL = {"op4_lm_score": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT r, unnest(ws) AS w, unnest(list_concat([NULL], ws[1:len(ws) - 1])) AS v, unnest(range(len(ws))) AS i FROM d
      WHERE len(ws) > 0),
u AS (SELECT w, count(*) AS c FROM t GROUP BY 1), b AS (SELECT v, w, count(*) AS c FROM t WHERE v IS NOT NULL GROUP BY 1, 2),
ud AS (SELECT r, w, count(*) AS c FROM t GROUP BY 1, 2),
bd AS (SELECT r, v, w, count(*) AS c FROM t WHERE v IS NOT NULL GROUP BY 1, 2, 3),
n AS (SELECT count(*) AS n FROM t), dn AS (SELECT r, count(*) AS k FROM t GROUP BY 1),
s AS (SELECT t.r, t.v, b.c - bd.c AS cb, uv.c - udv.c AS cv, u.c - ud.c AS cu, n.n - dn.k AS left_
      FROM t JOIN dn ON t.r = dn.r CROSS JOIN n JOIN u ON t.w = u.w JOIN ud ON t.r = ud.r AND t.w = ud.w
      LEFT JOIN b ON t.v = b.v AND t.w = b.w LEFT JOIN bd ON t.r = bd.r AND t.v = bd.v AND t.w = bd.w
      LEFT JOIN u uv ON t.v = uv.w LEFT JOIN ud udv ON t.r = udv.r AND t.v = udv.w),
l AS (SELECT r, count(*) AS n_words, count(*) FILTER (cb > 0) AS n_bigrams_left,
             sum(ln(CASE WHEN cb > 0 THEN cb / cv
                         ELSE (CASE WHEN v IS NULL THEN 1 ELSE 0.4 END) * CASE WHEN cu > 0 THEN cu / greatest(left_, 1)
                                                                              ELSE 0.4 / (left_ + 1) END END)) AS ls
      FROM s GROUP BY 1)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_bigrams_left, 0) AS n_bigrams_left,
       round(coalesce(ls, 0), 3) AS log_score, round(ls / n_words, 6) AS mean_log_score FROM d LEFT JOIN l ON d.r = l.r"""}
