"""Language identification by words first, backing off to character n-grams.

A word that any language knows counts with its log frequency in each language.
An unseen word falls back to its character 4-grams, then 3-, 2- and 1-grams
(with word edges): the longest length of which any gram is known decides, by
the mean log frequency of its known grams. A document's language has the
highest sum over its words; the score is its share after softmax.

Words are runs of Unicode letters, lower-cased.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, map_arrow, materialize, mix64, passes, span_hashes, text_buffers

#: Labelled rows per language that the classifier is fitted on: those with the smallest hash of their id.
TRAIN_ROWS = 3000
#: Bits of the id hash that one histogram of a language looks at, and rows that the last bucket may hold.
DIGIT, EDGE_ROWS = 12, 4096
GRAMS = (4, 3, 2, 1)
SMOOTHING = 0.1
_EDGE = np.uint32(0x2E)
_CHARS = 1 << 19
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _codes(points: np.ndarray) -> np.ndarray:
    return mix64(points.astype(np.uint64) + np.uint64(1))


def _words(col):
    """For each pass: (first row, end row, code points, starts, ends, row, hash) of its words."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.utf8_lower(pc.fill_null(col.cast(pa.large_string()), ""))
    data, offsets = text_buffers(col)
    for i, j in passes(offsets, _CHARS):
        points = np.frombuffer(data[offsets[i]:offsets[j]].tobytes().decode().encode("utf-32-le"), np.uint32)
        counts = pc.utf8_length(col.slice(i, j - i)).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        n = len(points)
        if n == 0:
            z = np.zeros(0, np.int64)
            yield i, j, points, z, z, z, np.zeros(0, np.uint64)
            continue
        inside = _is_letter()[points]
        edge = np.zeros(n + 1, bool)
        edge[cuts] = True
        before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
        after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        row = np.searchsorted(cuts, starts, "right") - 1
        yield i, j, points, starts, ends, row, span_hashes(_codes(points), starts, ends)


def _grams(points, starts, ends):
    """Words laid out between edges: (code points, word of each, first place of each word, length with edges)."""
    size = ends - starts + 2
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    flat = np.full(int(size.sum()), _EDGE, np.uint32)
    word = np.repeat(np.arange(len(starts)), size)
    inner = np.arange(len(flat)) - first[word]
    mid = (inner > 0) & (inner < size[word] - 1)
    flat[mid] = points[starts[word[mid]] + inner[mid] - 1]
    return flat, word, inner, size


def _gram_hashes(flat, word, inner, size, n):
    """(hash, word) of every n-gram of the laid out words; single letters leave the edges out."""
    ok = inner + n <= size[word]
    if n == 1:
        ok &= (inner > 0) & (inner < size[word] - 1)
    at = np.flatnonzero(ok)
    return span_hashes(_codes(flat), at, at + n), word[at]


def _count(langs, col):
    """(lang, kind, hash, count) of one batch; kind 0 are words, n are n-grams."""
    out = []
    names, which = np.unique(np.array(langs, object).astype(str), return_inverse=True)
    for i, _, points, starts, ends, row, h in _words(col):
        lang = which[i + row] if len(row) else np.zeros(0, np.int64)
        for kind in (0, *GRAMS):
            if not len(h):
                break
            if kind:
                flat, word, inner, size = laid      # noqa: F821
                x, w = _gram_hashes(flat, word, inner, size, kind)
                lg = lang[w]
            else:
                laid = _grams(points, starts, ends)
                x, lg = h, lang
            for k, name in enumerate(names):
                u, c = np.unique(x[lg == k], return_counts=True)
                out.append((name, kind, u, c))
    return out


def _training_rows(label: DataFrame, train_rows: int) -> DataFrame:
    """``_sid, _lang`` of each language's ``train_rows`` ids with the smallest
    hash, from ``_id, _lang``. A histogram of the hash's leading bits names the
    bucket in which the last of them lies; a full one is split by the next
    bits. Rows below it are in, and only the bucket itself is ranked, so no
    task holds the ids of a language."""
    spark = label.sparkSession
    rows = label.withColumn("_h", F.xxhash64("_id"))
    bits, inside, edges = 0, rows.withColumn("_missing", F.lit(train_rows)), {}
    while True:
        bits += DIGIT
        prefix = F.shiftright("_h", 64 - bits)
        counts = inside.groupBy("_lang", prefix.alias("d")).agg(F.count(F.lit(1)).alias("n"), F.first("_missing").alias("missing"))
        upto = F.sum("n").over(Window.partitionBy("_lang").orderBy("d"))       # at most 2**DIGIT rows a language
        found = counts.withColumn("upto", upto).where((F.col("upto") > F.col("missing")) & (F.col("upto") - F.col("n") <= F.col("missing")))
        found = found.select("_lang", "d", "n", (F.col("missing") - F.col("upto") + F.col("n")).alias("left")).collect()    # a row per language
        edges = {r["_lang"]: (r["d"], r["left"]) for r in found}
        if not edges:
            return rows.select(F.col("_id").cast("string").alias("_sid"), "_lang").distinct()   # no language has more (first round only)
        bound = spark.createDataFrame([(k, d, m) for k, (d, m) in edges.items()], "_lang string, _d long, _missing long")
        marked = rows.join(F.broadcast(bound), "_lang", "left")
        if max(r["n"] for r in found) <= EDGE_ROWS or bits + DIGIT > 64:
            break
        inside = marked.where(prefix == F.col("_d"))
    below = marked.where(F.col("_d").isNull() | (prefix < F.col("_d"))).select("_id", "_lang").distinct()
    edge = marked.where(prefix == F.col("_d")).select("_id", "_lang", "_h", "_missing").distinct()
    edge = edge.withColumn("_r", F.row_number().over(Window.partitionBy("_lang").orderBy("_h", "_id"))).where(F.col("_r") <= F.col("_missing"))
    return below.unionByName(edge.select("_id", "_lang")).select(F.col("_id").cast("string").alias("_sid"), "_lang")


def _table(lang: np.ndarray, h: np.ndarray, c: np.ndarray, langs: int):
    """(keys, first entry of each key, language and value of each entry, value
    of a language without entry): values are log frequencies less that default,
    so the table grows with what was counted, not with keys x languages."""
    order = np.lexsort((lang, h))
    lang, h, c = lang[order], h[order], c[order].astype(np.float64)
    keys, first = np.unique(h, return_index=True)
    total = np.bincount(lang, weights=c, minlength=langs) + SMOOTHING * max(1, len(keys))
    default = np.log(SMOOTHING / total)
    return keys, np.append(first, len(h)), lang, np.log((c + SMOOTHING) / total[lang]) - default[lang], default


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_rows: int = TRAIN_ROWS) -> dict:
    """The model: a bounded sample of labelled rows per language (whole texts),
    counted by Spark; every word and n-gram counted in it comes to the driver.

    Rows without language or id are not learned from, nor are the held-out
    ones (crc32 of the id as text is 2 modulo 4).
    """
    idx = F.col(id_col).cast("string")
    label = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang")).where(
        F.col("_lang").isNotNull() & (F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(4)) != 2))
    text = docs.select(idx.alias("_sid"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text"))
    chosen = F.broadcast(_training_rows(label, train_rows))             # train_rows ids a language
    sample = text.join(chosen, ["_sid", "_lang"], "left_semi").select("_lang", "_text")

    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            for name, kind, u, c in _count(b.column(0).to_pylist(), b.column(1)):
                if len(u):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * len(u), pa.string()), pa.array(np.full(len(u), kind, np.int32)),
                        pa.array(u.view(np.int64)), pa.array(c.astype(np.int64))], ["lang", "kind", "h", "c"])
    counts = materialize(map_arrow(sample, run, "lang string, kind int, h long, c long").groupBy("lang", "kind", "h").agg(
        F.sum("c").alias("c")), "langid-counts")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    number = F.coalesce(*[F.when(F.col("lang") == name, F.lit(i)) for i, name in enumerate(langs)], F.lit(0)).cast("int")
    tables = {}
    for kind in (0, *GRAMS):                    # what at most train_rows texts a language hold, 16 bytes an entry
        rows = counts.where(F.col("kind") == kind).select(number.alias("lang"), "h", F.col("c").cast("int").alias("c")).toArrow()
        lang, h, c = (rows[name].to_numpy() for name in ("lang", "h", "c"))
        tables[kind] = _table(lang, h.view(np.uint64), c, len(langs))
    return {"langs": langs, "tables": tables}


def _look(table, h):
    """(which hashes are known, log frequency of those in each language)."""
    keys, first, lang, value, default = table
    if not len(keys):
        return np.zeros(len(h), bool), np.zeros((0, len(default)))
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    hit = keys[at] == h
    at = at[hit]
    logs = np.tile(default, (len(at), 1))
    n = first[at + 1] - first[at]
    entry = np.arange(int(n.sum())) + np.repeat(first[at] - (np.cumsum(n) - n), n)
    logs[np.repeat(np.arange(len(at)), n), lang[entry]] += value[entry]
    return hit, logs


def _score_words(model, points, starts, ends, h):
    """Log frequency of each word in each language."""
    langs = len(model["langs"])
    out = np.zeros((len(h), langs))
    hit, logs = _look(model["tables"][0], h)
    out[hit] = logs
    lost = np.flatnonzero(~hit)
    if not len(lost):
        return out
    _, one, back = np.unique(h[lost], return_index=True, return_inverse=True)    # each unseen word once
    s, e = starts[lost][one], ends[lost][one]
    flat, word, inner, size = _grams(points, s, e)
    got = np.zeros((len(one), langs))
    open_ = np.ones(len(one), bool)
    for n in GRAMS:
        x, w = _gram_hashes(flat, word, inner, size, n)
        keep = open_[w]
        x, w = x[keep], w[keep]
        hit, logs = _look(model["tables"][n], x)
        w = w[hit]
        k = np.bincount(w, minlength=len(one))
        seen = k > 0
        for a in range(langs):
            sums = np.bincount(w, weights=logs[:, a], minlength=len(one))
            got[seen, a] = sums[seen] / k[seen]
        open_ &= ~seen
    out[lost] = got[back]
    return out


def predict_batch(model, col):
    """(language or ``und``, score) of each text of a column."""
    langs = model["langs"]
    names, scores = [], []
    for i, j, points, starts, ends, row, h in _words(col):
        n = j - i
        words = np.bincount(row, minlength=n)
        if not langs:
            names += ["und"] * n
            scores += [0.0] * n
            continue
        per = _score_words(model, points, starts, ends, h)
        sums = np.stack([np.bincount(row, weights=per[:, a], minlength=n) for a in range(len(langs))], 1)
        best = sums.argmax(1)
        share = 1.0 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
        names += [langs[b] if w else "und" for b, w in zip(best, words, strict=True)]
        scores += np.where(words > 0, share, 0.0).tolist()
    return names, scores


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row; only the text decides.

    ``und`` with score 0 where the text is null or has no letter, or where no
    labelled row was there to learn from. Ties go to the first language by
    name. A null id is not held out. Long texts are scored whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            names, scores = predict_batch(shared.value, b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    held = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"),
                                 F.col(text_col).alias("_text")), run,
                     "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: dict, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` for which ``identify`` names a language (with a
    score of at least ``least``), columns untouched; rows without letters go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            names, scores = predict_batch(shared.value, b.column(at))
            yield b.filter(pa.array([n != "und" and s >= least for n, s in zip(names, scores, strict=True)], pa.bool_()))
    return map_arrow(docs, run, docs.schema)


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, fit(docs))


QUERIES = {"op5_langid": op5_langid}
SQL: dict[str, str] = {}
