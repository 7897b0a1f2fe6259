"""Near-duplicate components by b-bit MinHash.

1. Every text becomes the set of its 5-word shingles (64-bit hashes). Texts
   with equal sets are one *class*; from here on only classes are compared.
2. 160 minima per class: 40 bands of 4 full minima make bucket keys; the low
   two bits of each minimum, packed into five longs, are the signature.
3. Candidates: each bucket links its members to two hubs (least and greatest
   class), so a bucket of any size gives a linear number of pairs. The bit
   signatures of a pair estimate its similarity, corrected for chance
   agreement of two-bit values; hopeless pairs go.
4. What is left is confirmed on the full sets, and links join to components.
5. Buckets that still hold several components link their members once more to
   the most central one, and then compare members of *different* components,
   after two exact-minded cuts. A class can only be linked across
   components if enough of its shingles occur in another component: with r
   such shingles of n, a link needs 1.75 min(r_a, r_b) >= 0.75 (n_a + n_b). And the
   pair must pass a finer sketch (2048 one-bit minima, made for these classes
   only). A pair is looked at in its first common band. Families of copies
   that differ by their own edits, and texts that share only a passage, fall
   to the first cut; what passes both is confirmed on the full sets.

At a similarity of exactly 0.75 a pair shares no band with probability
(1 - 0.75**4)**40 = 2.5e-7.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free_names, hashed_words, map_arrow, materialize, mix64, passes, text_buffers

SHINGLE = 5
#: Links need 100 x intersection >= PERCENT x union.
PERCENT = 75
BANDS, ROWS = 40, 4
BITS = 2
#: Candidates whose estimate is below this are dropped: over six standard errors under 0.75.
FLOOR = 0.5
#: The finer sketch: one-bit minima, and a floor 4.8 standard errors under 0.75.
FINE = 2048
FINE_FLOOR = 0.68
_U = np.uint64
_MINIMA = BANDS * ROWS
_FACTORS = ((mix64(np.arange(1, _MINIMA + 1, dtype=np.uint64)) >> _U(32)).astype(np.uint32) | np.uint32(1))
_LONGS = _MINIMA * BITS // 64
_FINE_FACTORS = ((mix64(np.arange(10_001, 10_001 + FINE, dtype=np.uint64)) >> _U(32)).astype(np.uint32) | np.uint32(1))


def shingle_sets(col):
    """For each row of a text column: the sorted distinct shingle hashes."""
    data, offsets = text_buffers(col)
    for i, j in passes(offsets):
        a, z = offsets[i], offsets[j]
        h, row = hashed_words(data[a:z], offsets[i:j + 1] - a)
        counts = np.bincount(row, minlength=j - i)
        first = np.concatenate([[0], np.cumsum(counts)])
        mixed = None
        if len(h) >= SHINGLE:
            n = len(h) - SHINGLE + 1
            mixed = np.zeros(n, np.uint64)
            for k in range(SHINGLE):
                mixed = mixed * _U(0xC2B2AE3D27D4EB4F) + h[k:k + n]
            mixed = mix64(mixed + _U(SHINGLE))
        for r in range(j - i):
            c = int(counts[r])
            if c == 0:
                yield np.zeros(0, np.uint64)
            elif c < SHINGLE:                   # the whole sequence as one
                x = _U(0)
                for k in range(first[r], first[r + 1]):
                    x = mix64(np.array([x], np.uint64) * _U(0xC2B2AE3D27D4EB4F) + h[k])[0]
                yield mix64(np.array([x + _U(c)], np.uint64))
            else:
                s = np.sort(mixed[first[r]:first[r + 1] - SHINGLE + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]


def minima(s: np.ndarray, factors: np.ndarray = _FACTORS) -> np.ndarray:
    """The least value of each hash function over a set."""
    x = (s >> _U(32)).astype(np.uint32)
    out = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for a in range(0, len(x), 512):
        np.minimum(out, (factors[:, None] * x[None, a:a + 512]).min(axis=1), out=out)
    return out


def _bands(m: np.ndarray) -> np.ndarray:
    m = m.astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix64(key * _U(0x9E3779B97F4A7C15) + m[:, k])
    return key.view(np.int64)


def pack(m: np.ndarray) -> np.ndarray:
    """The low bits of each (mixed) minimum, packed into longs."""
    low = (mix64(m.astype(np.uint64)) & _U((1 << BITS) - 1)).reshape(_LONGS, 64 // BITS)
    return (low << (np.arange(64 // BITS, dtype=np.uint64) * _U(BITS))).sum(axis=1, dtype=np.uint64).view(np.int64)


def fine_sketch(s: np.ndarray) -> np.ndarray:
    """One bit of each of the finer minima, packed into longs."""
    low = (mix64(minima(s, _FINE_FACTORS).astype(np.uint64)) & _U(1)).reshape(FINE // 64, 64)
    return (low << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


def fine_estimate(a: str, b: str) -> Column:
    """Similarity of two finer sketches: twice the share of equal bits, less one."""
    differ = None
    for k in range(FINE // 64):
        x = F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k]))
        differ = x if differ is None else differ + x
    return F.lit(1.0) - differ * F.lit(2.0 / FINE)


def estimate(a: str, b: str) -> Column:
    """Similarity of two packed signatures: the share of equal two-bit values,
    less the quarter that agrees by chance."""
    differ = None
    for k in range(_LONGS):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = F.bit_count(x) if differ is None else differ + F.bit_count(x)
    chance = 1.0 / (1 << BITS)
    return ((F.lit(1.0) - differ / F.lit(float(_MINIMA))) - chance) / (1.0 - chance)


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_hash, n, node, sig, bands`` per row; node names the shingle set."""
    def run(batches):
        for b in batches:
            n, node, sig, bands = [], [], [], []
            for s in shingle_sets(b.column(2)):
                n.append(len(s))
                if not len(s):
                    node.append(None)
                    sig.append(None)
                    bands.append(None)
                    continue
                m = minima(s)
                node.append(xxhash.xxh3_128_digest(s.tobytes()))
                sig.append(pack(m))
                bands.append(_bands(m))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(node, pa.binary()),
                                              pa.array(sig, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                                             ["doc_id", "text_hash", "n", "node", "sig", "bands"])
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), text_col), run,
                     "doc_id long, text_hash long, n long, node binary, sig array<long>, bands array<long>")


def _plausible(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs (a, b) that sizes and signatures allow to be links."""
    side = lambda c: facts.select(F.col("node").alias(c), F.col("n").alias("n_" + c), F.col("sig").alias("s_" + c))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where((100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
                      & (estimate("s_a", "s_b") >= FLOOR)).select("a", "b")


def _texts_of(nodes: DataFrame, reps: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, text``: the text of one document of each class asked for. Rows
    that repeat an id are told apart by the hash of their text."""
    asked = nodes.join(reps, "node")
    raw = docs.select(F.col(id_col).cast("long").alias("rep"), F.xxhash64(text_col).alias("rep_hash"), F.col(text_col).alias("text"))
    found = raw.join(asked, raw["rep"].eqNullSafe(asked["rep"]) & (raw["rep_hash"] == asked["rep_hash"]))
    return found.select("node", "text").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar enough. Rows come sorted
    by their first class, whose set is made once."""
    joined = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("t_b")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("t_a")), "a").select("a", "b", "t_a", "t_b")

    def run(batches):
        last, own = None, None
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for k, s in enumerate(shingle_sets(batch.column(3))):
                a = batch.column(0)[k].as_py()
                if a != last:
                    last, own = a, next(shingle_sets(batch.column(2).slice(k, 1)))
                small, large = (s, own) if len(s) < len(own) else (own, s)
                both = 0
                if len(small):
                    at = np.searchsorted(large, small)
                    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                keep[k] = both > 0 and 100 * both >= PERCENT * (len(s) + len(own) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))
    return map_arrow(joined, run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the least node reachable, for every node of a link.

    Large-star and small-star steps in turn: each keeps connectivity and pulls
    nodes toward the least neighbour; a few rounds end in stars. Each round is
    written out, so no lineage grows. A node's neighbours are never gathered:
    only their minimum is (with partial aggregation).
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "near-edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = materialize(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "near-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _across(rest: DataFrame, reps: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Pairs (a, b) of different components in the open buckets ``rest`` (key,
    band, node, root) that the shared-shingle bound and the finer sketch let pass."""
    nodes = rest.select("node", "root").distinct()

    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column(1)))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)),
                                             pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array([fine_sketch(x) for x in sets], pa.list_(pa.int64()))],
                                             ["node", "shingles", "fine"])
    texts = _texts_of(nodes.select("node"), reps, docs, id_col, text_col)
    made = materialize(map_arrow(texts, run, "node binary, shingles array<long>, fine array<long>").join(nodes, "node"), "near-fine")
    each = made.select(F.xxhash64("node").alias("at"), F.xxhash64("root").alias("r"), F.explode("shingles").alias("h"))
    crossing = each.groupBy("h").agg(F.min("r").alias("r1"), F.max("r").alias("r2")).where("r1 <> r2").select("h")
    shared = each.select("at", "h").join(crossing, "h", "left_semi").groupBy("at").agg(F.count(F.lit(1)).alias("r"))
    able = made.select("node", "root", F.size("shingles").cast("long").alias("n"), "fine", F.xxhash64("node").alias("at")).join(
        shared, "at").where(F.lit(100) * F.col("r") >= PERCENT * F.col("n")).drop("at")
    able = materialize(able.join(classes.select("node", "bands"), "node"), "near-able")
    entry = rest.select("key", "band", "node").join(able, "node").withColumn(
        "earlier", F.slice("bands", F.lit(1), F.col("band"))).drop("bands")
    side = lambda x: entry.select(F.col("key").alias("key_" + x), *[F.col(c).alias(f"{c}_{x}")
                                                                     for c in ("node", "root", "n", "r", "fine", "earlier")])
    links_need = F.least("r_a", "r_b") * (100 + PERCENT) >= PERCENT * (F.col("n_a") + F.col("n_b"))
    fits = ((F.col("key_a") == F.col("key_b")) & (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b"))
            & (100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")) & links_need
            & (fine_estimate("fine_a", "fine_b") >= FINE_FLOOR) & ~F.arrays_overlap("earlier_a", "earlier_b"))
    return side("a").join(side("b"), fits).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def _open_buckets(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, band, node, k, root`` of the buckets that still hold several components."""
    rooted = members.select("key", "band", "node", "k").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = rooted.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("key")
    return materialize(rooted.join(open_, "key", "left_semi"), "near-rest")


def _central_pairs(rest: DataFrame, facts: DataFrame) -> DataFrame:
    """Plausible pairs (a, b) of each open bucket's central member, the one that
    meets most others over all its buckets, with the members of other
    components. Of a family of edited copies the copy nearest to all others is
    central, so one linear round joins most families before any pairwise step."""
    meets = rest.groupBy("node").agg(F.sum("k").alias("meets"))
    hub = rest.join(meets, "node").groupBy("key").agg(F.max(F.struct("meets", "node", "root")).alias("hub"))
    met = rest.join(hub, "key").where(F.col("root") != F.col("hub.root"))
    return _plausible(met.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct(), facts)


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """(rows: doc_id, text_hash, n, node; roots: node, root) of a table."""
    signed = materialize(_signed(docs, id_col, text_col), "near-signed")
    # one row per shingle set; copies are folded before they are shuffled
    classes = materialize(signed.where("n > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("r"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")),
        "near-classes")
    facts = classes.select("node", "n", "sig")
    buckets = classes.select("node", F.posexplode("bands").alias("band", "key")).select(
        "node", "band", F.xxhash64("band", "key").alias("key"))
    shared = materialize(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("lo"),
                                                    F.max("node").alias("hi")).where("k > 1"), "near-buckets")
    members = materialize(buckets.join(shared, "key"), "near-members")
    hubs = members.select(F.explode(F.array("lo", "hi")).alias("a"), F.col("node").alias("b"))
    pairs = _plausible(hubs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), facts)
    pairs = materialize(pairs, "near-pairs")
    reps = classes.select("node", F.col("r.doc_id").alias("rep"), F.col("r.text_hash").alias("rep_hash"))
    ends = lambda p: p.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = materialize(_texts_of(ends(pairs), reps, docs, id_col, text_col), "near-texts")
    links = materialize(_confirmed(pairs, texts), "near-links")
    roots = components(links)
    rest = _open_buckets(members, roots)
    central = materialize(_central_pairs(rest, facts).join(pairs, ["a", "b"], "left_anti"), "near-central")
    if not central.isEmpty():
        texts = materialize(_texts_of(ends(central), reps, docs, id_col, text_col), "near-texts")
        links = materialize(links.unionByName(_confirmed(central, texts)), "near-links")
        pairs = pairs.unionByName(central)
        roots = components(links)
        rest = _open_buckets(members, roots)
    more = materialize(_across(rest, reps, classes, docs, id_col, text_col).join(pairs, ["a", "b"], "left_anti"), "near-more")
    if more.isEmpty():
        return signed.select("doc_id", "text_hash", "n", "node"), roots
    texts = materialize(_texts_of(ends(more), reps, docs, id_col, text_col), "near-texts")
    links = links.unionByName(_confirmed(more, texts))
    return signed.select("doc_id", "text_hash", "n", "node"), components(links)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row.

    Two texts are linked when the Jaccard similarity of their sets of 5-word
    shingles (lower-cased A-Z; a shorter text is one shingle) is at least
    0.75. ``component_id`` is the smallest id reachable over links, ``kept``
    whether it is the row's own. Null, empty and blank texts have no shingles
    and stand alone. Rows repeating id and text are both kept if the id wins;
    null ids lose to any other. An empty table gives an empty result.
    """
    rows, roots = near_classes(docs, id_col, text_col)
    rows = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = materialize(rows, "near-rows")
    ids = rows.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("least"))
    # a component of any size is joined in slices: one row per (component, slice)
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    salted = rows.withColumn("salt", salt)
    slices = salted.where(F.col("root").isNotNull()).select("root", "salt").distinct().join(ids, "root")
    out = salted.join(slices, ["root", "salt"], "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.col("doc_id").eqNullSafe(component)).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, columns untouched: one row per component,
    that of the smallest id (null ids lose to any other), then of the smallest
    text hash. Rows are told apart by id and text. Texts without shingles all stay."""
    i0, h0, i1, h1 = free_names(docs, "_row_id", "_row_hash", "_other_id", "_other_hash")
    rows, roots = near_classes(docs, id_col, text_col)
    rows = rows.where(F.col("node").isNotNull()).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    each = materialize(rows.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("c")), "near-rows")
    best = each.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("best"))
    # as in near_duplicates, a component of any size is joined in slices
    salted = each.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(64)))
    slices = salted.select("root", "salt").distinct().join(best, "root")
    won = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    other = materialize(salted.join(slices, ["root", "salt"]).withColumn("won", won).where("not won or c > 1").select(
        F.col("doc_id").alias(i1), F.col("text_hash").alias(h1), "won"), "near-other")
    keyed = docs.withColumns({i0: F.col(id_col).cast("long"), h0: F.xxhash64(text_col)})
    same = F.col(i0).eqNullSafe(F.col(i1)) & (F.col(h0) == F.col(h1))
    stay = keyed.join(other.drop("won"), same, "left_anti")
    repeated = keyed.join(other.where("won").drop("won"), same, "left_semi").dropDuplicates([i0, h0])
    return stay.unionByName(repeated).drop(i0, h0)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


QUERIES = {"op2_near_dedup": op2_near_dedup}
SQL = {"op2_near_dedup": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0),
e AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS h FROM i),
n AS (SELECT d.doc_id, count(e.h) AS n FROM d LEFT JOIN e ON d.doc_id = e.doc_id GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM e x JOIN e y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
k AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT k.b, r.root FROM r JOIN k ON r.doc_id = k.a WHERE r.root < k.b)
SELECT r.doc_id, any_value(n.n) AS n_shingles, min(root) AS component_id, r.doc_id = min(root) AS kept
FROM r JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""}
