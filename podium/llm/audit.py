"""Filter interaction audit: what each order of five filters removes, per part.

Filters A to D look at one text; E asks whether a smaller id holds the same
text. Equal texts meet in radix tries:

1. Each task inserts its whole texts into a compressed trie. A terminal holds,
   per (part, quality, toxic), the number of rows, the least id and the number
   of rows with it. A full trie (``TRIE_BYTES``) is written out as one row per
   text, so a group of copies leaves a task as a few rows.
2. The rows are dealt by ranges of adaptive prefixes: the first bytes, where
   many texts share them the next bytes, where those are shared too the text's
   hash. Bounds come from Spark's bounded sample, their number from measured
   bytes. Equal texts fall into one range, and no shared prefix is a hot one.
3. Each range inserts its rows into a trie; a traversal sets the duplicate flag
   against the terminal's least id and reduces rows to counts per
   (part, mask, quality, toxic), at most 128 per part and range.

The 120 orders are read from the 32 mask counts of a part.
"""
from __future__ import annotations

from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.views import table
from .common import documents, map_arrow, materialize

FILTERS = "ABCDE"
#: Bytes of distinct text (and of what a terminal costs) that one trie holds.
TRIE_BYTES = 32 << 20
_TERMINAL_BYTES = 512
#: Labels up to so many ids are sent to every task (about 20 bytes each), more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
_HEAD, _NEXT = 16, 48

_NOT_LETTERS = bytes(c for c in range(256) if not 65 <= c <= 90)
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#$%&*|"


def mask_of(text: bytes) -> int:
    """Bits 0 to 3: the text fails A, B, C, D."""
    words = text.split()                        # bytes split at the six ASCII blanks
    return ((len(words) < 50)
            | (100 * len(set(words)) < 65 * len(words)) << 1
            | (100 * len(text.translate(None, _NOT_LETTERS)) > 5 * len(text.translate(None, _CONTINUATION))) << 2
            | (len(text.translate(None, _SYMBOLS)) < len(text)) << 3)


def _shared(a: bytes, i: int, b: bytes, j: int, most: int) -> int:
    """Length of the common prefix of a[i:i+most] and b[j:j+most]."""
    if a[i:i + most] == b[j:j + most]:
        return most
    low, high = 0, most                         # equal up to low, different within high
    while high - low > 1:
        mid = (low + high) // 2
        if a[i + low:i + mid] == b[j + low:j + mid]:
            low = mid
        else:
            high = mid
    return low


class Trie:
    """Compressed trie over whole byte strings. A node is
    ``[text, start, end, children, groups]``: its edge is text[start:end]."""

    def __init__(self):
        self.root = [b"", 0, 0, {}, None]
        self.size = 0

    def groups(self, text: bytes) -> dict:
        """The groups of the text's terminal, which is made if it is new."""
        node, at, n = self.root, 0, len(text)
        while at < n:
            child = node[3].get(text[at])
            if child is None:
                child = [text, at, n, {}, None]
                node[3][text[at]] = child
                self.size += n - at + _TERMINAL_BYTES
                node, at = child, n
                break
            length = child[2] - child[1]
            same = _shared(child[0], child[1], text, at, min(length, n - at))
            if same < length:                   # the edge splits
                middle = [child[0], child[1], child[1] + same, {child[0][child[1] + same]: child}, None]
                child[1] += same
                node[3][text[at]] = middle
                self.size += _TERMINAL_BYTES
                child = middle
            node, at = child, at + same
        if node[4] is None:
            node[4] = {}
            if self.root is node:
                self.size += _TERMINAL_BYTES
        return node[4]

    def terminals(self):
        """(text, groups) of every text. Edges refer to whole texts, so what
        leads from the root to a node is its edge's text up to the edge's end."""
        stack = [self.root]
        while stack:
            text, _, end, children, groups = stack.pop()
            if groups is not None:
                yield text[:end], groups
            stack.extend(children.values())


def _add(groups: dict, key: tuple, rows: int, least, at_least: int) -> None:
    """Adds rows of a group; ``least`` None means that all its ids are null,
    and then ``at_least`` counts all rows."""
    have = groups.get(key)
    if have is None:
        groups[key] = (rows, least, at_least)
        return
    n, low, n_low = have
    if least == low:
        groups[key] = (n + rows, low, n_low + at_least)
    elif low is None or (least is not None and least < low):
        groups[key] = (n + rows, least, at_least)
    else:
        groups[key] = (n + rows, low, n_low)


_GROUP = pa.list_(pa.struct([("part", pa.string()), ("quality", pa.bool_()), ("toxic", pa.bool_()), ("rows", pa.int64()),
                             ("least", pa.int64()), ("at_least", pa.int64())]))


def _tries(batches):
    """One row per text and trie: ``text, groups``."""
    def rows(trie):
        texts, groups, size = [], [], 0
        for text, found in trie.terminals():
            texts.append(text)
            groups.append([(*key, *value) for key, value in found.items()])
            size += len(text)
            if size > 4 << 20 or len(texts) == 4096:
                yield batch(texts, groups)
                texts, groups, size = [], [], 0
        if texts:
            yield batch(texts, groups)

    def batch(texts, groups):
        as_dicts = [[dict(zip(("part", "quality", "toxic", "rows", "least", "at_least"), g)) for g in gs] for gs in groups]
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(as_dicts, _GROUP)], ["text", "groups"])

    trie = Trie()
    for b in batches:
        for text, least, part, quality, toxic in zip(*(c.to_pylist() for c in b.columns)):
            _add(trie.groups(text), (part, quality, toxic), 1, least, 1)
            if trie.size > TRIE_BYTES:
                yield from rows(trie)
                trie = Trie()
    yield from rows(trie)


def _reduced(batches):
    """Flags from one range's trie, reduced to counts."""
    trie, counts = Trie(), {}
    for b in batches:
        for text, groups in zip(*(c.to_pylist() for c in b.columns)):
            held = trie.groups(text)
            for g in groups:
                _add(held, (g["part"], g["quality"], g["toxic"]), g["rows"], g["least"], g["at_least"])
    for text, groups in trie.terminals():
        mask = mask_of(text)
        known = [low for _, low, _ in groups.values() if low is not None]
        least = min(known) if known else None
        for (part, quality, toxic), (n, low, n_low) in groups.items():
            first = n_low if low == least else 0
            for bits, rows in ((mask, first), (mask | 16, n - first)):
                if rows:
                    key = part, bits, quality, toxic
                    counts[key] = counts.get(key, 0) + rows
    if counts:
        keys = list(zip(*counts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.int32()), pa.array(keys[2], pa.bool_()),
             pa.array(keys[3], pa.bool_()), pa.array(list(counts.values()), pa.int64())],
            ["part", "mask", "quality", "toxic", "rows"])


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``text, id, part, quality, toxic``; of repeated label rows the largest values count."""
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("label_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("quality"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    known = materialize(known, "audit-labels")
    flags = lambda df: df.select("text", "id", "part", F.coalesce("quality", F.lit(False)).alias("quality"),
                                 F.coalesce("toxic", F.lit(False)).alias("toxic"))
    same = F.col("id") == F.col("label_id")
    if known.count() <= BROADCAST_LABELS:
        return flags(rows.join(F.broadcast(known), same, "left"))
    none = F.lit(None).cast("boolean")          # rows without an id need no join and would meet in one task
    return flags(rows.where(F.col("id").isNotNull()).join(known, same, "left")).unionByName(
        flags(rows.where(F.col("id").isNull()).withColumns({"quality": none, "toxic": none})))


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "source") -> DataFrame:
    """``part, mask, rows, good, toxic``: documents per part and set of failed
    filters (bit 0 is A), those labelled good and those labelled toxic."""
    texts = materialize(map_arrow(_labelled(docs, labels, id_col, text_col, part_col), _tries,
                                  "text binary, groups array<struct<part:string,quality:boolean,toxic:boolean,"
                                  "rows:bigint,least:bigint,at_least:bigint>>"), "audit-tries")
    total = texts.agg(F.sum(F.octet_length("text") + F.lit(_TERMINAL_BYTES))).first()[0] or 0
    ranges = max(1, -(-total // TRIE_BYTES))
    dealt = texts.repartitionByRange(ranges, F.substring("text", 1, _HEAD), F.substring("text", _HEAD + 1, _NEXT),
                                     F.xxhash64("text"))
    reduced = map_arrow(dealt, _reduced, "part string, mask int, quality boolean, toxic boolean, rows long")
    n = F.col("rows")
    return reduced.groupBy("part", "mask").agg(F.sum(n).alias("rows"), F.sum(F.when(F.col("quality"), n).otherwise(0)).alias("good"),
                                               F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step: ``part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``.

    Null texts count as empty, null parts as the empty part. A null id is
    smaller than none: a text held by known ids flags its null rows, and rows
    with null ids only flag nothing. Rows that repeat the least id of a text
    are not flagged. Rows of ids without label count as neither good nor
    toxic. An empty table gives an empty result. Other columns are not read.
    The parts of one text are held with its terminal, so they, not its copies,
    cost memory.
    """
    counts = mask_counts(docs, labels, id_col, text_col, part_col)
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "rows", "good", "toxic")).alias("masks"))    # 32 at most
    orders = "|".join("".join(o) for o in permutations(FILTERS))
    steps = parts.withColumn("filter_order", F.explode(F.split(F.lit(orders), r"\|"))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = lambda c: F.call_function("shiftleft", F.lit(1), F.ascii(c) - ord("A"))
    steps = steps.withColumns({
        "own": bit(F.substring("filter_order", F.col("step"), F.lit(1))),
        "before": F.aggregate(F.slice(F.split("filter_order", ""), F.lit(1), F.col("step") - 1), F.lit(0), lambda a, c: a + bit(c))})

    def total(column: str, weight) -> Column:
        """Sum over the masks of count x weight(mask, own, before)."""
        return F.aggregate("masks", F.lit(0).cast("long"), lambda a, m: a + m[column] * weight(
            m["mask"], F.col("own"), F.col("before")).cast("long"))

    met = lambda m, bits: m.bitwiseAND(bits) != 0
    here = lambda m, own, before: met(m, own) & ~met(m, before)
    # of 120 orders a document with k failed filters goes to each of them in 120 / k
    share = lambda m, own, before: F.when(met(m, own), F.lit(120) / F.bit_count(m)).otherwise(0)
    return steps.select(
        "part", "filter_order", "step",
        total("rows", lambda m, own, before: ~met(m, own.bitwiseOR(before))).alias("kept"),
        total("rows", here).alias("removed"),
        total("rows", lambda m, own, before: met(m, own) & met(m, before)).alias("redundant"),
        total("rows", lambda m, own, before: m == own).alias("unique_fails"),
        total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"),
        total("rows", share).alias("shapley"))


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


SQL = {"op12_audit": r"""
WITH l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY 1),
     t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                  CAST(len(w) < 50 AS INT) AS a, CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INT) AS b,
                  CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS INT) AS c,
                  CAST(regexp_matches(t, '[#$%&*|]') AS INT) AS d,
                  CAST(t.doc_id > min(t.doc_id) OVER (PARTITION BY t) AS INT) AS e
           FROM t LEFT JOIN l USING (doc_id)),
     m AS (SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n, count(*) FILTER (good) AS g,
                  count(*) FILTER (toxic) AS x FROM f GROUP BY ALL),
     x5 AS (SELECT unnest([0, 1, 2, 3, 4]) AS i),
     o AS (SELECT p.i AS i1, q.i AS i2, r.i AS i3, s.i AS i4, u.i AS i5 FROM x5 p, x5 q, x5 r, x5 s, x5 u
           WHERE p.i <> q.i AND r.i NOT IN (p.i, q.i) AND s.i NOT IN (p.i, q.i, r.i) AND u.i NOT IN (p.i, q.i, r.i, s.i)),
     k AS (SELECT substr('ABCDE', i1 + 1, 1) || substr('ABCDE', i2 + 1, 1) || substr('ABCDE', i3 + 1, 1)
                  || substr('ABCDE', i4 + 1, 1) || substr('ABCDE', i5 + 1, 1) AS filter_order, [i1, i2, i3, i4, i5] AS fs FROM o),
     s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step, fs FROM k),
     b AS (SELECT filter_order, step, 1 << fs[step] AS own,
                  CAST(coalesce(list_sum(list_transform(fs[1 : step - 1], lambda i: 1 << i)), 0) AS INT) AS before FROM s)
SELECT part, filter_order, step,
       CAST(sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN mask & own > 0 AND mask & before > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN g ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN x ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN mask & own > 0 THEN n * (120 // bit_count(mask)) ELSE 0 END) AS BIGINT) AS shapley
FROM m, b GROUP BY part, filter_order, step"""}
QUERIES = {"op12_audit": op12_audit}
