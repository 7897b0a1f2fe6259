"""Personal data: pattern spans, and terms that give away a protected value.

The base finds emails, IP addresses, card and phone numbers by pattern. The
method adds what the patterns cannot see: a term in the texts that hold a
protected value discloses it to the degree of their pointwise mutual information,
PMI(t; e) = log2(p(t, e) / (p(t) p(e))), estimated from counts of different texts
over the whole corpus. A term goes when PMI exceeds ``alpha`` times the information
content -log2 p(e) of the value. Only values found in at least ``support``
different texts give an estimate; single sightings are the patterns' work.
A disclosing term is marked wherever it stands, in every document.

``sanitised`` gives the texts with values replaced by their kind and
disclosing terms removed (or generalised to ``[TERM]``).
"""
from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_arrow, materialize

KINDS = ("email", "ip", "card", "phone")
#: Share of a value's information content that a term may give away.
ALPHA = 0.8
#: Different texts that must hold a value, and value and term together.
SUPPORT = 3
#: Words whose hash a task remembers.
WORDS_KEPT = 200_000
#: Pairs that a task sums up before it sends them on.
PAIRS_KEPT = 200_000
#: Bits of the sieve that picks the words worth a join.
SIEVE = 1 << 23

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile("[0-9]")
# Starting only where no digit stands before, and never giving digits back, keeps long runs linear.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^ \t-\r]+")


def _emails(text: str):
    """The leftmost non-overlapping matches, found from each @ outward."""
    done, at = 0, text.find("@")
    while at >= 0:
        i = at
        while i > done and text[i - 1] in _LOCAL:
            i -= 1
        m = _DOMAIN.match(text, at + 1) if i < at else None
        if m:
            yield i, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start, then kind as listed."""
    out = [(s, e, 0) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(int(p.lstrip("0") or "0") <= 255 if len(p.lstrip("0")) <= 3 else False for p in m.groups()):
                out.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), m.end(), 3))
    out.sort(key=lambda s: (s[0], s[2]))
    return [(s, e, KINDS[k]) for s, e, k in out]


def _entity(kind: str, value: str) -> str:
    """The same value however it is written: digits for numbers, lower case for mail."""
    plain = value.lower() if kind == "email" else re.sub(r"[^0-9.]" if kind == "ip" else "[^0-9]", "", value)
    return f"{kind}:{hashlib.sha256(plain.encode()).hexdigest()[:24]}"


def _values(spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The parts of a text that values take, in order and disjoint."""
    out: list[tuple[int, int]] = []
    for s, e, _ in spans:
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _terms(text: str, spans):
    """(word, start, end) of the words outside the values, without the signs around them."""
    taken, k = _values(spans), 0
    for m in _WORD.finditer(text):
        a, b = _trimmed(text, *m.span())
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if a < b and not (k < len(taken) and taken[k][0] < b):
            yield text[a:b], a, b


def _entities(docs: DataFrame, text_col: str) -> DataFrame:
    """``text_hash, entities`` per row: its different values."""
    def run(batches):
        for b in batches:
            out = [list(dict.fromkeys(_entity(k, t[s:e]) for s, e, k in base_spans(t))) if t else [] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))], ["text_hash", "entities"])
    return map_arrow(docs.select(_text_hash(text_col).alias("text_hash"), text_col), run, "text_hash long, entities array<string>")


_FOUND = ("row long, doc_id long, base string, sha string, n_email long, n_ip long, n_card long, n_phone long, "
          "hits array<struct<h:long,s:int,e:int>>")


def _scan(docs: DataFrame, id_col: str, text_col: str, sieve: bytes, with_text: bool = False) -> DataFrame:
    """Base spans per row, and ``hits``: its words that the sieve lets pass;
    ``with_text`` carries the text beside them."""
    hit_type = pa.list_(pa.struct([("h", pa.int64()), ("s", pa.int32()), ("e", pa.int32())]))

    def run(batches):
        hashes = _Hashes(sieve)
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for t in b.column(2).to_pylist():
                t = t or ""
                spans = base_spans(t)
                base = ",".join(f"{k}:{s}:{e}" for s, e, k in spans)
                hits = []
                if any(hashes[w] is not None for w in set(_WORD.findall(t))):
                    hits = [{"h": h, "s": s, "e": e} for w, s, e in _terms(t, spans) if (h := hashes[w]) is not None]
                kinds = [k for _, _, k in spans]
                for c, v in zip(cols, (base, hashlib.sha256(base.encode()).hexdigest(), *(kinds.count(k) for k in KINDS), hits), strict=True):
                    c.append(v)
            types = [pa.string(), pa.string(), *[pa.int64()] * 4, hit_type]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(cols, types, strict=True)), *b.columns[2:2 + with_text]],
                ["row", "doc_id", "base", "sha", "n_email", "n_ip", "n_card", "n_phone", "hits", *["text"] * with_text])
    return map_arrow(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                                 F.col(text_col).alias("_t")), run, _FOUND + (", text string" if with_text else ""))


def _text_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(_text_hash(text_col).alias("text_hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _passes(h: np.ndarray, sieve: bytes) -> np.ndarray:
    slot = h & (SIEVE - 1)
    return (np.frombuffer(sieve, np.uint8)[slot >> 3] >> (slot & 7)) & 1 == 1


def _sifted(keyed: DataFrame, sieve: bytes) -> DataFrame:
    """The texts whose hash passes the sieve, so that only these are shuffled."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_passes(b.column(0).to_numpy(), sieve)))
    return map_arrow(keyed, run, "text_hash long, text string")


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """``a, b`` without the signs around the word text[a:b]."""
    while a < b and not text[a].isalnum():
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return a, b


def term_hash(term: str) -> int:
    """Spark's ``xxhash64`` of the whole term."""
    h = xxhash.xxh64_intdigest(term.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def sieve_of(hashes: DataFrame) -> bytes:
    """One bit per hash ``h``, of a size that does not grow with their number.
    It lets some others pass; what passes is joined on the hash itself."""
    slot = F.col("h").bitwiseAND(F.lit(SIEVE - 1))
    rows = hashes.select(F.shiftright(slot, 6).cast("int").alias("w"), slot.bitwiseAND(F.lit(63)).cast("int").alias("s")).groupBy("w").agg(
        F.bit_or(F.expr("shiftleft(1L, s)")).alias("bits"))
    out = np.zeros(SIEVE // 64, np.int64)
    for w, bits in rows.collect():
        out[w] = bits
    return out.tobytes()


class _Hashes(dict):
    """Hash of the term that a word holds, made once per word (None: only
    signs, or stopped by the sieve)."""

    def __init__(self, sieve: bytes | None = None):
        self.sieve = sieve

    def __missing__(self, word: str):
        a, b = _trimmed(word, 0, len(word))
        h = term_hash(word[a:b].lower()) if a < b else None
        if h is not None and self.sieve and not self.sieve[(h & (SIEVE - 1)) >> 3] >> (h & 7) & 1:
            h = None
        if len(word) <= 64:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = h
        return h


def _counted(texts: DataFrame, skip: bytes | None = None) -> DataFrame:
    """``h, c``: for each batch of texts (text_hash, text), one row per distinct
    term with the number of texts that hold it. Texts that pass ``skip`` are left out."""
    def run(batches):
        hashes = _Hashes()
        for b in batches:
            if skip is not None:
                b = b.filter(pa.array(~_passes(b.column(0).to_numpy(), skip)))
            seen: Counter = Counter()
            for t in b.column(1).to_pylist():
                seen.update({hashes[w] for w in set(_WORD.findall(t))})
            seen.pop(None, None)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["h", "c"])
    return map_arrow(texts.select("text_hash", "text"), run, "h long, c long")


def term_counts(keyed: DataFrame, sizes: DataFrame) -> DataFrame:
    """``h, df``: in how many different texts each term occurs, by hash of the
    term (cut, trimmed and lower-cased as in ``_together``). Texts that may have
    copies, by ``sizes`` (text_hash, c), are folded first; all others are
    counted where they lie."""
    copied = sieve_of(sizes.where("c > 1").select(F.col("text_hash").alias("h")))
    folded = _sifted(keyed, copied).dropDuplicates(["text_hash"])
    return _counted(keyed, copied).unionByName(_counted(folded)).groupBy("h").agg(F.sum("c").alias("df"))


def _together(texts: DataFrame) -> DataFrame:
    """``entity, term, dte``: in how many texts (text, entities) value and term
    stand together, wherever in the text. Each batch sends one row per pair, or
    a few when the pairs are many."""
    def rows(sums):
        return pa.RecordBatch.from_arrays([pa.array([e for e, _ in sums], pa.string()), pa.array([t for _, t in sums], pa.string()),
                                           pa.array(list(sums.values()), pa.int64())], ["entity", "term", "c"])

    def run(batches):
        for b in batches:
            sums: Counter = Counter()
            for t, entities in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                terms = {w.lower() for w, _, _ in _terms(t, base_spans(t))}
                for e in entities:
                    sums.update((e, x) for x in terms)
                    if len(sums) >= PAIRS_KEPT:
                        yield rows(sums)
                        sums = Counter()
            yield rows(sums)
    return map_arrow(texts.select("text", "entities"), run, "entity string, term string, c long").groupBy("entity", "term").agg(
        F.sum("c").alias("dte"))


def disclosing_terms(found: DataFrame, docs: DataFrame, text_col: str = "text", alpha: float = ALPHA,
                     support: int = SUPPORT) -> DataFrame:
    """``entity, term, pmi, ic``: the terms that give a value away, of all words
    of the texts that hold it. All counts are over different texts, so copies
    change nothing. ``found``: text_hash and entities of each row of ``docs``."""
    keyed = _keyed(docs, text_col)
    sizes = materialize(found.groupBy("text_hash").agg(F.count(F.lit(1)).alias("c")), "privacy-texts")
    seen = found.select("text_hash", F.explode("entities").alias("entity")).distinct()      # copies of a text are one sighting
    values = materialize(seen.groupBy("entity").agg(F.count(F.lit(1)).alias("de")).where(F.col("de") >= support), "privacy-values")
    held = materialize(seen.join(values, "entity", "left_semi").groupBy("text_hash").agg(
        F.collect_list("entity").alias("entities")), "privacy-held")
    sifted = _sifted(keyed, sieve_of(held.select(F.col("text_hash").alias("h")))).dropDuplicates(["text_hash"])
    holders = sifted.join(held, "text_hash")
    both = _together(holders).where(F.col("dte") >= support).join(values, "entity").withColumn("h", F.xxhash64("term"))
    both = materialize(both, "privacy-pairs")
    counts = term_counts(keyed, sizes)
    total = sizes.agg(F.count(F.lit(1)).alias("n"))             # one row
    scored = both.join(counts, "h").crossJoin(F.broadcast(total))
    n, pmi = F.col("n").cast("double"), None
    pmi = F.log2(F.col("dte") * n / (F.greatest(F.col("df"), F.col("dte")) * F.col("de")))
    ic = F.log2(n / F.least(F.col("de").cast("double"), n))
    return scored.select("entity", "term", pmi.alias("pmi"), ic.alias("ic")).where(
        (F.col("ic") > 0) & (F.col("pmi") > F.lit(alpha) * F.col("ic")))


def _all_spans(docs: DataFrame, id_col: str, text_col: str, alpha: float, support: int, with_text: bool) -> DataFrame:
    """The scan of every row, with ``added``: the places of its disclosing terms."""
    terms = disclosing_terms(materialize(_entities(docs, text_col), "privacy-entities"), docs, text_col, alpha, support)
    terms = materialize(terms.select(F.xxhash64("term").alias("h")).distinct(), "privacy-terms")
    found = materialize(_scan(docs, id_col, text_col, sieve_of(terms), with_text), "privacy-found")
    added = found.where(F.size("hits") > 0).select("row", F.explode("hits").alias("x")).select(
        "row", "x.h", "x.s", "x.e").join(terms, "h", "left_semi")
    added = added.select("row", "s", "e").distinct().groupBy("row").agg(
        F.collect_list(F.struct("s", "e")).alias("added"))
    return found.drop("hits").join(added, "row", "left")


def _joined(base: str | None, added: list | None) -> str:
    """All spans of a row, ``kind:start:end`` by start, then kind."""
    spans = [(int(s), KINDS.index(k), int(e)) for k, s, e in (p.split(":") for p in base.split(","))] if base else []
    spans += [(t["s"], len(KINDS), t["e"]) for t in added or []]
    return ",".join(f"{(*KINDS, 'term')[k]}:{s}:{e}" for s, k, e in sorted(spans))


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
                  support: int = SUPPORT) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` per row:
    counts and digest of the base spans, and all spans (base, and every
    occurrence of a disclosing term as kind ``term``), each ``kind:start:end`` in code points.

    Null and empty texts have no spans (the digest of the empty string). Rows
    repeating an id are each scanned on their own. An empty table gives an
    empty result. Long texts are scanned whole, in linear time.
    """
    joined = _all_spans(docs, id_col, text_col, alpha, support, False)

    def run(batches):
        for b in batches:
            out = [_joined(x, y) for x, y in zip(b.column(6).to_pylist(), b.column(7).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(6)), pa.array(out, pa.string())],
                                             ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
    return map_arrow(joined.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.col("sha").alias("base_sha256"),
                                   "base", "added"), run,
                     "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def sanitise(text: str, spans: str, remove_terms: bool = True) -> str:
    """``text`` with each span replaced by its kind in brackets; disclosing
    terms are removed, or generalised to ``[TERM]``. Overlapping spans go as
    one, named after the first."""
    out, done = [], 0
    for kind, s, e in sorted(((k, int(s), int(e)) for k, s, e in (p.split(":") for p in spans.split(",") if p)),
                             key=lambda x: (x[1], -x[2])):
        if s >= done:
            out += [text[done:s], "" if kind == "term" and remove_terms else f"[{kind.upper()}]"]
        done = max(done, e)
    return "".join([*out, text[done:]])


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove_terms: bool = True,
              alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """``doc_id, text``: one row per input row, its text sanitised. A row's
    spans meet its text by the key of its scan, never by id, so null, repeated
    and equal ids are safe. Null texts stay null; an empty table gives an
    empty result; other columns are not read."""
    joined = _all_spans(docs, id_col, text_col, alpha, support, True)

    def run(batches):
        for b in batches:
            out = [t and sanitise(t, _joined(x, y), remove_terms) for t, x, y in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["doc_id", "text"])
    return map_arrow(joined.select("doc_id", "text", "base", "added"), run, "doc_id long, text string")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_spans(documents(spark, sf_dir))


QUERIES = {"op8_pii": op8_pii}
SQL: dict[str, str] = {}
