"""Periodic runs of words, found through a dictionary of basic factors.

The factors of length 1, 2, 4, ... of a text get names; equal factors share
one. A run of period q and at least four periods holds, at each of its starts
up to the last three periods, a factor of length L, the least power of two that
is q or more, whose next occurrence lies exactly q further on (a nearer one
would be a rotation of the primitive period word equal to itself). So the
starts whose next occurrence is d words away, L/2 < d <= L, form arithmetic
progressions, and the first start of each progression proposes period d there.
A proposal is extended to the right by the names of all lengths. To the left
nothing is left to extend: where the word before continues a long enough run,
the start before belongs to the same progression. Short stretches go, the rest
are all runs, each once.

Names are given by sorting, so every factor is compared exactly; there is no
hash. All texts of a pass are worked on at once, their words named apart.
"""
from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_arrow, passes, text_buffers

MIN_LENGTH = 6
MIN_PERIODS = 4


def _named(key: np.ndarray):
    """(name of each entry, next entry with the same name or -1, any equal)."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    name = np.empty(len(key), np.int64)
    name[order] = np.cumsum(fresh) - 1
    later = np.full(len(key), -1, np.int64)
    same = ~fresh[1:]
    later[order[:-1][same]] = order[1:][same]
    return name, later, bool(same.any())


def find_runs(words: np.ndarray, row: np.ndarray):
    """(start, length, period) of all runs, sorted by start and period.

    ``words`` are word numbers, ``row`` (ascending) says which text a word
    belongs to; starts count over the whole pass."""
    n = len(words)
    empty = np.zeros(0, np.int64)
    if n == 0:
        return empty, empty, empty
    end = np.searchsorted(row, row, "right")             # end of the own text
    name, later, again = _named(row.astype(np.int64) * (int(words.max()) + 1) + words)
    levels, starts, periods = [], [], []
    size = 1
    position = np.arange(n)
    while again:
        # a factor that does not occur again can never match: a name of its own
        alone = np.ones(n, bool)
        alone[later >= 0] = False
        alone[later[later >= 0]] = False
        named = np.where(alone, -1 - position, name)
        levels.append(named)
        apart = np.where(later >= 0, later - position, 0)
        near = (2 * apart > size) & (apart <= size)
        first = near.copy()
        first[1:] &= apart[1:] != apart[:-1]              # the first of its progression
        at = np.flatnonzero(first)
        starts.append(at)
        periods.append(apart[at])
        # the factor of twice the length: the pair of names, within the text
        size *= 2
        whole = np.flatnonzero((position + size <= end) & ~alone)
        whole = whole[~alone[whole + size // 2]]
        if not len(whole):
            break
        pair, next_one, again = _named(name[whole] * n + name[whole + size // 2])
        name, later = -1 - position, np.full(n, -1, np.int64)
        name[whole] = pair
        found = next_one >= 0
        later[whole[found]] = whole[next_one[found]]
    start, period = np.concatenate(starts or [empty]), np.concatenate(periods or [empty])
    # how far the text agrees with itself, period words on
    reach = start + period
    for k in range(len(levels) - 1, -1, -1):
        step, names = 1 << k, levels[k]
        moving = np.arange(len(start))
        while len(moving):
            here = reach[moving]
            inside = here + step <= end[start[moving]]
            moving, here = moving[inside], here[inside]
            equal = names[here] == names[here - period[moving]]
            moving = moving[equal]
            reach[moving] += step
            if k < len(levels) - 1:                       # only the longest length can apply again
                break
    length = reach - start
    long = length >= np.maximum(MIN_LENGTH, MIN_PERIODS * period)
    start, length, period = start[long], length[long], period[long]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def _repeated(words: list, crc) -> list:
    """The word sequence that the contract of op13 makes from a text."""
    n = len(words)
    if crc is None or crc % 10 or not n:
        return words
    g = crc // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _describe(words: list, start, length, period):
    """The result columns of one text from its runs."""
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in zip(start, length, period))
    best = None
    for s, m, q in zip(start, length, period):
        if best is None or Fraction(m, q) > Fraction(best[1], best[2]):     # ties: the earlier by start, period
            best = (s, m, q)
    kept = words
    if len(start):
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, np.array(start) + np.array(period), 1)
        np.add.at(gone, np.array(start) + np.array(length), -1)
        kept = [w for w, g in zip(words, np.cumsum(gone[:-1])) if not g]
    return lines, best, b" ".join(kept)


_SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seeded: bool = False,
                  with_text: bool = False) -> DataFrame:
    """Per row ``doc_id, n_runs``, the run of greatest exponent (``start,
    length, period, exponent_milli``; nulls without a run), ``runs_sha256``
    over all runs and ``collapsed_sha256`` over the text that is left when all
    but the first period of each run goes; ``with_text`` adds ``runs`` (array
    of start, length, period) and ``collapsed``.

    ``seeded`` repeats words of every tenth text first, chosen by the CRC of
    its id (null ids: never). Null and empty texts have no words and no run,
    and both digests are those of the empty string. Rows are independent:
    repeated rows, null ids and other columns change nothing; an empty table
    gives an empty result. A text is worked on whole, in memory linear in its
    words times the logarithm of its longest repeated factor.
    """
    crc = F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) if seeded else F.lit(None).cast("long")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), crc.alias("crc"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            data, offsets = text_buffers(b.column(2))
            crcs, out = b.column(1).to_pylist(), []
            for i, j in passes(offsets):
                texts = [_repeated(data[offsets[r]:offsets[r + 1]].tobytes().split(), crcs[r]) for r in range(i, j)]
                sizes = np.array([len(t) for t in texts], np.int64)
                first = np.concatenate([[0], np.cumsum(sizes)])
                numbers = {}
                words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(first[-1]))
                row = np.repeat(np.arange(len(texts)), sizes)
                start, length, period = find_runs(words, row)
                cuts = np.searchsorted(start, first)
                for k, text in enumerate(texts):
                    a, z = cuts[k], cuts[k + 1]
                    runs = (start[a:z] - first[k]).tolist(), length[a:z].tolist(), period[a:z].tolist()
                    lines, best, left = _describe(text, *runs)
                    digest = lambda v: hashlib.sha256(v).hexdigest()
                    record = (z - a, *(best or (None, None, None)), None if best is None else 1000 * best[1] // best[2],
                              digest(lines.encode()), digest(left))
                    out.append(record + (([list(r) for r in zip(*runs)], left.decode()) if with_text else ()))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + ([pa.list_(pa.list_(pa.int64())), pa.string()] if with_text else [])
            columns = list(zip(*out)) or [()] * len(kinds)
            names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"]
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id"] + names[:len(kinds)])
    return map_arrow(narrow, run, _SCHEMA + (", runs array<array<bigint>>, collapsed string" if with_text else ""))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(documents(spark, sf_dir), seeded=True)


QUERIES = {"op13_runs": op13_runs}
SQL: dict[str, str] = {}
