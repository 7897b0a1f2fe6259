"""Rules, audit and periodic runs against plain Python over the same rows."""
import hashlib
import random
import re
import zlib
from fractions import Fraction
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from podium.llm import audit, rules, runs

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, "a b c d e f g h i j k", "s"), (2, None, None), (3, "", "s"), (4, " \t\n", "t"), (None, "the of a b c " * 9, "t"),
       (5, "word " * 3000, "t"), (5, "word " * 3000, "t"), (6, "é ß 日本   x y \x1cz", None), (7, "x\n\nx\r\nx\n y \n y", "u"),
       (None, "The The # $ A" * 40, "u"), (None, "The The # $ A" * 40, "u"), (8, "b a b a c " * 40, "")]


def frame(spark, rows):
    """Documents with columns named like helpers and results of the operators."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, kept string, __text long, __words long, "
              "`part` long, mask long, `groups` long, `a.b` map<string,int>")
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 7, 7, 7, 7, 7, {"k": 1}) for i, t, s in rows], schema)


@pytest.fixture(scope="module")
def plain(spark):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]


# rules ----------------------------------------------------------------------

def base_counts(text):
    t = text or ""
    words = BLANK.findall(t)
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
    lines = [s for s in t.split("\n") if BLANK.search(s)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def test_rules_base(spark, plain):
    long = [(9, " ".join(random.Random(3).choices(["aa", "b", "cc", "d", "e"], k=20_000)) + " w" * 900_000, "s")]
    rows = ODD + plain + long
    got = rules.quality_rules(frame(spark, rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = [(i, *base_counts(t)) for i, t, _ in rows]
    assert sorted([tuple(r)[:7] for r in got], key=key) == sorted(want, key=key)
    for r in got:
        assert r.kept == (not r.base_failed and not r.failed_rules)
    assert rules.quality_rules(frame(spark, ODD).limit(0)).count() == 0


def test_rules_verdict_and_plan(spark, plain):
    good = "The old house of the town is in a valley and the river was on its left side. "
    junk = {"symbols_per_word": good + " # # # # # #", "stop_words": "zzq " + " ".join(f"qx{i}" for i in range(30)),
            "exclamations_per_word": " ".join(w + "!!" for w in good.split()), "mean_word_length": "the of " + "x" * 400 + " a b c d e f g h i",
            "repeated_lines": good + "\nyes it is\nyes it is\nyes it is", "bullet_lines": "\n".join("- the way of " + str(i) for i in range(12)),
            "ellipsis_lines": "\n".join(f"the way of {i}..." for i in range(12))}
    df = frame(spark, [(0, good, "s")] + [(i + 1, t, "s") for i, t in enumerate(junk.values())])
    got = {r.doc_id: r.failed_rules for r in rules.quality_rules(df).collect()}
    assert got[0] == []
    for i, name in enumerate(junk):
        assert name in got[i + 1], name
    kept = rules.keep_quality(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [0]
    plan = kept._jdf.queryExecution().toString() + rules.quality_rules(df)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# audit ----------------------------------------------------------------------

def plain_audit(rows, good, toxic):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = {}
    for i, t, part in rows:
        t = t or ""
        words = BLANK.findall(t)
        fails = {f for f, bad in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            re.search(r"[#$%&*|]", t), t in least and (i is None or i > least[t])), strict=True) if bad}
        shares = {f: 0 for f in "ABCDE"}
        for order in permutations("ABCDE"):
            gone = None
            for k, f in enumerate(order):
                c = out.setdefault((part or "", "".join(order), k + 1), [0] * 7)
                if f in fails:
                    if gone is None:
                        gone = f
                        shares[f] += 1
                        c[1] += 1
                        c[4] += i in good
                        c[5] += i in toxic
                    else:
                        c[2] += 1
                    c[3] += fails == {f}
                c[0] += gone is None
        for (p, order, k), c in out.items():
            if p == (part or ""):
                c[6] += shares[order[k - 1]]
    return {k: tuple(v) for k, v in out.items()}


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("few", [True, False])
def test_audit(spark, plain, few, monkeypatch):
    if not few:                                 # small tries, several ranges, labels by a shuffle
        monkeypatch.setattr(audit, "BROADCAST_LABELS", 0)
        monkeypatch.setattr(audit, "TRIE_BYTES", 40_000)
    shared = "The same long passage of many words stands at the head. " * 40
    rows = (ODD + plain[:60] + [(i + 1000, t, s) for i, t, s in plain[:60:3]] + [(500, plain[0][1], "s"), (-4, plain[1][1], "zz")]
            + [(700 + i, shared + f"tail {i % 5}", "s") for i in range(30)])
    lab = [(i, i % 2, i % 3 == 0) for i in range(0, 40)] + [(1, 0, 0), (1, 1, None), (None, 1, 1), (701, 1, 1)]
    got = {tuple(r)[:3]: tuple(r)[3:] for r in audit.audit(
        frame(spark, rows), labels_of(spark, [(i, q, None if x is None else int(x)) for i, q, x in lab])).collect()}
    want = plain_audit(rows, {i for i, q, _ in lab if q == 1 and i is not None}, {i for i, _, x in lab if x and i is not None})
    assert got == want


def test_audit_empty_and_trie(spark):
    assert audit.audit(frame(spark, ODD).limit(0), labels_of(spark, [(1, 1, 0)])).count() == 0
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"ab", k=rng.randrange(0, 12))) for _ in range(3000)] + [b"a" * 9_000_000, b"a" * 9_000_000 + b"b"]
    trie, want = audit.Trie(), {}
    for i, t in enumerate(texts):
        audit._add(trie.groups(t), ("p", False, False), 1, i, 1)
        want.setdefault(t, []).append(i)
    got = {t: g[("p", False, False)] for t, g in trie.terminals()}
    assert got == {t: (len(v), v[0], 1) for t, v in want.items()}


def test_audit_plan_has_no_hot_text(spark):
    """A text held by all rows leaves a task as one row per trie."""
    df = spark.range(0, 4000, 1, 4).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("s").alias("source"))
    got = audit.mask_counts(df, labels_of(spark, [(1, 1, 0)])).collect()
    assert {r["mask"]: (r["rows"], r["good"]) for r in got} == {1: (1, 0), 17: (3999, 1)}
    texts = list(audit._tries(iter([pa.record_batch(
        [[b"same text"] * 4000, list(range(4000)), ["s"] * 4000, [False] * 4000, [False] * 4000], ["text", "id", "part", "quality", "toxic"])])))
    assert sum(b.num_rows for b in texts) == 1


# periodic runs --------------------------------------------------------------

def plain_runs(w):
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                seg = w[i:j + q]
                if not any(all(seg[x] == seg[x + d] for x in range(len(seg) - d)) for d in range(1, q)):
                    out.add((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_result(i, text, seeded):
    w = BLANK.findall(text or "")
    h = None if i is None else zlib.crc32(str(i).encode())
    if seeded and w and h is not None and h % 10 == 0:
        g, n = h // 10, len(w)
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[x] if x < a else w[a + (x - a) % p] for x in range(n)]
    found = plain_runs(w)
    gone = {x for s, m, q in found for x in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (i, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_find_runs_brute_force():
    rng = random.Random(11)
    for k in range(400):
        rows = []
        for _ in range(rng.randrange(1, 4)):
            w = rng.choices(range(rng.choice([1, 2, 3, 9])), k=rng.randrange(0, 70))
            if rng.random() < 0.6:
                unit = rng.choices(range(3), k=rng.randrange(1, 11))
                at = rng.randrange(0, len(w) + 1)
                w[at:at] = (unit * 9)[:rng.randrange(1, 60)]
            rows.append(w)
        first = np.cumsum([0] + [len(w) for w in rows])
        got = list(zip(*(x.tolist() for x in runs.find_runs(np.array(sum(rows, []), np.int64), np.repeat(np.arange(len(rows)), np.diff(first))))))
        want = [(s + int(first[r]), m, q) for r, w in enumerate(rows) for s, m, q in plain_runs(w)]
        assert got == want, (k, rows)


@pytest.mark.parametrize("seeded", [True, False])
def test_periodic_runs(spark, plain, seeded):
    rows = [r for r in ODD if len(r[1] or "") < 5000] + [(i, (t or "")[:4000], s) for i, t, s in plain] + [(None, "a b " * 9, "s")] * 2
    got = [tuple(r) for r in runs.periodic_runs(frame(spark, rows), seeded=seeded).collect()]
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)
    assert sorted(got, key=key) == sorted([plain_result(i, t, seeded) for i, t, _ in rows], key=key)


def test_periodic_runs_long_and_text(spark):
    """A text of two million words with one period, texts beyond one pass and one batch, and the outputs in full."""
    long = "x y z " * 700_000                   # 4 MB; Arrow batch and pass are exceeded together with the next
    df = frame(spark, [(1, long, "s"), (2, "q " * 3_000_000 + "r", "s"), (3, "a b a b a b a b c", "s"), (4, None, "s")])
    got = {r.doc_id: r for r in runs.periodic_runs(df, with_text=True).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period) == (1, 0, 2_100_000, 3) and got[1].collapsed == "x y z"
    assert (got[2].length, got[2].period, got[2].collapsed) == (3_000_000, 1, "q r")
    assert got[3].runs == [[0, 8, 2]] and got[3].collapsed == "a b c"
    assert got[4].runs == [] and got[4].collapsed == "" and got[4].start is None
    assert runs.periodic_runs(df.limit(0)).count() == 0
