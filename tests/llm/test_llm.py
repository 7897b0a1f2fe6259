"""The training-data operators against brute force, a library, SQL-free
round trips and held-out accuracy, with the edge cases each docstring defines."""
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from podium.llm import bpe, exact, fingerprint, langid, mix, near, ngram, privacy, quality, shard

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, _gone_id long"
SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    """Documents with two further columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 7) for i, t, s in rows], SCHEMA)


ODD = [(1, "a b c", "s"), (2, "A B C", "s"), (3, None, None), (4, "", "s"), (5, " \t\n", "t"), (None, "a b c", "t"),
       (6, "word " * 30_000, "t"), (6, "word " * 30_000, "t"), (7, "é ß 日本   x", None), (8, "1 2 3 +49 (0) 123", "u")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def az(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", az(t))


# exact dedup ----------------------------------------------------------------

@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups(spark, keep):
    got = exact.exact_groups(frame(spark, ODD), keep=keep).collect()
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault(r.text_sha256, []).append(r)
    want = {}
    for i, t, _ in ODD:
        want.setdefault(hashlib.sha256(az(t).encode()).hexdigest(), []).append(i)
    assert set(by) == set(want)
    for sha, ids in want.items():
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known)
        assert {r.keep_id for r in by[sha]} == {best} and {r.group_size for r in by[sha]} == {len(ids)}
        assert sum(r.kept for r in by[sha]) == 1
        assert [r.doc_id for r in by[sha] if r.kept] == [best]


def test_exact_dedup_rows_and_empty(spark):
    df = frame(spark, ODD)
    got = exact.exact_dedup(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 5, 6, 7, 8]
    assert exact.exact_groups(df.limit(0)).count() == 0 and exact.exact_dedup(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        exact.exact_groups(df, keep="first")


# near dedup -----------------------------------------------------------------

def shingle_set(t):
    w = words(t)
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(items):
    sets = [(i, shingle_set(t)) for i, t in items]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, (i, s) in enumerate(sets):
        for j, z in sets[a + 1:]:
            both = len(s & z)
            if both and 100 * both >= 75 * (len(s) + len(z) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocab) for _ in range(70)]
    items, n = [], 0
    for _ in range(6):                           # families of edited copies around the threshold
        base = [rng.choice(vocab) for _ in range(rng.randint(60, 200))]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randint(0, len(base) // 18)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            items.append((n, " ".join(w)))
            n += 1
    for _ in range(150):                         # unlike texts around one common passage
        own = [rng.choice(vocab) for _ in range(rng.randint(10, 60))]
        items.append((n, " ".join(own + passage)))
        n += 1
    items += [(n, "one two"), (n + 1, "ONE two"), (n + 2, "two one"), (n + 3, ""), (n + 4, None), (n + 5, " ")]
    got = {r.doc_id: r for r in near.near_duplicates(frame(spark, [(i, t, "s") for i, t in items])).collect()}
    want = brute_components(items)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_dedup_odd_rows(spark):
    df = frame(spark, ODD)
    got = near.near_duplicates(df)
    assert got.count() == len(ODD)
    by = {(r.doc_id, r.n_shingles): r.component_id for r in got.collect()}
    assert by[(1, 1)] == by[(2, 1)] == by[(None, 1)] == 1 and by[(3, 0)] == 3 and by[(4, 0)] == 4
    stay = near.near_dedup(df)
    assert stay.columns == df.columns and {r.doc_id for r in stay.collect()} == {1, 3, 4, 5, 6, 7, 8}
    assert near.near_duplicates(df.limit(0)).count() == 0


def test_near_dedup_decides_per_row(spark):
    base = [" ".join(f"{c}{k}" for k in range(60)) for c in "pqrstu"]
    rows = [(1, base[0], "s"), (None, base[0] + " more", "s"), (None, base[1], "s"), (None, base[2], "s"),       # null ids
            (7, base[3], "s"), (7, base[4], "s"), (2, base[3] + " more", "s"),                                  # 7 loses to 2 once
            (9, base[5], "s"), (9, base[5] + " more", "s"), (9, base[5], "s"),                                  # the winner repeats
            (None, base[2] + " more", "s"), (None, None, "s"), (None, "", "s")]
    stay = near.near_dedup(frame(spark, rows))
    got = [(r.doc_id, r.text) for r in stay.collect()]
    assert len(got) == 8 and {(1, base[0]), (None, base[1]), (7, base[4]), (2, base[3] + " more"), (None, None), (None, "")} <= set(got)
    assert sum(t in (base[2], base[2] + " more") for _, t in got) == sum(i == 9 for i, _ in got) == 1


def test_bit_estimate_is_corrected_for_chance(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for share in (0.0, 0.5, 0.8):
        k = int(len(base) * 2 * share / (1 + share) / 1) if share else 0
        other = np.concatenate([base[:k], rng.integers(0, 2**63, len(base) - k).astype(np.uint64)])
        true = k / (2 * len(base) - k)
        a, b = near.minima(base), near.minima(other)
        row = spark.createDataFrame([(near.pack(a).tolist(), near.pack(b).tolist())], "x array<long>, y array<long>")
        assert abs(row.select(near.estimate("x", "y").alias("e")).head().e - true) < 0.2


# sharding -------------------------------------------------------------------

def jump(key, n):
    key %= 1 << 64
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards_match_the_published_walk(spark):
    rows = [(i, f"t{i}" * (i % 5), "s") for i in [*range(300), -1, -5, 2**62, -2**63]] + [(None, None, None), (3, "again", "s")]
    got = shard.shard(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        k = -1 if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard, r.law) == (jump(k, 40), jump(k, 41), "key")
        assert r.grown_shard in (r.shard, 40)
    texts = {(i, t) for i, t, _ in rows}
    assert {(r.size, r.text_crc32) for r in got} == {(len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in texts}
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert shard.shard(frame(spark, rows).limit(0)).count() == 0


# language-model scores --------------------------------------------------------

def test_lm_scores_against_brute_force(spark):
    rows = [(i, t, "s") for i, t in enumerate(["a b a c", "A b d", "", None, "z", "a b a c", "c a b " * 50])]
    got = {r.doc_id: r for r in ngram.score_documents(frame(spark, rows)).collect()}
    from collections import Counter
    ws = [words(t) for _, t, _ in rows]
    for d, w in enumerate(ws):
        one, two = Counter(), Counter()
        for e, v in enumerate(ws):
            if e != d:
                one.update(v)
                two.update(zip(v, v[1:]))
        n, total = sum(one.values()), 0.0
        for k, x in enumerate(w):
            if k and two[w[k - 1], x]:
                s = two[w[k - 1], x] / one[w[k - 1]]
            else:
                s = (0.4 if k else 1) * (one[x] / n if one[x] else 0.4 / (n + 1))
            total += math.log(s)
        assert got[d].n_words == len(w) and abs(got[d].log_score - total) < 1e-9
        assert (got[d].mean_log_score is None) == (not w)
    odd = frame(spark, ODD)
    assert ngram.score_documents(odd).count() == len(ODD) and ngram.score_documents(odd.limit(0)).count() == 0


def backoff(ws, d, order):
    """Log score of document ``d`` by the n-grams of all others, word by word."""
    from collections import Counter
    held = [Counter() for _ in range(order + 1)]
    for e, w in enumerate(ws):
        if e != d:
            for k in range(1, order + 1):
                held[k].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    n, total, left = sum(held[1].values()), 0.0, [0] * (order + 1)
    for i in range(len(ws[d])):
        for k in range(2, order + 1):
            left[k] += i + 1 >= k and held[k][tuple(ws[d][i - k + 1:i + 1])] > 0
        top = min(order, i + 1)
        for k in range(top, 0, -1):
            g = tuple(ws[d][i - k + 1:i + 1])
            if held[k][g]:
                total += math.log(0.4 ** (top - k) * held[k][g] / (held[k - 1][g[:-1]] if k > 1 else n))
                break
        else:
            total += math.log(0.4 ** top / (n + 1))
    return total, left[2:]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lm_scores_of_any_order(spark, order):
    rng = random.Random(order)
    texts = [" ".join(rng.choice("abcde") if rng.random() < 0.9 else f"w{rng.randrange(9)}" for _ in range(rng.randrange(25)))
             for _ in range(30)]
    texts += [texts[3], texts[3], texts[7], texts[3].upper(), None, "", "new words only"]
    # ids repeat and are null; other columns bear the names of helpers
    rows = spark.createDataFrame([(i // 2 if i % 5 else None, t, i, 7, 8) for i, t in enumerate(texts)],
                                 "doc_id long, text string, k1 long, own long, copies long")
    got = ngram.score_documents(rows, order=order, slices=2).collect()
    ws = [words(t) for t in texts]
    want = [backoff(ws, d, order) for d in range(len(ws))]
    ids = [i // 2 if i % 5 else None for i in range(len(texts))]

    def line(i, n, left, s):
        return (-1 if i is None else i, n, *left, round(s, 6) + 0.0)
    names = ["n_bigrams_left", "n_3grams_left", "n_4grams_left"][:order - 1]
    assert sorted(line(r.doc_id, r.n_words, [r[x] for x in names], r.log_score) for r in got) == sorted(
        line(i, len(w), left, s) for i, w, (s, left) in zip(ids, ws, want, strict=True))


@pytest.mark.parametrize("clash", [False, True])
def test_lm_rows_are_shuffled_by_short_keys(spark, monkeypatch, clash):
    """Exploded rows carry half of the text's key, unless two texts share it, and one long for an n-gram."""
    if clash:
        real = ngram._keys
        monkeypatch.setattr(ngram, "_keys", lambda data, offsets: np.column_stack([np.zeros(len(offsets) - 1, np.int64), real(data, offsets)[:, 1]]))
    plans, write = [], ngram.materialize
    monkeypatch.setattr(ngram, "materialize", lambda df, label: plans.append((label, df._jdf.queryExecution().optimizedPlan().toString())) or write(df, label))
    texts = ["a b a c", "b a b", "a b a c", None, "", "c a b a", "new words only", "b"]
    got = ngram.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    ws = [words(t) for t in texts]
    want = {d: backoff(ws, d, 2) for d in range(len(ws))}
    assert {r.doc_id: (round(r.log_score, 9), [r.n_bigrams_left]) for r in got} == {d: (round(s, 9) + 0.0, left) for d, (s, left) in want.items()}
    pairs = [p for label, p in plans if label == "lm-found"][1:]
    joins = [line for p in pairs for line in p.splitlines() if "Join Inner" in line]
    assert len(pairs) == ngram.SLICES and len(joins) == len(pairs) and all("id#" in x and "head#" not in x and "tail#" not in x for x in joins)
    assert all(("Aggregate [k1#" in p) and (("k2#" in p.split("Join Inner")[0]) == clash) for p in pairs)


def test_lm_hot_ngram_and_copies(spark):
    """A third of the rows are one text, every text holds one bigram, one text is long."""
    texts = ["hot pair of words"] * 200 + [f"hot pair u{i} v{i}" for i in range(399)] + ["hot pair " * 120_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r.doc_id: r for r in ngram.score_documents(rows).collect()}
    assert len(got) == 600 and got[599].n_words == 240_000
    n = 200 * 4 + 399 * 4 + 240_000
    first, pair = (1 / (n - 4)), 1.0
    others = 599 + 119_999 + 0                              # "hot" and "hot pair" in other rows of a short text
    hot = others + 1
    assert got[0].log_score == pytest.approx(
        math.log(hot * first) + math.log(pair) + math.log(199 / hot) + math.log(199 / 199), abs=1e-9)
    # the long text: only "hot pair" is left, "pair hot" backs off to "hot"
    left = n - 240_000
    assert got[599].n_bigrams_left == 120_000
    assert got[599].log_score == pytest.approx(math.log(599 / left) + 119_999 * math.log(0.4 * 599 / left), rel=1e-9)
    assert {got[i].log_score for i in range(200)} == {got[0].log_score}



# language ID ------------------------------------------------------------------

def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 150 and (held.lang == held.lang_pred).mean() > 0.97
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all()


def test_language_odd_rows(spark, docs):
    model = langid.fit(docs)
    df = frame(spark, ODD)
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(df, model).collect()}
    assert {x for x, p in got if p == "und"} == {3, 4, 5, 8}
    none = langid.fit(df.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in langid.identify(df, none).collect()} == {("und", 0.0)}
    assert langid.identify(df.limit(0), model).count() == 0
    stay = langid.keep_identified(df, model, least=0.0)
    assert stay.columns == df.columns and {r.doc_id for r in stay.collect()} == {1, 2, 6, 7, None}


# quality ------------------------------------------------------------------------

def test_quality_weights_and_sample(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = labels.where("quality = 1").select("doc_id")
    got = quality.select_quality(docs, good).toPandas()
    again = quality.select_quality(docs, good).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    assert sorted(got["rank"]) == list(range(1, len(got) + 1)) and got.kept.sum() == math.ceil(0.8 * len(got))
    order = got.sort_values("rank")
    assert (order.gumbel_key.diff().dropna() <= 0).all() and order.kept.head(int(got.kept.sum())).all()
    ratio = quality.fit(docs, good)
    one = docs.where("text is not null").orderBy("doc_id").head()
    from podium.llm.common import words_by_pass
    import pyarrow as pa
    (_, _, h, row), = words_by_pass(pa.array([one.text]))
    bucket, _ = quality._features(h, row)
    assert abs(ratio[bucket].sum() - got.set_index("doc_id").log_weight[one.doc_id]) < 1e-6


def test_quality_odd_rows(spark, docs):
    df = frame(spark, ODD)
    got = quality.select_quality(df, df.select("doc_id").limit(0)).collect()
    assert len(got) == len(ODD) and {r.log_weight for r in got} == {0.0}
    assert {r.doc_id for r in got if r.gumbel_key == -math.inf} == {3, 4, 5}
    assert quality.select_quality(df.limit(0), df.select("doc_id")).count() == 0


# BPE -----------------------------------------------------------------------------

def test_bpe_matches_the_library(spark, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.default_path())
    t.no_padding()
    t.no_truncation()
    rng = random.Random(3)
    signs = "aAbBéÉ'stSTrevlmdΣσİ1２ \t\n\x1c\x85\xa0<|startoftext|><|endoftext|>!?日本é\U000105c0Ɤ"
    more = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    more += ["'s's 're'LL <|endoftext|>'d x<|startoftext|>", "aaaaaaaaaaaaaaaa" * 40, "", None]
    cases = list(texts.values()) + more
    df = frame(spark, [(i, x, "s") for i, x in enumerate(cases)])
    got = bpe.bpe_encode(df, bpe.default_path(), decoded=True, carry=("kept", "lang")).collect()
    assert len(got) == len(cases) and got[0].kept == "x"
    for r in got:
        ids = t.encode(cases[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded == t.decode(ids, skip_special_tokens=False)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert bpe.bpe_encode(df.limit(0), bpe.default_path()).count() == 0


def test_bpe_class_table_takes_little_driver_memory():
    """The driver asks the library for the classes in short stretches; all code points at once cost over 200 MB."""
    import os
    import subprocess
    import sys
    code = ("import tokenizers\nfrom podium.llm import bpe\n"
            "peak = lambda: int(open('/proc/self/status').read().split('VmHWM:')[1].split()[0])\n"
            "before = peak()\nbpe._classes()\nprint(peak() - before)")
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert int(done.stdout) < 64 << 10          # kB


# privacy ---------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(t):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card":
                v = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
                if not 14 <= len(d) <= 19 or sum(x - 9 * (x > 9) for x in v) % 10:
                    continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind))
    return [(s, e, kind) for s, _, e, kind in sorted(out)]


def test_base_spans_equal_the_plain_patterns(texts):
    rng = random.Random(9)
    signs = "a1.@-+ ()%25é0"
    cases = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    cases += list(texts.values()) + ["x@y.z.w@q.r", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "+1 (555) 123-4567", "0000000000000.1.2.3",
                                     "a@b.c" * 5, "9" * 100_000, "a" * 100_000 + "!@b"]
    for t in cases:
        assert privacy.base_spans(t) == (plain_spans(t) if len(t) < 50_000 else privacy.base_spans(t))


def test_private_spans_and_disclosing_terms(spark, texts):
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(30)), "s") for i in range(60)]
    rows += [(100 + i, f"{rng.choice(vocab)} {rng.choice(vocab)} Zorblatt ann@ex.org {rng.choice(vocab)} x{i}", "s") for i in range(5)]
    rows += [(200, None, None), (201, "", "s"), (201, "", "s")]
    df = frame(spark, rows)
    got = {r.doc_id: r for r in privacy.private_spans(df).collect()}
    assert privacy.private_spans(df).count() == len(rows)
    for i, t, _ in rows:
        r, base = got[i], plain_spans(t or "")
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for _, _, k in base) for x in privacy.KINDS)
        assert all(f"{k}:{s}:{e}" in r.spans.split(",") for s, e, k in base)
        extra = [p for p in r.spans.split(",") if p.startswith("term")]
        assert bool(extra) == (100 <= i < 105)
    t = dict((i, x) for i, x, _ in rows)[100]
    assert "Zorblatt" not in privacy.sanitise(t, got[100].spans) and "[EMAIL]" in privacy.sanitise(t, got[100].spans)
    assert "[TERM]" in privacy.sanitise(t, got[100].spans, remove_terms=False)
    assert privacy.private_spans(df.limit(0)).count() == 0


def planted(n, line, seed=3):
    """``n`` texts of random words, and ``line`` beside random words in five more (ids from 1000)."""
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    fill = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    return [(i, fill(30), "s") for i in range(n)] + [(1000 + i, f"{fill(2)} {line} {fill(2)} x{i}", "s") for i in range(5)]


def masked(spark, rows):
    """The terms that go, by id."""
    text, out = {i: t for i, t, _ in rows}, {}
    for r in privacy.private_spans(frame(spark, rows)).collect():
        out[r.doc_id] = [text[r.doc_id][int(s):int(e)] for k, s, e in (p.split(":") for p in r.spans.split(",") if p) if k == "term"]
    return out


def test_terms_are_counted_as_they_are_cut(spark):
    terms = ["Иван", "Österreich", "Élodie", "“zorblatt”", "jean-luc", "j.smith", "user=jdoe", "İlker"]
    rows = planted(60, "")[:60]
    for k, term in enumerate(terms):
        rows += [(1000 * (k + 1) + i, t.replace("x", f"x{k}_"), s) for i, (_, t, s) in
                 enumerate(planted(0, f"{term} mail{k}@host.org", seed=k))]
    rows += [(500 + i, f"jean j user luc smith y{i}", "s") for i in range(40)]      # the pieces are common, the terms are not
    got = masked(spark, rows)
    for k, term in enumerate(terms):
        assert all(got[1000 * (k + 1) + i] == [term.strip("“”")] for i in range(5)), term
    assert not any(got[i] for i in [*range(60), *range(500, 540)])


def test_copies_change_no_term(spark):
    rows = planted(60, "Zorblatt ann@ex.org")
    copies = [(2000 + i, rows[60][1], "s") for i in range(200)] + [(3000 + i, rows[0][1], "t") for i in range(50)]
    alone, got = masked(spark, rows), masked(spark, rows + copies)
    assert all(alone[1000 + i] == ["Zorblatt"] for i in range(5))
    assert {i: got[i] for i in alone} == alone and all(got[2000 + i] == ["Zorblatt"] for i in range(200))


def test_terms_far_from_the_value_and_in_other_texts(spark):
    rows = planted(60, "Zorblatt " + " ".join(f"w{i}" for i in range(9)) + " ann@ex.org " + " ".join(f"w{i}" for i in range(7)) + " Zorblatt")
    rows += [(i, f"{t} w{i % 9}", s) for i, t, s in planted(60, "", seed=4)[:60] for i in range(i * 9 + 2000, i * 9 + 2009)]
    rows += [(5000, "the ZORBLATT of them", "s"), (5001, "Zorblatts mail@zorblatt.org", "s")]
    got = masked(spark, rows)
    assert all(got[1000 + i] == ["Zorblatt"] * 2 for i in range(5)) and got[5000] == ["ZORBLATT"] and not got[5001]
    assert not any(got[i] for i in range(60))


# fingerprints -------------------------------------------------------------------------

def test_fingerprints_against_plain_neighbours(spark, texts):
    ids = sorted(texts)
    got = {r.doc_id: r for r in fingerprint.op9_fingerprint(spark, SF).collect()}
    assert len(got) == len(ids)
    near_edit, near_next = [], []
    for i, n in zip(ids, ids[1:] + ids[:1], strict=True):
        t, z, r = texts[i], texts[n], got[i]
        edited = t[:len(t) - len(t) // 2] + z[:len(t) // 2]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fingerprint.fingerprint(t) and r.edited_fingerprint == fingerprint.fingerprint(edited)
        assert r.near_edited == fingerprint.likeness(r.fingerprint, r.edited_fingerprint) and 0 <= r.near_edited <= 1
        assert r.near_next == fingerprint.likeness(r.fingerprint, fingerprint.fingerprint(z))
        near_edit.append(r.near_edited)
        near_next.append(r.near_next)
    assert np.mean(near_edit) > 0.4 > np.mean(near_next)


def test_fingerprint_odd_rows(spark):
    df = frame(spark, ODD)
    got = fingerprint.neighbour_fingerprints(df).collect()
    assert len(got) == len(ODD) and {r.fingerprint for r in got if r.n_chars == 0} == {"0::"}
    alone = fingerprint.neighbour_fingerprints(df.where("doc_id = 1")).head()
    assert alone.edited_sha256 == hashlib.sha256(b"a ba").hexdigest() or alone.n_chars == 5
    assert alone.near_next == 1.0
    assert fingerprint.neighbour_fingerprints(df.limit(0)).count() == 0
    assert fingerprint.likeness(fingerprint.fingerprint("abc"), fingerprint.fingerprint("abc")) == 1.0


# mixing ----------------------------------------------------------------------------------

def water(sizes, weights=(1, 2, 3)):
    """Reshares the excess by weight until no source is above three times its size."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        room = total - sum(capped.values())
        share = {s: room * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return share | capped
        capped |= {s: 3 * sizes[s] for s in over}


def test_mix_hits_targets(spark):
    rng = random.Random(4)
    rows = []
    for s, k in (("b", 200), ("a", 3), ("c", 40), (None, 30), ("Z", 1)):
        rows += [(len(rows) + i, "w " * rng.randint(0, 60), s) for i in range(k)]
    rows += [(9001, None, "b"), (9002, "x " * 500, "a")]
    df = frame(spark, rows)
    got = mix.mix(df).toPandas()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = water(sizes)
    by = {(None if s is None or s != s else s): g for s, g in got.groupby("source", dropna=False)}
    for s, g in by.items():
        assert abs(g.target.iloc[0] - target[s]) < 1e-6 * max(1, target[s]) and (g.source_size == sizes[s]).all()
        assert abs(g.taken.sum() - target[s]) <= g["size"].max()
    assert (got.taken <= 3 * got["size"]).all() and got.taken.sum() <= sum(sizes.values())
    again = mix.mix(df.repartition(7)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()
    out = mix.mixed_documents(df)
    assert out.columns == df.columns
    assert out.groupBy("source").count().count() == len([s for s in by if by[s].taken.sum()])
    assert out.select(F.sum(F.size(F.split(F.trim("text"), " ")))).head()[0] == got.taken.sum()


def test_mix_odd_rows(spark):
    df = frame(spark, ODD)
    got = mix.mix(df)
    assert got.count() == len(ODD)
    assert mix.mix(df.limit(0)).count() == 0 and mix.mixed_documents(df.limit(0)).count() == 0
    assert {r.taken for r in mix.mix(df.where("doc_id in (3, 4, 5)")).collect()} == {0}


def test_mixed_documents_send_what_the_mix_took(spark):
    rows = [(None, f"n{i} a b", "s") for i in range(40)] + [(3, "c d e", "s"), (3, "c d e", "s"), (3, "c d f", "s")]
    rows += [(100 + i, f"m{i} a b", "t") for i in range(20)] + [(200 + i, f"o{i} a b", None) for i in range(20)]
    df = frame(spark, rows)
    count = lambda d, v: sorted((str(r[0]), str(r[1]), r[2]) for r in d.groupBy("doc_id", "source").agg(v).collect() if r[2])
    want = mix.mix(df)
    assert want.where("doc_id is null and copies = 0").count()
    assert count(mix.mixed_documents(df), F.count(F.lit(1))) == count(want, F.sum("copies"))


# pipeline ------------------------------------------------------------------------------------

def test_pipeline_stage_by_stage(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix", "bpe"]
    at, (lang, ex, nr, mx, enc) = docs, [f for _, f in corpus_pipeline.STAGES]
    keep = lambda df: spark.createDataFrame(df.collect(), df.schema)
    one = keep(lang(spark, at, SF))
    assert one.columns == docs.columns
    assert one.count() >= 0.97 * docs.where(F.col("text").rlike(r"\p{L}")).count()
    two = keep(ex(spark, one, SF))
    assert two.count() == one.select(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).distinct().count()
    three = keep(nr(spark, two, SF))
    want = brute_components([(r.doc_id, r.text) for r in two.collect()])
    assert {r.doc_id for r in three.collect()} == {i for i, (_, c) in want.items() if i == c}
    four = keep(mx(spark, three, SF))
    assert four.columns == docs.columns
    copies = {r.doc_id: r["count"] for r in four.groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: r.copies for r in mix.mix(three).collect() if r.copies}
    last = enc(spark, four, SF)
    assert last.count() == four.count() and "ids" in last.columns


def test_language_stage_drops_only_what_has_no_language(spark, docs):
    texts = ["გამარჯობა მსოფლიო", "ok", "ჰ", "no", "123", "", None]       # an unseen script, words of several languages
    df = docs.limit(200).unionByName(frame(spark, [(10**9 + i, t, "s") for i, t in enumerate(texts)]).withColumn(
        "lang", F.lit(None).cast("string")).select(docs.columns))
    model = langid.fit(df)
    named = {r.doc_id for r in langid.identify(df, model).where("lang_pred <> 'und'").collect()}
    assert {10**9, 10**9 + 2} <= named
    assert {r.doc_id for r in corpus_pipeline.language(spark, df, SF).collect()} == named


def test_pipeline_stages_on_odd_and_empty_tables(spark, docs):
    odd = frame(spark, ODD)
    for rows in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, rows, SF)
            got.count()
            if name != "bpe":
                assert got.columns == rows.columns
