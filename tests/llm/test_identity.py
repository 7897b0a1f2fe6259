"""Words that weak hashes confuse, and sanitised texts row by row."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.llm import bpe, common, near, privacy


def thue_morse(n, a="a", b="b"):
    w = a
    while len(w) < n:
        w += w.translate(str.maketrans(a + b, b + a))
    return w[:n]


PAIRS = [(thue_morse(n), thue_morse(n, "b", "a")) for n in (64, 1024, 2048, 4096, 8192)]


def test_word_hashes_differ():
    for a, b in PAIRS:
        codes = np.frombuffer((a + b).encode(), np.uint8).astype(np.uint64)
        starts = np.array([0, len(a)])
        h = common.span_hashes(common._BYTE_CODE[codes.astype(np.uint8)], starts, starts + len(a))
        assert h[0] != h[1]


def test_distinct_spans_compares_contents():
    codes = np.frombuffer(b"abcabcabdxyab", np.uint8)
    starts, ends = np.array([0, 3, 6, 9, 11]), np.array([3, 6, 9, 11, 13])
    for hashes in (np.zeros(5, np.uint64), np.array([1, 1, 1, 2, 2], np.uint64), np.array([4, 4, 2, 1, 3], np.uint64)):
        first, back = common.distinct_spans(codes, hashes, starts, ends)
        spans = [bytes(codes[a:z]) for a, z in zip(starts, ends, strict=True)]
        assert [spans[first[k]] for k in back] == spans and len(first) == len(set(spans)) == 4


def test_bpe_thue_morse_against_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.default_path()
    own = tokenizers.Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    texts = [f"{a} {b} {a}" for a, b in PAIRS]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: list(r.ids) for r in bpe.bpe_encode(df, path).collect()}
    for i, t in enumerate(texts):
        assert got[i] == own.encode(t, add_special_tokens=False).ids


def test_near_thue_morse_words_are_not_linked(spark):
    texts = [w for pair in PAIRS for w in pair] + [PAIRS[1][0].upper()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near.near_duplicates(df).collect()}
    assert got == {i: 2 if i == len(texts) - 1 else i for i in range(len(texts))}


def test_sanitised_by_row(spark):
    rows = [(1, "mail a@b.cc now"), (None, "call +49 (30) 1234567 now"), (2, "h x@y.zz"), (2, "see 10.0.0.1 and x@y.zz"), (3, None), (4, ""),
            (2, "h x@y.zz"), (None, "clean")]
    df = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, row long")
    got = [(r.doc_id, r.text) for r in privacy.sanitised(df).collect()]
    want = [(1, "mail [EMAIL] now"), (None, "call [PHONE] now"), (2, "h [EMAIL]"), (2, "see [IP] and [EMAIL]"), (3, None), (4, ""),
            (2, "h [EMAIL]"), (None, "clean")]
    key = lambda r: tuple((x is None, x or "") if not isinstance(x, int) else (False, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert privacy.sanitised(df.limit(0)).count() == 0


def test_sanitised_removes_every_base_span_and_term(spark):
    sf = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spans = [r.spans for r in privacy.private_spans(sf).where(F.col("spans") != "").select("spans").collect()]
    assert spans
    clean = privacy.sanitised(sf)
    assert clean.count() == sf.count()
    left = privacy.private_spans(clean).agg(*[F.sum(c) for c in ("n_email", "n_ip", "n_card", "n_phone")]).first()
    assert tuple(left) == (0, 0, 0, 0)
    named = [(i, f"Zorblax writes from zorblax{i % 1}@mail.org about {w}") for i, w in enumerate(("tea", "rice", "salt", "corn"))]
    named += [(10 + i, f"the weather of day {i} is fine about tea") for i in range(40)] + [(60, "Zorblax was here")]
    got = {r.doc_id: r.text for r in privacy.sanitised(spark.createDataFrame(named, "doc_id long, text string")).collect()}
    assert all("zorblax" not in t.lower() for t in got.values()) and "[EMAIL]" in got[0] and got[10] == named[4][1]
