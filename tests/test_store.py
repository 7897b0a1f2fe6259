"""The vector store and the encoder that lives in the workers."""
import os
import uuid

import numpy as np
import pytest

from podium.operators import retrieve
from podium.sources.store import VectorStore


def texts_of(spark, rows):
    return spark.createDataFrame(rows, "podcast_id string, text string")


def test_one_new_item_encodes_one_row_in_a_new_session_object(spark, tmp_dir):
    first = texts_of(spark, [(f"p{i}", f"show number {i} about topic{i % 4}") for i in range(20)])
    store = VectorStore(spark, tmp_dir + "/s", retrieve.load_hashing_encoder, buckets=8)
    store.freeze("v1", retrieve.HashingEncoder(dim=16), first)
    before = {r.podcast_id: r.embedding for r in store.embed(first, "v1").collect()}
    again = VectorStore(spark, tmp_dir + "/s", retrieve.load_hashing_encoder, buckets=8)
    again.freeze("v1", retrieve.HashingEncoder(dim=16), texts_of(spark, [("x", "other words")]))     # stays as it is
    more = first.unionByName(texts_of(spark, [("p20", "a new show"), ("p3", "show number 4 about topic0"), ("p21", None), ("p20", "a new show")]))
    assert [r.text for r in again.missing(more, "v1").collect()] == ["a new show"]
    after = again.embed(more, "v1").collect()
    assert len(after) == 23                    # repeated rows keep their number, the null text has no vector
    got = {(r.podcast_id, tuple(r.embedding)) for r in after}
    assert {(k, tuple(v)) for k, v in before.items()} <= got
    assert ("p3", tuple(before["p4"])) in got  # equal texts share a vector
    assert again.vectors("v1").count() == 21 and again.missing(more, "v1").count() == 0


def test_no_exchange_above_the_cache(spark, tmp_dir):
    rows = texts_of(spark, [(f"p{i}", f"text {i}") for i in range(40)])
    store = VectorStore(spark, tmp_dir + "/s", retrieve.load_hashing_encoder, buckets=8)
    store.freeze("v1", retrieve.HashingEncoder(dim=8), rows)
    store.embed(rows, "v1")
    store.embed(rows.unionByName(texts_of(spark, [("q", "one more")])), "v1")     # several files per bucket
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (store.lookup(rows, "v1"), store.missing(rows, "v1")):
            plan = df._jdf.queryExecution().sparkPlan().toString() and df._jdf.queryExecution().executedPlan().toString()
            lines = plan.split("\n")
            scan = next(i for i, x in enumerate(lines) if "vectors_" in x)
            depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
            above = []
            for x in reversed(lines[:scan]):
                d = len(x) - len(x.lstrip(" :+-"))
                if d < depth:
                    above.append(x)
                    depth = d
            assert any("Join" in x for x in above)
            until_join = above[:next(i for i, x in enumerate(above) if "Join" in x)]
            assert not any("Exchange" in x for x in until_join), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def counting_encoder(folder, dim=4):
    """An encoder whose loads and calls leave files."""
    def load():
        import os
        import uuid

        import numpy as np
        open(os.path.join(folder, f"load-{os.getpid()}-{uuid.uuid4().hex}"), "w").close()

        def encode(texts):
            with open(os.path.join(folder, f"call-{uuid.uuid4().hex}"), "w") as f:
                f.write(f"{len(texts)} {max(len(t.split()) for t in texts)}")
            return np.array([[len(t), t.count("a"), t.count(" "), 0.0] for t in texts])
        return encode
    return load


def test_worker_encoder_loads_once_per_worker(spark, tmp_dir):
    os.makedirs(tmp_dir, exist_ok=True)
    name = f"count-{uuid.uuid4().hex}"
    rows = texts_of(spark, [(f"p{i}", "a b c " * (i % 120)) for i in range(500)]).repartition(16)
    for _ in range(2):                          # 32 tasks, later ones find the encoder loaded
        enc = retrieve.WorkerEncoder(name, counting_encoder(tmp_dir))
        got = {r.podcast_id: np.array(r.embedding) for r in retrieve.embed_text(rows, "podcast_id", encoder=enc).collect()}
    loads = [f.split("-")[1] for f in os.listdir(tmp_dir) if f.startswith("load-")]
    assert len(loads) == len(set(loads)) < 32
    calls = [tuple(map(int, open(os.path.join(tmp_dir, f)).read().split())) for f in os.listdir(tmp_dir) if f.startswith("call-")]
    assert max(n for n, _ in calls) <= 64 and max(t for _, t in calls) == 256
    assert len(got) == 500 and np.linalg.norm(got["p7"]) == pytest.approx(1.0, abs=1e-6) and not got["p0"].any()
    full = " ".join(["a", "b", "c"] * 119).split()[:256]
    want = np.array([len(" ".join(full)), full.count("a"), 255, 0.0])
    assert np.allclose(got["p119"], want / np.linalg.norm(want), atol=1e-6)


def test_first_tokens():
    assert retrieve.first_tokens("  a  b\nc d", 3) == "a b c" and retrieve.first_tokens(None, 5) == "" and retrieve.first_tokens("x", 5) == "x"


def test_similar_by_text_answers_unknown_ids(spark):
    items = spark.createDataFrame([("a", "space news", "science", "stars and planets"), ("b", "space talk", "science", "planets and stars"),
                                   ("c", "goal", "sports", "football cup"), ("d", None, None, None)],
                                  "podcast_id string, title string, category string, description string")
    enc = retrieve.HashingEncoder(dim=64)
    vectors = retrieve.embed_text(retrieve.item_text(items), "podcast_id", encoder=enc)
    asked = spark.createDataFrame([("a",), ("a",), ("zzz",), (None,), ("d",)], "podcast_id string")
    rows = retrieve.similar_by_text(items, vectors, enc, asked, 2).collect()
    by = {}
    for r in rows:
        by.setdefault(r.podcast_id, []).append(r)
    assert set(by) == {"a", "zzz", "d"} and [r.status for r in by["zzz"]] == ["unknown"] and by["zzz"][0].similar_id is None
    best = sorted(by["a"], key=lambda r: r["rank"])
    assert [r.status for r in best] == ["ok", "ok"] and best[0].similar_id == "b" and best[0].title == "space talk"
    with pytest.raises(ValueError):
        retrieve.similar_by_text(items, vectors, enc, asked, 0)
