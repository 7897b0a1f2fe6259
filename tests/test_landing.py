"""The feed table: three waves, replay, reads that do not grow, deletion."""
import os

from pyspark.sql import functions as F

from podium.operators import ingest
from podium.streaming import landing

ENTRY = ("id1", None, "l", "2024-01-01", None, None)


def wave(spark, rows):
    full = [(u, at, etag, None, ("t " + (etag or ""), None, "d", ["x"]) if s == 200 else None, [ENTRY] * n if s == 200 else None, s)
            for u, at, etag, n, s in rows]
    return spark.createDataFrame(full, landing.LANDED_SCHEMA)


FEEDS = [f"https://f/{i}" for i in range(40)]
WAVES = [
    [(u, "2024-01-01T00:00:00Z", f"e{i}", 1, 200) for i, u in enumerate(FEEDS[:30])] + [(FEEDS[39], "2024-01-01T00:00:00Z", None, 0, 500)],
    [(u, "2024-01-02T01:00:00+02:00", f"n{i}", 2, 200) for i, u in enumerate(FEEDS[:10])]
    + [(u, "2024-01-02T00:00:00Z", "lost", 0, 304) for u in FEEDS[10:20]] + [(u, "2024-01-02T00:00:00Z", None, 0, 503) for u in FEEDS[20:25]]
    + [(u, "2024-01-02T00:00:00Z", f"w{i}", 3, 200) for i, u in enumerate(FEEDS[30:35])],
    [(FEEDS[0], "2024-01-03T00:00:00Z", "z", 4, 200), (FEEDS[0], "2024-01-03T01:00:00+05:00", "older", 5, 200),
     (FEEDS[39], "2024-01-03T00:00:00Z", "back", 1, 200), (None, "2024-01-03T00:00:00Z", "nobody", 1, 200)],
]


def merged(spark, waves):
    """The batch form, wave by wave."""
    raw, state = spark.createDataFrame([], ingest.RAW_FEED_SCHEMA), spark.createDataFrame([], "feed_url string, etag string, last_modified string")
    for rows in waves:
        df = wave(spark, rows).where("feed_url is not null")
        ok = df.where("status = 200").drop("status")
        best = df.groupBy("feed_url").agg(F.max(F.struct((F.col("status") == 200).alias("ok"), F.to_timestamp("last_scraped_at").alias("at"),
                                                        "status", "etag", "last_modified")).alias("x")).select("feed_url", "x.status", "x.etag", "x.last_modified")
        raw, state = ingest.merge_feed_snapshots(raw, state, ok, best)
        raw, state = raw.cache(), state.cache()
    return {r.feed_url: (r.last_scraped_at, r.etag, len(r.entries)) for r in raw.collect()}, {r.feed_url: r.etag for r in state.collect()}


def content(table):
    return ({r.feed_url: (r.last_scraped_at, r.etag, len(r.entries)) for r in table.payloads().collect()},
            {r.feed_url: r.etag for r in table.state().collect()})


def test_stream_equals_batch_merge_over_three_waves_and_a_replay(spark, tmp_dir):
    table = landing.FeedTable(spark, tmp_dir + "/table", buckets=8)
    for i, rows in enumerate(WAVES):
        wave(spark, rows).coalesce(1).write.json(f"{tmp_dir}/in/w{i}")
        landing.start_feed_merge(table, tmp_dir + "/in/*", tmp_dir + "/ckpt").awaitTermination()
        assert content(table) == merged(spark, WAVES[:i + 1])
    done = table._batches()
    last = wave(spark, WAVES[2])
    before = {b: table._manifest(b) for b in done}
    table.merge(last, done[-1])                 # replayed after it was published: nothing moves
    assert {b: table._manifest(b) for b in table._batches()} == before and content(table) == merged(spark, WAVES)
    commits = sorted(f for f in os.listdir(tmp_dir + "/ckpt/commits") if f.isdigit())
    for name in (commits[-1], f".{commits[-1]}.crc"):       # the driver died before the commit: the stream runs the batch again
        os.remove(f"{tmp_dir}/ckpt/commits/{name}")
    landing.start_feed_merge(table, tmp_dir + "/in/*", tmp_dir + "/ckpt").awaitTermination()
    assert content(table) == merged(spark, WAVES)


def test_only_touched_buckets_are_rewritten_and_reads_do_not_grow(spark, tmp_dir):
    table = landing.FeedTable(spark, tmp_dir + "/table", buckets=8, keep=2)
    table.merge(wave(spark, WAVES[0]), 0)
    first = table._manifest(0)
    for i in range(1, 7):
        table.merge(wave(spark, [(FEEDS[0], f"2024-02-0{i}T00:00:00Z", f"v{i}", 1, 200)]), i)
    now = table._manifest(6)
    assert len(now) == len(first) and sum(now[b] != first[b] for b in now) == 1
    assert len(table.rows().inputFiles()) <= 8 and table._batches() == [5, 6]
    kept = [os.path.join(b, x) for b in os.listdir(tmp_dir + "/table/data") for x in os.listdir(f"{tmp_dir}/table/data/{b}") if x.startswith("bucket=")]
    assert len(kept) <= len(now) + 1            # what the two kept manifests name, no more
    assert content(table)[0][FEEDS[0]][1] == "v6" and len(content(table)[0]) == 30


def test_batch_that_was_never_published_leaves_no_trace(spark, tmp_dir, monkeypatch):
    table = landing.FeedTable(spark, tmp_dir + "/table", buckets=4)
    table.merge(wave(spark, WAVES[0]), 0)
    want = content(table)
    monkeypatch.setattr(landing.FeedTable, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    try:
        table.merge(wave(spark, WAVES[1]), 1)
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert content(table) == want
    table.merge(wave(spark, WAVES[1]), 1)       # run again
    assert content(table) == merged(spark, WAVES[:2])


def test_empty_table(spark, tmp_dir):
    table = landing.FeedTable(spark, tmp_dir + "/table")
    assert table.payloads().count() == 0 and table.state().count() == 0 and table.vacuum() == 0
    table.merge(wave(spark, []), 0)
    assert table.payloads().count() == 0 and table._batches() == [0]
