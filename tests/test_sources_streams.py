import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from storyspark.sources import feeds, tables as TB
from storyspark.streaming import keyed as K

RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>x</title>
<item><title> One </title><link>https://e.com/1</link><description><![CDATA[<b>Hi</b>]]></description><pubDate>Mon, 27 Jul 2026 09:00:00 GMT</pubDate></item>
<item><title>T1</title><link>https://e.com/2</link></item></channel></rss>"""
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link rel="self" href="https://e.com/s"/>
<link href="https://e.com/a"/><summary>sum</summary><updated>2026-07-27T09:00:00Z</updated></entry></feed>"""


def test_feeds(spark, tmp_path):
    (tmp_path / "bbc-world.xml").write_text(RSS)
    (tmp_path / "the-verge.xml").write_text(ATOM)
    src = spark.createDataFrame([("BBC News (World)", "WORLD", False, "verified", None, "bbc-world"),
                                 ("The Verge", "TECH", False, "known", None, None), ("NPR", "WORLD", False, "known", None, None)],
                                "source string, category string, paywalled boolean, status string, region string, feed_id string")
    items = feeds.read_feeds(spark, str(tmp_path), src)
    got = {(r.source, r.position): r for r in items.collect()}
    assert got["BBC News (World)", 0].title == "One" and got["BBC News (World)", 0].description == "<b>Hi</b>"
    assert got["BBC News (World)", 1].title == "T1" and got["BBC News (World)", 1].pub_date == ""
    assert got["The Verge", 0].link == "https://e.com/a" and len(got) == 3
    assert [r.source for r in feeds.feed_failures(items, src).collect()] == ["NPR"]


def test_editions_and_immutability(spark, tmp_path):
    folder = tmp_path / "editions"
    folder.mkdir()
    (folder / "2026-07-20.json").write_text(json.dumps({"date": "2026-07-20", "focus": "MIXED", "version": 1, "signals": [
        {"number": 1, "headline": "h", "keyTakeaways": ["a"], "localized": {"ja": {"headline": "日本"}}}, {"number": 2}]}))
    (folder / "2026-07-21.json").write_text("{broken")
    (folder / "notes.json").write_text("{}")
    eds = TB.read_editions(spark, str(folder))
    rows = {r.number: r for r in eds.collect()}
    assert len(rows) == 2 and rows[1].localized["ja"].headline == "日本" and str(rows[1].edition_date) == "2026-07-20"
    out = str(tmp_path / "table")
    assert TB.write_edition(eds.select("edition_date", "number", "headline"), out).count() == 0
    again = eds.select("edition_date", "number", F.lit("new").alias("headline"))
    assert TB.write_edition(again, out).count() == 1
    assert {r.headline for r in spark.read.parquet(out).collect()} == {"h", None}
    assert TB.write_edition(again, out, replace=True).count() == 0
    assert {r.headline for r in spark.read.parquet(out).collect()} == {"new"}


def test_manifest_and_images(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"editions": {"2026-07-20": {"1": {"ja": "a.mp3"}, "2": {
        "format": "solo", "en": {"key": "b.mp3", "gap": 0.2, "captions": [{"speaker": "s", "text": "t", "duration": 1}]}}}}}))
    got = {(r.number, r.lang): r for r in TB.read_manifest(spark, str(tmp_path / "m.json")).collect()}
    assert got[1, "ja"].key == "a.mp3" and got[2, "en"].captions[0].duration == 1.0 and got[2, "en"].format == "solo"
    (tmp_path / "i.json").write_text(json.dumps({"category_pools": {"WORLD": [{"imageURL": "u", "placeTime": "p"}]}, "default_pool": [
        {"imageURL": "d", "placeTime": "p"}], "topic_pools": {}, "topic_keywords": {"ai": ["gpu"]}, "aliases": {"OTHER": "WORLD"}}))
    images, words, aliases = TB.load_image_pools(spark, str(tmp_path / "i.json"))
    assert images.count() == 2 and words.first().keyword == "gpu" and aliases.first().category == "OTHER"


def events(spark):
    start = dt.datetime(2026, 7, 20, 10)
    rows = [(k, i, start + dt.timedelta(seconds=7 * i + (k == "b")), "p" if i % 4 else "q")
            for k in ("a", "b") for i in range(30)]
    return spark.createDataFrame(rows, "user string, event_id long, ts timestamp, payload string"), rows


def test_quota_batch_and_stream(spark, tmp_path):
    df, rows = events(spark)
    batch = {(r.user, r.event_id): r for r in K.quota(df, "user", "ts", "event_id", 3, 60).collect()}
    seen = {}
    for k, i, ts, _ in sorted(rows, key=lambda r: (r[0], r[2])):
        w = (k, ts.replace(second=0))
        seen[w] = seen.get(w, 0) + 1
        assert batch[k, i].allowed == (seen[w] <= 3)
        assert batch[k, i].retry_after == (None if seen[w] <= 3 else 60 - ts.second)
    late = [(k, i, ts) for k, i, ts, _ in rows if i % 7 == 3]          # a few rows come after later ones
    parts = [[r for r in rows if r[1] % 7 != 3 and r[1] < 15], [r for r in rows if r[:3] in late],
             [r for r in rows if r[1] % 7 != 3 and r[1] >= 15], [flush(rows)]]
    out = streamed(spark, df, parts, tmp_path, lambda s: K.quota(s, "user", "ts", "event_id", 3, 60, "10 minutes"))
    live = {(r.user, r.event_id): (r.allowed, r.retry_after) for r in out}
    assert live == {k: (r.allowed, r.retry_after) for k, r in batch.items()}
    assert len(out) == len(rows)


def flush(rows):
    """A row of another key, so much later that the watermark passes all others."""
    return ("~flush", 10_000_000, max(r[2] for r in rows) + dt.timedelta(days=4000), "z")


def streamed(spark, df, parts, tmp_path, job, mode="append", progress=None):
    """Rows a stream gives out when the parts arrive one after the other; rows of the flush are left out."""
    from pyspark.sql import types as T

    schema = T.StructType(df.schema.fields)
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = (job(stream).writeStream.option("checkpointLocation", str(tmp_path / "cp")).outputMode(mode)
                 .trigger(availableNow=True)
                 .foreachBatch(lambda b, n: b.write.mode("append").parquet(str(tmp_path / "out"))))
        query = query.start()
        query.awaitTermination(180)
        assert query.exception() is None
        if progress is not None:
            progress.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = spark.read.parquet(str(tmp_path / "out"))
    return got.filter(~F.col(df.columns[0]).cast("string").isin("~flush", "-1")).collect()


def test_claims(spark):
    t0 = dt.datetime(2026, 7, 20)
    rows = [("k", 1, t0, "p"), ("k", 2, t0 + dt.timedelta(hours=1), "p"), ("k", 3, t0 + dt.timedelta(hours=2), "x"),
            ("k", 4, t0 + dt.timedelta(hours=24), "x"), ("k", 5, t0 + dt.timedelta(hours=47), "p")]
    df = spark.createDataFrame(rows, "key string, n int, ts timestamp, payload string")
    got = {r.n: r.outcome for r in K.first_claim(df, "key", "payload", "ts", "n").collect()}
    assert got == {1: "claimed", 2: "replay", 3: "conflict", 4: "claimed", 5: "conflict"}


def one_at_a_time(rows, hours):
    """Outcome per (key, order) of (key, order, time, payload) rows."""
    out, own = {}, {}
    for key, n, ts, payload in sorted(rows, key=lambda r: (str(r[0]), r[2], r[1])):
        if key not in own or ts >= own[key][0] + dt.timedelta(hours=hours):
            own[key] = (ts, payload)
            out[key, n] = "claimed"
        else:
            out[key, n] = "replay" if payload == own[key][1] else "conflict"
    return out


CLAIMS = "key string, n long, ts timestamp, payload string"


def random_claims(seed, n=400, days=40):
    rng = random.Random(seed)
    start = dt.datetime(2026, 7, 20)
    return [(rng.choice(["hot", "hot", "hot", "k", None, "rare%d" % rng.randrange(40)]), k,
             start + dt.timedelta(minutes=rng.randrange(days * 1440)), rng.choice(["p", "q", None])) for k in range(n)]


@pytest.mark.parametrize("seed, hours", [(1, 24), (2, 1), (3, 300)])
def test_claims_one_at_a_time(spark, seed, hours):
    rows = random_claims(seed)
    df = spark.createDataFrame(rows, CLAIMS)
    got = {(r.key, r.n): r.outcome for r in K.first_claim(df, "key", "payload", "ts", "n", hours).collect()}
    assert got == one_at_a_time(rows, hours)


def test_claims_ties_repeats_and_missing_times(spark):
    t0 = dt.datetime(2026, 7, 20)
    rows = [("k", 1, t0, "p"), ("k", 1, t0, "p"), ("k", 0, t0, "q"), ("k", 2, None, "p"), ("k", 3, t0, "q")]
    df = spark.createDataFrame(rows, CLAIMS)
    got = sorted((r.n, r.outcome or "") for r in K.first_claim(df, "key", "payload", "ts", "n").collect())
    assert got == [(0, "claimed"), (1, "conflict"), (1, "conflict"), (2, ""), (3, "replay")]
    assert K.first_claim(df.limit(0), "key", "payload", "ts", "n").count() == 0


def test_claims_of_many_days_take_few_rounds(spark, monkeypatch):
    rounds, plain = [], K.written

    def write(df, name="step"):
        rounds.append(name)
        return plain(df, name)

    monkeypatch.setattr(K, "written", write)
    start = dt.datetime(2026, 1, 1)
    rows = [("k", d, start + dt.timedelta(days=d), "p") for d in range(400)]
    got = K.first_claim(spark.createDataFrame(rows, CLAIMS), "key", "payload", "ts", "n", 24).collect()
    assert {r.outcome for r in got} == {"claimed"} and len(got) == 400
    assert rounds.count("claim-found") <= 10


def test_claim_stream_equals_batch(spark, tmp_path):
    """Every outcome, with rows that come late, a chunk smaller than the hot key, and state that ends."""
    rows = sorted(((k or "none", n, ts, p) for k, n, ts, p in random_claims(5, 600, 30)), key=lambda r: r[2])
    shuffled = [r for lo in range(0, len(rows), 20) for r in random.Random(lo).sample(rows[lo:lo + 20], len(rows[lo:lo + 20]))]
    parts = [shuffled[:200], shuffled[200:390], shuffled[390:], [flush(rows)]]
    df = spark.createDataFrame(rows, CLAIMS)
    batch = {r.n: r.outcome for r in K.first_claim(df, "key", "payload", "ts", "n").collect()}
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    states = []
    try:
        out = streamed(spark, df, parts, tmp_path,
                       lambda s: K.first_claim(s, "key", "payload", "ts", "n", delay="3 days"), progress=states)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert len(out) == len(rows) and {r.n: r.outcome for r in out} == batch
    assert set(batch.values()) == {"claimed", "replay", "conflict"}
    assert states[-1] == 1                                             # the flush row's own key


def test_claim_stream_on_the_events_table(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    rows = [tuple(r) for r in events.orderBy("ts").collect()]
    last = max(r[2] for r in rows) + dt.timedelta(days=400)
    parts = [rows[:len(rows) // 2], rows[len(rows) // 2:], [(-1, -1, last, "z")]]
    batch = {r.event_id: r.outcome for r in K.first_claim(events, "user_id", "event_type", "ts", "event_id", 168).collect()}
    out = streamed(spark, events, parts, tmp_path, lambda s: K.first_claim(s, "user_id", "event_type", "ts", "event_id", 168))
    assert {r.event_id: r.outcome for r in out} == batch and len(out) == len(rows)


def test_status_stream_forgets(spark, tmp_path):
    df, rows = events(spark)
    states = []
    parts = [rows[:20], rows[20:45], rows[45:], [rows[3]], [flush(rows)]]   # an old record comes again
    out = streamed(spark, df, parts, tmp_path, lambda s: K.latest_status(s, "user", "payload", "ts", "event_id"),
                   mode="update", progress=states)
    want = {r.user: (r.status, r.updated_at) for r in K.latest_status(df, "user", "payload", "ts", "event_id").collect()}
    newest = {u: max((r.updated_at, r.status) for r in out if r.user == u) for u in want}
    assert {u: (s, t) for u, (t, s) in newest.items()} == want
    assert states[:4] == [1, 2, 2, 2] and states[-1] == 1              # only the flush row's subject is left


def test_status_and_ingest_streams(spark, tmp_path):
    df, _ = events(spark)
    assert {r.user: r.status for r in K.latest_status(df, "user", "payload", "ts", "event_id").collect()} == {"a": "p", "b": "p"}
    now = dt.datetime(2026, 7, 20, 12)
    items = spark.createDataFrame([(1, "https://e.com/a?utm_x=1", now, now), (2, "https://e.com/a", now, now),
                                   (3, "https://e.com/b", None, now), (4, "https://e.com/c", now - dt.timedelta(hours=50), now)],
                                  "seq long, link string, published_at timestamp, now timestamp")
    assert {r.seq for r in K.stream_ingest(items).collect()} == {1, 3}
    items.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(items.schema).parquet(str(tmp_path / "in"))
    q = (K.stream_ingest(stream).writeStream.format("memory").queryName("ingest_out").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert {r.canonical_url for r in spark.table("ingest_out").collect()} == {"https://e.com/a", "https://e.com/b"}
