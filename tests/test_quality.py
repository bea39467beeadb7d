import json

from pyspark.sql import functions as F

from storyspark.operators import dialogue as DG, draft as D, images as I, quality as Q
from storyspark.operators.violations import error_categories
from storyspark import vocab as V

BODY = ("Officials in Kenya announced a new water plan on Monday after years of talks with villages. "
        "The plan could mean cleaner water for two million people across the dry northern region. "
        "Engineers will begin drilling the first wells before the end of the coming summer season. "
        "Farmers in the north told reporters that the wells would change daily life for their families. "
        "The government expects to spend about forty million dollars on the first stage of work. "
        "Critics warned that earlier plans had failed because pumps were not repaired in time.")


def items(spark, rows):
    return spark.createDataFrame(rows, "edition_date string, id string, title string, source string, url string, "
                                       "category string, snippet string, paywalled boolean, lead boolean")


def test_drafts(spark):
    rows = [("2026-07-20", "a", "Kenya announces new water plan", "Local", "https://e.com/a", "WORLD", "Short.", False, True),
            ("2026-07-20", "b", "No article here", "Local", "https://e.com/b", "WORLD", "Too short to use.", False, False),
            ("2026-07-20", "c", "Nothing at all", "Local", "https://e.com/c", "WORLD", "", False, False)]
    arts = spark.createDataFrame([("a", BODY)], "id string, text string")
    d = {r.id: r for r in D.draft(D.resolve_source_text(items(spark, rows), arts)).collect()}
    a = d["a"]
    assert a.summary == BODY.split(". ")[0] + "." and a.why.startswith("The plan could mean")
    assert len(a.key_takeaways) == 3 and a.confidence == "medium" and a.flags == ["extractive_draft"]
    assert d["b"].flags[:3] == ["extractive_draft", "thin_source", "rss_snippet_only"] and d["b"].summary == ""
    assert d["c"].flags == ["source_unavailable", "needs_review"] and d["c"].read_time == 0
    drafts = D.draft(D.resolve_source_text(items(spark, rows), arts))
    report = D.validation_report(drafts, D.validate_drafts(drafts)).first()
    assert report.result == "fail" and report.failed_ids == ["b", "c"]
    moved = drafts.withColumn("url", F.lit("https://e.com/x")).filter("id <> 'c'")
    assert {(r.rule, r.field) for r in D.draft_vs_selection(moved, drafts).collect()} == {
        ("url-changed", "a"), ("url-changed", "b"), ("selection-mismatch", "c")}


def test_joined_summary(spark):
    text = ("New rules begin on Monday in the city. Drivers must pay a daily fee to enter the centre of town. "
            "The fee rises again next year for larger cars.")
    row = [("2026-07-20", "a", "City fee begins", "Local", "https://e.com/a", "WORLD", "", False, True)]
    arts = spark.createDataFrame([("a", text)], "id string, text string")
    got = D.draft(D.resolve_source_text(items(spark, row), arts)).first()
    assert got.summary == "Drivers must pay a daily fee to enter the centre of town."
    short = "New rules begin on Monday in town. Drivers must pay a fee each day."
    arts = spark.createDataFrame([("a", short)], "id string, text string")
    assert D.draft(D.resolve_source_text(items(spark, row), arts)).first().summary == short


def signals(spark, rows):
    return spark.createDataFrame([("2026-07-20", json.dumps(r)) for r in rows], "d string, json string").select(
        F.to_date("d").alias("edition_date"), "json")


def story(n, **more):
    return {"number": n, "importance": n, "lead": n == 1, "summary": "s", "readTime": 2, "originalURL": f"https://e.com/{n}",
            "listen": {"format": "dialogue", "en": {"audioURL": f"https://c.e.com/audio/2026-07-20/{n}.mp3", "gap": 0,
                       "captions": [{"speaker": "a", "text": "b", "duration": 1.5}]}}, **more}


def test_structure_and_listen(spark):
    good = signals(spark, [story(n) for n in range(1, 6)])
    assert Q.validate_structure(good).count() == 0 and Q.validate_listen_ready(good).count() == 0
    assert Q.latest_edition(good).count() == 5
    assert Q.validate_pointer(good, good).count() == 0
    bad = signals(spark, [story(1, importance=3), story(2, lead=True, readTime="3 min"),
                          story(3, originalURL="https://e.com/", localized={"ja": {"headline": " "}}),
                          story(4, listen={"ja": {"captions": [{"speaker": "a", "text": "b", "duration": 0}]}})])
    found = {(r.rule, r.field) for r in Q.validate_structure(bad).collect()}
    assert {("count", "signals"), ("lead", "lead"), ("readTime", "signal 2"), ("url", "signal 3"),
            ("localized", "signal 3 localized.ja.headline"), ("listen", "signal 4 listen.ja.captions[0].duration")} == found
    assert {r.field for r in Q.validate_listen_ready(bad).collect()} == {"signal 4", "signals"}


def test_request_codes(spark):
    def doc(**more):
        base = {"date": "2026-07-27", "active": {"mode": "custom", "regions": ["japan"], "topics": []}, "pending": None,
                "selectorVersion": 3, "storyCount": 5}
        return json.dumps({**base, **more})
    mix = lambda r, t: {"mode": "custom", "regions": r, "topics": t}                     # noqa: E731
    cases = [(doc(), None), (doc(active=mix(["japan", "japan"], [])), "invalid_region"), (doc(active=mix([], [])), "invalid_region"),
             (doc(active=mix(["world"], ["x"])), "invalid_topic"), (doc(selectorVersion=2), "unsupported_selector_version"),
             (doc(date="2026-02-30"), "invalid_request"), (doc(extra=1), "invalid_request"), (doc(storyCount=4), "invalid_request"),
             (doc(pending=mix(["mars"], [])), "invalid_region"), ("[]", "invalid_request"), ("nonsense", "invalid_request")]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, json string")
    for r in df.select("i", Q.request_code(F.col("json")).alias("c")).collect():
        assert r.c == cases[r.i][1], cases[r.i]


def test_images(spark):
    pools = spark.createDataFrame([("category", "WORLD", 0, "https://i/1", "p"), ("category", "WORLD", 1, "https://i/2", "p"),
                                   ("topic", "space", 0, "https://i/3", "p"), ("default", "", 0, "https://i/4", "p")],
                                  "pool_kind string, pool_key string, pos int, imageURL string, placeTime string")
    conf = I.ImagePools(pools, {"space": ["orbit", "moon"]})
    rows = [("2026-01-02", 1, False, "WORLD", "War"), ("2026-01-02", 2, False, "WORLD", "Peace"), ("2026-01-02", 3, True, "TECH", "In orbit"),
            ("2026-01-02", 4, False, "WORLD", "More"), ("2026-01-02", 5, False, "TECH", "To the moon")]
    df = spark.createDataFrame(rows, "d string, number int, lead boolean, category string, headline string").select(
        F.to_date("d").alias("edition_date"), "number", "lead", "category", "headline", F.lit("").alias("summary"))
    recent = spark.createDataFrame([("2026-01-02", ["https://i/2"])], "d string, avoid array<string>").select(
        F.to_date("d").alias("edition_date"), "avoid")
    got = {r.number: (r.imageURL, r.tier) for r in I.assign_images(df, conf, recent).collect()}
    assert got[3] == ("https://i/3", "topic") and got[1] == ("https://i/1", "category")
    assert got[2] == ("https://i/4", "cross-pool") and got[4] == ("https://i/2", "reused") and got[5] == ("", "none")


def test_error_categories(spark):
    df = spark.createDataFrame([("candidate id collision: a; invalid now: x; something else",)], "message string")
    got = {r.category: r.n for r in error_categories(df, V.POOL_ERROR_CATEGORIES).collect()}
    assert got == {"duplicate_candidate_id": 1, "invalid_timestamp": 1, "unknown_mix_pool_error": 1}


def test_turns_across_ranges(spark):
    import random
    rng = random.Random(2)
    rows, want = [], {}
    for key in "xyz":
        who, turn, run = "A", 0, 0
        for line in range(50):
            nxt = rng.choice("AB") if rng.random() < 0.4 else who
            turn, run = (turn, run + 1) if line and nxt == who else (turn + 1, 1)
            who = nxt
            rows.append((key, line, who))
            want[key, line] = (turn, run)
    df = spark.createDataFrame(rows, "key string, line int, speaker string")
    for width in (4, 10_000):
        got = {(r.key, r.line): (r.turn_no, r.run) for r in DG.speaker_turns(df, width=width).collect()}
        assert got == want


def test_tracks_merge_without_overwriting(spark):
    cap = [("a", "b", 1.0)]
    manifest = spark.createDataFrame(
        [("2026-07-20", 1, None, "en", None, "audio/1.mp3", -1.0, cap), ("2026-07-20", 2, "solo", "ja", "https://x/2.mp3", None, 0.5, cap),
         ("2026-07-20", 3, None, "en", None, None, 0.0, cap)],
        "edition_date string, number int, format string, lang string, audioURL string, key string, gap double, "
        "captions array<struct<speaker:string,text:string,duration:double>>")
    old = {"en": ("https://x/old.mp3", 0.0, cap)}
    eds = spark.createDataFrame([("2026-07-20", n, None, old if n == 2 else None) for n in (1, 2, 3, 4)],
                                f"edition_date string, number int, listen_format string, listen {DG.TRACKS}")
    got = {r.number: r for r in DG.inject_tracks(eds, manifest, "https://cdn/").collect()}
    assert [got[n].outcome for n in (1, 2, 3, 4)] == ["injected", "merged", "skipped", "no_entry"]
    assert got[1].listen["en"].audioURL == "https://cdn/audio/1.mp3" and got[1].listen["en"].gap == 0.0
    assert got[2].listen["en"].audioURL == "https://x/old.mp3" and got[2].listen["ja"].gap == 0.5
    counts = {r.outcome: r.n for r in DG.outcome_counts(DG.inject_tracks(eds, manifest, "https://cdn/")).collect()}
    assert counts == {"injected": 1, "merged": 1, "skipped": 1, "no_entry": 1}


def test_script_rules(spark):
    lines = spark.createDataFrame([("k", 1, "listener", "これはなぜ重要なのですか?"), ("k", 2, "explainer", "60日の計画だからです。"),
                                   ("k", 3, "listener", "なるほど。"), ("k", 4, "explainer", "99人が参加しました。"),
                                   ("k", 5, "explainer", "OpenAIの話です。"), ("k", 6, "explainer", "速報です。")],
                                  "key string, line int, speaker string, text string")
    stories = spark.createDataFrame([("k", "A sixty day plan", "別の文")], "key string, source string, translation string")
    found = {(r.rule, r.field) for r in DG.validate_dialogue(lines, stories).collect()}
    assert {("shape", "line 3"), ("number", "line 4"), ("name", "line 5"), ("phrase", "line 6"), ("shape", "line 6"),
            ("shape", "questions")} == found
    solo = {(r.rule, r.field) for r in DG.validate_narration(lines, stories).collect()}
    assert ("shape", "line 1") in solo and ("number", "line 4") in solo and ("shape", "sentences") not in solo
