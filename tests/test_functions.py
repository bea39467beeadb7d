import random
import tracemalloc
from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from storyspark import vocab as V
from storyspark.functions import mixes as M, names, numbers as N, prose as P, rules as R, text as T, times, urls
from storyspark.operators import draft as D


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first().y


def many(spark, cases, expr, kind="string"):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], f"i int, x {kind}").select(
        "i", expr(F.col("x")).alias("y")).collect()
    for r in rows:
        assert r.y == cases[r.i][1], (cases[r.i][0], r.y, cases[r.i][1])


def test_canonical_url(spark):
    many(spark, [
        ("https://WWW.Example.com/a/b/?utm_source=x&page=2#top", "https://www.example.com/a/b?page=2"),
        ("https://e.com", "https://e.com/"),
        ("https://e.com/a?at_medium=RSS&q=a%20b&empty=", "https://e.com/a?q=a+b"),
        ("http://e.com:8080/x/?ito=1&cmpid=2&NS_source=3", "http://e.com:8080/x"),
        ("https://e.com/a?q=%7Ex*", "https://e.com/a?q=~x%2A"),
    ], urls.canonical_url)


def test_other_url_forms(spark):
    many(spark, [("https://E.com/a/?q=1", "https://e.com/a"), ("http://e.com/a", ""), ("https://e.com/", "")],
         urls.pool_url)
    many(spark, [("http://E.com/a/", "http://e.com/a")], urls.selector_url)
    many(spark, [("https://www.e.com/a/?x=1#y", "e.com/a"), ("https://e.com:8443/a", "e.com:8443/a"),
                 ("https://u@e.com/a", "e.com/a"), ("https://e.com:bad/a", ""), ("https://e.com/", ""), (None, "")],
         urls.story_url_key)
    many(spark, [("https://e.com/a", True), ("https://e.com/videos/a", False), ("https://e.com/av/a", False),
                 ("https://e.com/watching-birds", True), ("http://e.com/a", False), ("", False)], urls.has_real_url)


def test_times(spark):
    fmt = lambda c: F.date_format(times.feed_time(c), "yyyy-MM-dd HH:mm:ss")     # noqa: E731
    many(spark, [("Mon, 27 Jul 2026 09:00:00 GMT", "2026-07-27 09:00:00"),
                 ("27 Jul 2026 09:00:00 +0900", "2026-07-27 00:00:00"), ("soon", None), ("", None)], fmt)
    iso = lambda c: F.date_format(times.iso_time(c), "yyyy-MM-dd HH:mm:ss")      # noqa: E731
    many(spark, [("2026-07-27T09:00:00Z", "2026-07-27 09:00:00"), ("2026-07-27T09:00:00+09:00", "2026-07-27 00:00:00"),
                 ("2026-07", None), (None, None)], iso)


def test_names(spark):
    many(spark, [("BBC News (World)", "bbc"), ("The Verge (Mobile)", "verge"), ("Local Times", "local times")],
         names.publisher_family)
    many(spark, [("BBC News (Science & Environment)", "bbc-news-science-environment")], names.slug)
    many(spark, [("The Verge", "verge"), ("News", "")], names.brand_key)


def test_tokens_and_counts(spark):
    many(spark, [("The drones and strikes of AI in 2026", ["2026", "drone", "strike"])], T.title_tokens)
    many(spark, [("a b's $5 100%", 4), ("", 0)], T.word_count)
    many(spark, [("3 min", 3), ("", 0), ("x", 0)], T.read_time_int)
    many(spark, [("x " * 50, ("x " * 50).strip()[:19].rstrip() + "…"), ("short", "short")], lambda c: T.trunc(c, 20))
    many(spark, [("<b>Tom &amp; Jerry&#x27;s</b> ", "Tom & Jerry's")], T.clean_text)


def test_sentences_keep_abbreviations_together(spark):
    text = ("Talks between the U.S. and Iran resumed on Monday in Geneva. Mr. Smith said the plan would take years to finish. "
            "Getty Images via somebody took this one here. Read more about the plan right here today. "
            "Prices rose sharply , officials said in a statement on Friday. Cut off sentences never survive the filter…")
    df = spark.createDataFrame([(text, "Daily Planet")], "text string, source string")
    clean = D.with_clean_sentences(df, "text", "source", "clean").first().clean
    assert clean == ["Talks between the U.S. and Iran resumed on Monday in Geneva.",
                     "Mr. Smith said the plan would take years to finish.",
                     "Prices rose sharply, officials said in a statement on Friday."]


def test_headline_glue(spark):
    got = spark.sql("""SELECT * FROM VALUES ('Fire kills eleven A wildfire swept through the valley on Sunday.', 'Fire kills eleven'),
        ('Fire kills eleven and more', 'Fire kills eleven'), ('Other text stays.', 'Fire kills eleven') AS t(s, h)""").select(
            T.strip_headline(F.col("s"), F.col("h")).alias("r")).collect()
    assert [r.r for r in got] == ["A wildfire swept through the valley on Sunday.", "", "Other text stays."]


def test_prose_rules(spark):
    good = "Officials in the capital said on Monday that the new plan will cut emissions by half."
    assert one(spark, good, P.summary_issues) == []
    assert "summary too short (<12 words)" in one(spark, "Too short.", P.summary_issues)
    issues = one(spark, "And the long negotiations went on for many hours on Monday night between the U.S.", P.summary_issues)
    assert "summary ends with a dangling phrase (e.g. 'between the U.S.')" in issues
    assert "summary starts with a context-free connective (e.g. 'And,')" in issues
    why = lambda c: P.why_issues(c, F.lit(good), F.lit("A headline about emissions"))     # noqa: E731
    assert one(spark, "", why) == ["whyItMatters empty"]
    assert "whyItMatters is copied verbatim from the summary" in one(spark, good, why)
    many(spark, [("This image made from video shows smoke.", True), ("Sweden joined NATO in 2024 after a vote.", False)],
         lambda c: T.is_caption(c) | T.is_metadata(c))
    assert one(spark, "Strikes , fighting went on", P.publish_issues) == ["whitespace before punctuation (scrape artifact)"]


def test_score_contract(spark):
    many(spark, [(7.0, "7"), (-0.0, "0"), (10.881481, "10.881481"), (-7.5, "-7.5"), (0.00001, None), (1.0000001, None),
                 (1001.0, None)], N.score_text, "double")


def test_numbers(spark):
    many(spark, [("60-day plan, two tankers, £38bn and 六十日間", ["2", "38", "380", "60"]),
                 ("１２人 and 500 million", ["12", "5", "500", "50000"]), ("二〇二六", [])], N.source_numbers)


def test_paste(spark):
    sentence = "これはとても長い日本語の文章でコピーの検査に使います"
    df = spark.createDataFrame([(sentence, sentence + "。別の文。"), (sentence[:15] + "が違う", sentence + "。"), ("短い", sentence)],
                               "line string, source string").withColumn("runs", N.paste_runs("line", "source"))
    got = df.select(F.size("runs").alias("n"), N.is_paste(F.col("runs"), "line", "source").alias("p")).collect()
    assert [(r.n, r.p) for r in got] == [(1, True), (1, False), (0, False)]


def test_paste_stretches_are_common_and_longest():
    rng = random.Random(7)
    for _ in range(300):
        line, source = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(2))
        runs, at = N._runs(line, source, 4), 0
        for run in runs:
            start = line.index(run, at)
            assert len(run) >= 4 and run in source
            assert not any(line[i:i + 4] in source for i in range(at, start) if i + 4 <= len(line))
            assert start + len(run) == len(line) or line[start:start + len(run) + 1] not in source
            at = start + len(run)
        assert not any(line[i:i + 4] in source for i in range(at, len(line) - 3))


def test_paste_of_long_repetitive_texts_in_linear_memory():
    rng = random.Random(1)
    line, source = ("".join(rng.choice("ab") for _ in range(20_000)) for _ in range(2))
    tracemalloc.start()
    runs, at = N._runs(line, source, 15), 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    for run in runs:
        start = line.index(run, at)
        at = start + len(run)
        assert run in source and (at == len(line) or line[start:at + 1] not in source)
    assert N._runs("a" * 20_000, "a" * 9_000, 15) == ["a" * 9_000, "a" * 9_000, "a" * 2_000]


def test_mix_identity_and_quotas(spark):
    df = spark.createDataFrame([(["U.S", "JP", "jpn"], ["AI", "Tech"])], "r array<string>, t array<string>")
    row = df.select(M.normalize_regions("r").alias("r"), M.normalize_topics("t").alias("t"),
                    M.quotas(M.normalize_regions("r")).alias("q")).first()
    assert row.r == ["japan", "united_states"] and row.t == ["ai", "tech"]
    assert row.q == {"united_states": 3, "japan": 2}
    assert one(spark, ["usa", "mars"], M.unsupported_regions, "array<string>") == ["mars"]


def test_forbidden_keys(spark):
    assert one(spark, '{"a":{"Prompt":1},"b":"file:///x"}', lambda c: M.forbidden_keys(c, ["prompt"])) == ["prompt"]
    assert one(spark, '{"b":"file:///x"}', M.has_local_path) is True
    assert one(spark, '{"b":"a \\\\"prompt\\\\": x"}', lambda c: M.forbidden_keys(c, ["prompt"])) == []


def test_a_rule_that_matches_is_never_screened_away(spark):
    """The one search for all literals finds every text that a pattern or phrase finds."""
    lines = ["By Jane Doe for the desk.", "It may earn a commiſſion here.", "A man holds a flag in the rain today.",
             "Pictured above: a dog.", "PHOTO TAKEN by hand.", "She writes about cats for Wired.",
             "Follow us on social media.", "Taken away by Getty Images.", "They joined Acme in 1999.",
             "Nothing of that kind is in here.", "", "KİND of a logın page.", "WATCH: the clip."]
    df = spark.createDataFrame([(x,) for x in lines], "s string")
    rules = [R.hits("s", p) for p in T._MARKS] + [R.contains_any(F.lower("s"), V.BOILERPLATE)]
    got = df.select("s", R.may_hit(R.folded("s"), T._MARKS, V.BOILERPLATE).alias("maybe"),
                    reduce(or_, rules).alias("found")).collect()
    assert all(r.maybe for r in got if r.found)
    assert sum(r.found for r in got) >= 7 and any(not r.maybe for r in got)


def test_sentence_rules_work_a_text_out_once(spark):
    """Folding a sentence and the key of its headline were repeated for every literal and comparison."""
    table = D.sentence_table(F.col("c"), F.col("t"), F.lit(True))
    plan = spark.createDataFrame([(["x"], "t")], "c array<string>, t string").select(
        table.alias("a"), D.without_headline(F.col("c"), F.col("t")).alias("b"))
    shown = plan._jdf.queryExecution().analyzed().toString()
    assert shown.count("ı") <= 2                      # one folding of a sentence
    assert shown.count("[^a-z0-9]+") <= 2                  # one key of the headline, one of a sentence


def test_glued_headlines_and_grounded_tokens_as_by_lists(spark):
    cases = [("Big News Today And then they all went home again.", "Big news today"), ("Big news today", "Big news today"),
             ("Big newsy today then they left.", "Big news"), ("Anything at all goes here.", ""), (None, "Big"),
             ("Big, news... TODAY: They all went home again early.", "big news today"), ("x y", None)]
    got = spark.createDataFrame(cases, "s string, h string").select(T.strip_headline(F.col("s"), F.col("h")).alias("r")).collect()
    assert [r.r for r in got] == ["And then they all went home again.", "Big news today", "Big newsy today then they left.",
                                  "Anything at all goes here.", None, "They all went home again early.", "x y"]
    pairs = [("Paris 2026 Rome -5% 26", "paris-2026 2026 -5%. Rome's 26"), ("Ab Abc", "xAbc abcx"), (None, "a"), ("Abc", None)]
    got = spark.createDataFrame(pairs, "d string, s string").select(T.ungrounded("d", "s").alias("r")).collect()
    assert [r.r for r in got] == [["-5%", "Paris", "Rome"], ["Abc"], [], ["Abc"]]
