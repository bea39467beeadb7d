"""What keeps the row work of large tables small: screened patterns, rows worked out once, small batches."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from storyspark import vocab as V
from storyspark.functions import numbers as N
from storyspark.functions.rules import folded, hits, needles
from storyspark.operators import duplicates as DU, history as H, mix as X, pool as PO, scoring as S
from storyspark.plans import inputs as I
from storyspark.session import prepare, written

TEXTS = ["The white house", "\u212aremlin \u017ftrike\u017f", "ME\u0130 ceasef\u0131re", "CEASEF\u0130RE now", "A m\u0131ss\u0131le, trade DEAL",
         "Dead and missing", "an \u00e9lection", "image made", "a dealer", "", None, "\u0421\u0430\u043d\u043a\u0446\u0438\u0438 \u65e5\u672c war", "collapse\u0301", "launche\u017f iPhone"]


def test_screened_search_equals_plain_search(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    patterns = [V.CRISIS, V.STAKES, V.CAPTION_MEDIA, V.LAUNCH_VERB, V.METADATA_CAPTION,
                *[p for p, _ in V.FINGERPRINT], *[p for _, p in V.EVENT_FAMILIES]]
    assert sum(bool(needles(p)) for p in patterns) > 0.9 * len(patterns)
    plain = df.select(*[hits("t", p).alias(f"c{i}") for i, p in enumerate(patterns)]).collect()
    quick = df.select(*[hits("t", p, folded("t")).alias(f"c{i}") for i, p in enumerate(patterns)]).collect()
    assert plain == quick and any(any(r) for r in plain)


def test_needles_are_in_every_match():
    assert needles(r"\b(iran|iranian|tehran)\b") == ("iran", "tehran")
    assert needles(r"\bcollaps\w*|\d+ dead\b") == (" dead", "collaps")
    assert needles(r"[a-z]+(?:abc)?") == () and needles(r"x|abc") == ()


def test_number_words_are_read_in_one_pass(spark):
    texts = ["one Two \uff13 three-fold often f\u0131ve \u017fix seven_ eight\u0301 n\u00e9nine 2 bn", "SEVENTH, tenth", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(N.source_numbers("t").alias("n"))
    assert [r.n for r in df.collect()] == [["1", "2", "20", "3", "5", "6"], ["10", "7"], []]
    assert "hundred\\b" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_pool_rows_are_worked_out_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(x):
        calls.add(1)
        return x

    when = dt.datetime(2026, 7, 20, 1)
    rows = [(dt.date(2026, 7, 20), i, f"h{i}", "A.com", f"https://a.com/x/{i % 2}", when, "WORLD") for i in range(4)]
    df = spark.createDataFrame(rows, "edition_date date, seq int, title string, source string, url string, "
                               "published_at timestamp, category string").withColumn("title", told("title")).selectExpr(
        "*", "timestamp'2026-07-20 09:00:00' now", "'' id", "url canonical_url", "title snippet", "false paywalled",
        "'high' source_reliability", "1L cluster_id", "1L cluster_size", "1L cluster_sources")
    found = PO.validate_pool(PO.freeze_pool(PO.build_pool(df)))
    assert found.filter("rule = 'unique' and field = 'url'").count() == 2
    assert calls.value <= 8, "a title goes into two columns, each worked out once"


def test_mix_rounds_aggregate_offers_only(spark):
    state = spark.createDataFrame([], "edition_date date, mix_id string, regions array<string>, topics array<string>, "
                                  f"order array<string>, quota map<string,int>, chosen {'array<' + X._MEMBER + '>'}")
    pool = spark.createDataFrame([], "edition_date date, id string, cat string, category string, family string, "
                                 "identity string, url string, sid struct<brand:string,product_family:string,"
                                 "covered_families:array<string>,event:string,event_family:string,is_roundup:boolean,"
                                 "is_product_story:boolean>, topics array<string>, primary array<string>, base double, "
                                 "barred string")
    plan = X._round(pool, state, X._columns(5))._jdf.queryExecution().optimizedPlan().toString()
    assert "any_value" not in plan and "min(_offer" in plan


def test_batches_of_texts_are_small(spark):
    @F.pandas_udf("int")
    def rows(x: pd.Series) -> pd.Series:
        return pd.Series([len(x)] * len(x))

    prepare(spark)
    assert spark.range(3000, numPartitions=1).select(F.max(rows("id"))).first()[0] <= 500


def test_words_of_a_title_need_not_split_the_text(spark):
    df = spark.createDataFrame([("  a b\tc  d e f ",), ("a b",), ("",)], "t string")
    got = df.select(I._words("t", 1, 4).alias("w"))
    assert [r.w for r in got.collect()] == [" a b c", "a b", ""]
    assert ", 5)" in got._jdf.queryExecution().optimizedPlan().toString()


def test_first_duplicates_without_all_pairs(spark, monkeypatch):
    rng, labels = random.Random(5), [label for _, label in V.FINGERPRINT]
    rows = [(d, rng.sample(labels, rng.choice([0, 1, 1, 2, 3])), str(i), rng.choice([None, *range(60)])) for d in ("a", "b", None) for i in range(70)]
    # No two of a group's fingerprints overlap before the last ones, which go through several rounds.
    rows += [("c", [label], "", i) for i, label in enumerate(labels)] + [("c", [labels[-1]], "x", 40), ("c", [labels[-3]], "x", 39)]
    rows += [("d", [label], "", 1) for label in labels] + [("e", [labels[0]], str(i), 7) for i in range(3)]
    df = spark.createDataFrame([(d, sorted(fp), s, q) for d, fp, s, q in rows], "edition_date string, fp array<string>, sid string, seq int")
    ents, themes = set(V.FINGERPRINT_ENTITIES), set(V.FINGERPRINT_THEMES)

    def alike(x, y):
        shared, union = set(x) & set(y), set(x) | set(y)
        e, t = len(shared & ents), len(shared & themes)
        return x and y and (e >= 2 or (e and t and 2 * len(shared) >= len(union)) or 10 * len(shared) >= 6 * len(union))

    want = {}
    for d, x, _, p in rows:
        for g, y, _, q in rows:
            if d and d == g and None not in (p, q) and p < q and alike(x, y):
                want[d] = min(want.get(d, (p, q)), (p, q))

    def never(*args, **kwargs):
        raise AssertionError("builds every pair")

    monkeypatch.setattr(DU, "duplicate_pairs", never)
    monkeypatch.setattr(DU, "HEADS", 2)
    got = {r.edition_date: (r.src, r.dst) for r in DU.first_duplicate_pair(df).collect()}
    assert got == want and set(want) == {"a", "b", "c"}


def test_only_editions_looked_back_to_are_classified(spark, monkeypatch):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(x):
        calls.add(1)
        return x

    plain = H.C.with_story_metadata
    monkeypatch.setattr(H.C, "with_story_metadata", lambda df, *a, **k: plain(df.withColumn("headline", told("headline")), *a, **k))
    targets, spent = spark.createDataFrame([(dt.date(2026, 7, 19),)], "edition_date date"), []
    for days in (6, 18):
        rows = [(dt.date(2026, 7, 18) - dt.timedelta(days=i), 1, "Earthquake in Turkey", f"https://a.com/x/{i}") for i in range(days)]
        eds = spark.createDataFrame(rows, "edition_date date, number int, headline string, originalURL string")
        before = calls.value
        pairs = H.history_pairs(targets, eds.withColumn("summary", F.lit("dozens dead"))).collect()
        assert [(r.country, r.run, r.run_dates) for r in pairs] == [("Turkey", 3, ["2026-07-18", "2026-07-17", "2026-07-16"])]
        spent.append(calls.value - before)
    assert 0 < spent[0] == spent[1], "three editions count, however many there are"


def test_pool_rows_are_dealt_out_before_they_are_classified(spark):
    """One file of small rows is one part; its rows reach every core before the rule ladders run."""
    cores = spark.sparkContext.defaultParallelism
    row = ("2026-07-20", "2026-07-20 09:00:00", 1, "a1", "Apple launches phone", "BBC News", "bbc", "TECH",
           "https://e.com/a", "https://e.com/a", "2026-07-20 06:00:00", "x" * 150, False, "high", ["us"], 1, 1, 1)
    kinds = ("date", "timestamp", "long", *["string"] * 7, "timestamp", "string", "boolean", "string",
             "array<string>", "long", "long", "long")
    given = spark.createDataFrame([row], S.CANDIDATE).select(
        *[F.col(c).cast(k).alias(c) for c, k in zip(S.CANDIDATE, kinds)]).coalesce(1)
    built = PO.build_pool(given)
    assert built.rdd.getNumPartitions() >= cores
    assert X.prepare(written(built, "one").coalesce(1)).rdd.getNumPartitions() >= cores
