import datetime as dt

from pyspark.sql import functions as F

from storyspark.operators import lookup as L, pool as P
from storyspark.plans import jobs as J
from storyspark.sources import tables as TB

DAY = dt.date(2026, 7, 20)
GOOD = "Officials in the capital said on Monday that the new plan number {} will cut emissions by half."


def edition(spark, day=DAY, bad=None):
    rows = [(day, n, n, n == 1, "WORLD", "Local", f"Headline {n} of the day", GOOD.format(n), ["One thing.", "Two things."],
             f"Critics could still block plan {n} in court next year.", f"https://e.com/{day}/{n}", 2 if n != bad else None,
             f"https://i/{n}", "Here", "") for n in range(1, 6)]
    return spark.createDataFrame(rows, "edition_date date, number int, importance int, lead boolean, category string, source string, "
                                       "headline string, summary string, keyTakeaways array<string>, whyItMatters string, "
                                       "originalURL string, readTime int, imageURL string, placeTime string, audioURL string")


def manifest(spark, day=DAY):
    cap = [("explainer", "Hello there.", 1.5)]
    return spark.createDataFrame([(day, n, "dialogue", "en", None, f"audio/{day}/{n}.mp3", 0.0, cap) for n in range(1, 6)],
                                 "edition_date date, number int, format string, lang string, audioURL string, key string, gap double, "
                                 "captions array<struct<speaker:string,text:string,duration:double>>")


def test_publish_serves_only_complete_editions(spark, tmp_path):
    path = str(tmp_path / "editions")
    later = DAY + dt.timedelta(days=1)
    both = edition(spark).unionByName(edition(spark, later)).unionByName(edition(spark, DAY + dt.timedelta(days=2), bad=3))
    out = J.publish_job(both, path, manifest(spark), "https://cdn", F.lit("2026-07-21").cast("date"))
    assert {r.key for r in out.problems.collect()} == {"2026-07-22"}
    assert out.refused.count() == 0
    assert {(str(r.edition_date), r.outcome): r.n for r in out.outcomes.collect()} == {
        ("2026-07-20", "injected"): 5, ("2026-07-21", "no_entry"): 5}
    assert {str(r.edition_date) for r in out.latest.collect()} == {"2026-07-20"}       # the newer one has no audio yet
    again = J.publish_job(edition(spark), path, manifest(spark), "https://cdn", F.lit("2026-07-21").cast("date"))
    assert [str(r.edition_date) for r in again.refused.collect()] == ["2026-07-20"]
    assert [str(r.edition_date) for r in TB.stale_dates(edition(spark, DAY - dt.timedelta(days=3)), out.latest).collect()] == ["2026-07-17"]


def test_publish_refuses_dates_before_the_served_one(spark, tmp_path):
    path = str(tmp_path / "editions")
    today = F.lit("2026-07-21").cast("date")
    first = J.publish_job(edition(spark), path, manifest(spark), "https://cdn", today)
    assert first.refused.count() == 0
    older = DAY - dt.timedelta(days=3)
    out = J.publish_job(edition(spark, older), path, manifest(spark, older), "https://cdn", today, replace=True)
    assert [r.edition_date for r in out.refused.collect()] == [older]
    assert {r.edition_date for r in TB.published(spark, path).select("edition_date").distinct().collect()} == {DAY}
    again = J.publish_job(edition(spark), path, manifest(spark), "https://cdn", today, replace=True)
    assert again.refused.count() == 0 and again.latest.count() == 5
    assert TB.published(spark, str(tmp_path / "none")) is None


def test_lookup_falls_back_to_newest(spark):
    dates = spark.createDataFrame([(DAY,), (DAY + dt.timedelta(days=1),)], "edition_date date")
    asks = spark.createDataFrame([(1, dt.datetime(2026, 7, 20, 20), "Asia/Tokyo"), (2, dt.datetime(2026, 7, 20, 20), "UTC"),
                                  (3, dt.datetime(2026, 7, 25, 1), "UTC")], "id int, ts timestamp, timezone string")
    got = {r.id: (str(r.served_date), r.is_exact) for r in L.resolve_edition(asks, dates).collect()}
    assert got == {1: ("2026-07-21", True), 2: ("2026-07-20", True), 3: ("2026-07-21", False)}


def pool_rows(spark, n):
    rows = [(DAY, f"a{k:04d}", f"Headline {k}", GOOD.format(k), "Local", f"https://e.com/{k}", dt.datetime(2026, 7, 20), "WORLD", [],
             [("japan", "primary", ["japan:title"])], float(n - k), "high", [], f"url:{k}", (True, False, 0, 1, 1), True) for k in range(n)]
    return spark.createDataFrame(rows, "edition_date date, id string, headline string, summary string, source string, url string, "
                                 "published_at timestamp, category string, topics array<string>, memberships array<struct<id:string,"
                                 "strength:string,evidence:array<string>>>, base_score double, source_reliability string, fp array<string>, "
                                 "identity string, quality struct<eligible:boolean,paywalled:boolean,source_risk:int,cluster_size:int,"
                                 "cluster_sources:int>, eligible boolean")


def test_pool_publication(spark, tmp_path):
    path = str(tmp_path / "pools")
    good = pool_rows(spark, 16)
    old = good.withColumn("edition_date", F.date_sub("edition_date", 30))
    broken = good.withColumn("edition_date", F.date_sub("edition_date", 1)).withColumn("category", F.lit("Nope"))
    today = F.lit("2026-07-21").cast("date")
    status = {str(r.edition_date): r.status for r in TB.publish_pool(good.unionByName(old).unionByName(broken), path, today).collect()}
    assert status == {"2026-07-20": "published", "2026-06-20": "expired", "2026-07-19": "invalid"}
    back = TB.read_pool(spark, path, today)
    assert back.count() == 16
    assert P.pool_identity(back).first().pool_identity == P.pool_identity(good).first().pool_identity


def test_enrichment_fails_closed_below_the_minimum(spark):
    from storyspark.operators import images as I
    pool = pool_rows(spark, 16)
    body = " ".join(GOOD.format(k) for k in range(3)) + " Critics could still block the plan in court before the end of next year. " + \
        "Farmers in the north expect cheaper power once the first wells open in autumn."
    arts = pool.select("id", F.lit(body).alias("text"))
    images = I.ImagePools(spark.createDataFrame([("category", "WORLD", k, f"https://i/{k}", "p") for k in range(30)],
                                                "pool_kind string, pool_key string, pos int, imageURL string, placeTime string"), {})
    none = spark.createDataFrame([], "edition_date date, avoid array<string>")
    full = J.enrichment_job(pool, arts, images, none)
    assert full.dates.first().ok and full.pool.count() == 16 and P.validate_enriched(full.pool).count() == 0
    ident = P.editorial_identity(full.pool).first()
    assert ident.selector_pool_identity == P.pool_identity(pool).first().pool_identity
    few = J.enrichment_job(pool, arts.limit(10), images, none)
    assert few.dates.first().survivors == 10 and few.pool.count() == 0 and few.failures.count() == 6


def five_picks(spark, day):
    rows = [(day, n, f"s{n}", n, n == 1, None, f"Headline {n}", "Local", "WORLD", f"https://e.com/{n}", "Short.", False) for n in range(1, 6)]
    return spark.createDataFrame(rows, "edition_date date, seq int, id string, rank int, lead boolean, tag string, title string, "
                                       "source string, category string, url string, snippet string, paywalled boolean")


def test_newest_text_of_a_failed_story(spark):
    later = DAY + dt.timedelta(days=1)
    articles = spark.createDataFrame([(f"s{n}", f"old {n}") for n in range(1, 5)] + [("s1", "old 0")], "id string, text string")
    versions = spark.createDataFrame(
        [(DAY, "s1", 1, "first"), (DAY, "s1", 2, "second"), (DAY, "s1", 2, "second"), (DAY, "s2", 3, "not failed"), (later, "s3", 1, "other date"),
         (DAY, "s4", 1, " "), (DAY, "s4", 2, None)], "edition_date date, id string, version int, text string")
    failed = spark.createDataFrame([(DAY, "s1"), (DAY, "s3"), (DAY, "s4"), (DAY, "s5")], "edition_date date, id string")
    got = {r.id: r.text for r in J.newest_texts(articles, versions, failed).collect()}
    assert got == {"s1": "second", "s3": "old 3", "s4": "old 4", "s5": None}


def test_refetched_text_mends_only_its_story_and_date(spark):
    later = DAY + dt.timedelta(days=1)
    both = five_picks(spark, DAY).unionByName(five_picks(spark, later))
    body = " ".join(GOOD.format(k) for k in range(3)) + " Critics could still block the plan in court before the end of next year."
    articles = spark.createDataFrame([(f"s{n}", body) for n in (1, 2, 4, 5)], "id string, text string")
    versions = spark.createDataFrame([(DAY, "s3", 1, "thin"), (DAY, "s3", 2, body), (later, "s1", 9, "thin")],
                                     "edition_date date, id string, version int, text string")
    failed = spark.createDataFrame([(DAY, "s3"), (later, "s3")], "edition_date date, id string")
    got = J._with_texts(both, articles, versions, failed)
    used = {(r.edition_date, r.id): r.source_text_used for r in got.collect()}
    assert got.count() == len(used) == 10
    assert used[DAY, "s3"] == "full_article" and used[later, "s3"] == "rss_snippet" and used[later, "s1"] == "full_article"


def test_recovery_audit_and_its_limit(spark, monkeypatch):
    """A refetched text mends one date; a hopeless one is validated five times at most and stays unpublished."""
    later = DAY + dt.timedelta(days=1)
    body = " ".join(GOOD.format(k) for k in range(3)) + " Critics could still block the plan in court before the end of next year."
    monkeypatch.setattr(J, "edition_job", lambda cands, *_: J.E.Edition(*[cands] * len(J.E.Edition.__dataclass_fields__)))
    good = f" {body}"
    articles = spark.createDataFrame([(f"s{n}", good) for n in (1, 2, 4, 5)], "id string, text string")
    versions = spark.createDataFrame([(DAY, "s3", 1, body)], "edition_date date, id string, version int, text string")

    def verdicts(drafts, strict=True):
        return drafts.filter("source_text_used <> 'full_article'").select(
            F.col("edition_date").cast("string").alias("key"), F.lit("thin").alias("rule"), F.col("id").alias("field"), F.lit("no text").alias("message"))

    monkeypatch.setattr(J.D, "validate_drafts", verdicts)
    both = five_picks(spark, DAY).unionByName(five_picks(spark, later))
    out = J.recovery_job(both, None, articles, versions, max_replacement_rounds=9)
    log = {(r.edition_date, r.attempt): r for r in out.attempts.collect()}
    assert len(log) == 7 and max(a for _, a in log) == 5
    assert log[DAY, 1].actions == ["s3: refetch-retry"] and log[DAY, 1].hard == ["s3: no text"] and log[DAY, 2].result == "pass"
    assert log[later, 2].actions == ["s3: rejected"] and log[later, 3].actions == ["s3: replaced", "s3: rejected"]
    assert sorted((r.edition_date, r.id) for r in out.drafts.collect()) == [(DAY, f"s{n}") for n in range(1, 6)]
