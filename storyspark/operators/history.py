"""Recent editions: history runs, repeat guard, image cooldown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import classify as C, text as T, urls
from ..session import written

DATE = "edition_date"


def recent_editions(targets: DataFrame, editions: DataFrame, n: int) -> DataFrame:
    """(edition_date, prior_date, edition_rank): last n edition dates strictly before each target.

    Works on distinct dates only: every date gets the number of editions before it, and the last
    n positions are an equi-join (W3).
    """
    prior = editions.select(F.col(DATE).alias("d")).distinct().withColumn("e", F.lit(1))
    wanted = targets.select(F.col(DATE).alias("d")).distinct().withColumn("w", F.lit(1))
    calendar = prior.join(wanted, "d", "full_outer")
    before = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, -1)
    numbered = calendar.withColumn("pos", F.coalesce(F.sum("e").over(before), F.lit(0)))
    places = numbered.filter("w = 1").select(
        F.col("d").alias(DATE), "pos", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("edition_rank")
    ).select(DATE, "edition_rank", (F.col("pos") - F.col("edition_rank")).alias("at"))
    return places.join(numbered.filter("e = 1").select(F.col("d").alias("prior_date"),
                                                       F.col("pos").alias("at")), "at").drop("at")


def _looked_back_to(near: DataFrame, editions: DataFrame, *columns: str) -> DataFrame:
    """The stories of editions that some target looks back to; written, so that only these are classified."""
    days = near.select(F.col("prior_date").alias(DATE)).distinct()
    return written(editions.select(DATE, *columns).join(days, DATE, "left_semi"), "recent")


def consecutive_run(ranks: Column) -> Column:
    """Length of the run 1, 2, 3, ... at the start of a sorted rank array."""
    return F.aggregate(ranks, F.lit(0), lambda acc, r: F.when(r == acc + 1, r).otherwise(acc))


def history_pairs(targets: DataFrame, editions: DataFrame,
                  n: int = V.HISTORY_EDITIONS) -> DataFrame:
    """(edition_date, country, event_family, run, run_dates) with run > 0."""
    near = written(recent_editions(targets, editions, n), "near")
    told = C.with_story_metadata(_looked_back_to(near, editions, "headline", "summary"), "headline", "summary").select(
        F.col(DATE).alias("prior_date"), F.col("mm.country").alias("country"),
        F.col("mm.event_family").alias("event_family")).filter(
            F.col("country").isNotNull() & (F.col("event_family") != "other")).distinct()
    ranks = near.join(told, "prior_date")
    runs = ranks.groupBy(DATE, "country", "event_family").agg(
        F.array_sort(F.collect_set(F.struct("edition_rank", "prior_date"))).alias("hits"))
    run = consecutive_run(F.transform("hits", lambda h: h["edition_rank"].cast("int")))
    return runs.withColumn("run", run).filter(F.col("run") > 0).select(
        DATE, "country", "event_family", "run",
        F.transform(F.slice("hits", F.lit(1), F.col("run")),
                    lambda h: h["prior_date"].cast("string")).alias("run_dates"))


def with_history(df: DataFrame, editions: DataFrame) -> DataFrame:
    """Add ``run`` and ``run_dates`` to candidates carrying ``mm``."""
    pairs = history_pairs(df, editions).withColumnsRenamed(
        {"country": "_c", "event_family": "_f"})
    return df.withColumns({"_c": F.col("mm.country"), "_f": F.col("mm.event_family")}).join(
        pairs, [DATE, "_c", "_f"], "left").drop("_c", "_f").withColumn(
            "run", F.coalesce("run", F.lit(0)))


def recent_stories(targets: DataFrame, editions: DataFrame,
                   n: int = V.EXACT_COOLDOWN_EDITIONS) -> DataFrame:
    """One row per target date: ``priors``, the stories of its last n editions, newest first.

    An edition is five stories by contract, so the array holds at most 5 n of them.
    """
    near = written(recent_editions(targets, editions, n), "near")
    recent = _looked_back_to(near, editions, "number", "headline", "summary", "originalURL")
    told = C.with_story_identity(C.with_story_metadata(recent, "headline", "summary"), "headline", "summary")
    stories = told.select(
        F.col(DATE).alias("prior_date"), "number", "headline",
        urls.story_url_key("originalURL").alias("url_key"),
        T.headline_key("headline").alias("headline_key"), "sid")
    return near.join(stories, "prior_date").groupBy(DATE).agg(F.array_sort(F.collect_list(F.struct(
        "edition_rank", "number", "prior_date", "headline", "url_key", "headline_key", "sid"
    ).cast("struct<edition_rank:bigint,number:bigint,prior_date:date,headline:string,"
           "url_key:string,headline_key:string,sid:struct<brand:string,product_family:string,"
           "covered_families:array<string>,event:string,event_family:string,is_roundup:boolean,"
           "is_product_story:boolean>>"))).alias("priors"))


def recent_repeats(df: DataFrame, editions: DataFrame) -> DataFrame:
    """Add ``repeat_rule``, ``repeat_reason`` and ``prior_date`` to candidates with ``sid``.

    URL or headline seen in the last seven editions, or the same product story in the last three;
    the newest prior row that matches decides.
    """
    url_key = urls.story_url_key(F.coalesce(
        F.when(F.col("canonical_url") != "", F.col("canonical_url")), F.col("url")))

    def rule(p):
        product = C.same_story_rule(F.col("sid"), p["sid"])
        return (F.when((F.col("_u") != "") & (F.col("_u") == p["url_key"]),
                       F.lit("recent-exact-url"))
                .when((F.col("_h") != "") & (F.col("_h") == p["headline_key"]),
                      F.lit("recent-exact-headline"))
                .when((p["edition_rank"] <= V.PRODUCT_COOLDOWN_EDITIONS)
                      & product.isin(C.SAME_STORY_RULES),
                      F.concat(F.lit("recent-"), product)))

    priors = recent_stories(df.select(DATE), editions)
    keyed = df.withColumns({"_u": url_key, "_h": T.headline_key("title")}).join(priors, DATE, "left")
    first = F.get(F.filter(F.transform("priors", lambda p: F.struct(
        rule(p).alias("rule"), p.alias("prior"))), lambda x: x["rule"].isNotNull()), F.lit(0))
    found = keyed.withColumn("_x", first)
    prior, name = F.col("_x.prior"), F.col("_x.rule")
    why = F.when(name == "recent-exact-url", F.concat(
        F.lit("same article URL already ran on "), prior["prior_date"].cast("string"))).when(
            name == "recent-exact-headline", F.concat(
                F.lit("same headline already ran on "), prior["prior_date"].cast("string"))).when(
                    name.isNotNull(), F.concat(
                        F.lit("same consumer-product story as "),
                        prior["prior_date"].cast("string"), F.lit(" — "), C.same_story_reason(
                            F.regexp_replace(name, "^recent-", ""), F.col("sid"), prior["sid"])))
    return found.withColumns({"repeat_rule": name, "repeat_reason": why,
                              "prior_date": prior["prior_date"]}).drop("_u", "_h", "_x", "priors")


def image_cooldown(targets: DataFrame, editions: DataFrame,
                   window: int = V.IMAGE_COOLDOWN_EDITIONS) -> DataFrame:
    """(edition_date, imageURL) used by the last ``window`` editions before each target."""
    used = editions.filter(F.coalesce(F.col("imageURL"), F.lit("")) != "").select(
        F.col(DATE).alias("prior_date"), "imageURL").distinct()
    return recent_editions(targets, editions, window).join(used, "prior_date").select(
        DATE, "imageURL").distinct()


def recent_images(targets: DataFrame, editions: DataFrame,
                  window: int = V.IMAGE_COOLDOWN_EDITIONS) -> DataFrame:
    """One row per target date: sorted ``avoid`` URLs (at most five per edition in the window)."""
    return image_cooldown(targets, editions, window).groupBy(DATE).agg(
        F.array_sort(F.collect_set("imageURL")).alias("avoid"))


def image_reuse(editions: DataFrame, window: int = V.IMAGE_COOLDOWN_EDITIONS) -> DataFrame:
    """Violations: signals of the newest edition that reuse an image of the window (V6)."""
    newest = editions.agg(F.max(DATE).alias(DATE))
    signals = editions.join(newest, DATE)
    hit = signals.join(image_cooldown(newest, editions, window), [DATE, "imageURL"])
    return hit.select(
        F.col(DATE).cast("string").alias("key"), F.lit("image-reuse").alias("rule"),
        F.concat(F.lit("signal "), F.col("number").cast("string")).alias("field"),
        F.concat(F.lit(f"reuses an imageURL from the last {window} editions: "),
                 F.col("imageURL")).alias("message"))
