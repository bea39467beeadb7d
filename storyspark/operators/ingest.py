"""Ingest filters, first occurrences, cluster statistics and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import names, text as T, times, urls
from ..functions.rules import hits, text

DATE = "edition_date"


def first_by(df: DataFrame, keys: list[str], order: str, flag: str = "is_first") -> DataFrame:
    """Flag the first row per key in ``order``.

    The first position is a partial aggregate joined back, so a key that holds a large share of
    the rows is never sorted in one task.
    """
    firsts = df.groupBy(*keys).agg(F.min(order).alias("_first"))
    return (df.join(firsts, keys).withColumn(flag, F.col(order) == F.col("_first"))
            .drop("_first"))


def ingest_filter(items: DataFrame, max_age_hours: int = 36) -> DataFrame:
    """Add ``canonical_url``, ``published_at`` and ``skip_reason`` (NULL = kept) to raw items.

    Input: edition_date, now, seq, title, link, pub_date.  First matching reason wins: no-link,
    homepage, video, stale, dup (an earlier kept row of the date has the same canonical URL).
    """
    published = (F.col("published_at") if "published_at" in items.columns
                 else times.feed_time("pub_date"))
    reason = (F.when((text("link") == "") | (text("title") == ""), F.lit("no-link"))
              .when(urls.is_homepage("link"), F.lit("homepage"))
              .when(hits("link", V.INGEST_VIDEO_PATH), F.lit("video"))
              .when(times.is_stale("published_at", "now", max_age_hours), F.lit("stale")))
    timed = items.withColumn("published_at", published)
    marked = timed.withColumns({"canonical_url": urls.canonical_url("link"),
                                "skip_reason": reason})
    kept_seq = F.when(F.col("skip_reason").isNull(), F.col("seq"))
    firsts = marked.groupBy(DATE, "canonical_url").agg(F.min(kept_seq).alias("_first"))
    return (marked.join(firsts, [DATE, "canonical_url"])
            .withColumn("skip_reason", F.when(F.col("skip_reason").isNotNull(), F.col("skip_reason"))
                        .when(F.col("seq") != F.col("_first"), F.lit("dup")))
            .drop("_first"))


def to_candidates(kept: DataFrame, sources: DataFrame) -> DataFrame:
    """Kept items joined to the source registry, in candidate shape (M3, no clusters yet)."""
    reg = sources.select("source", F.coalesce("category", F.lit("OTHER")).alias("category"),
                         F.coalesce("paywalled", F.lit(False)).alias("paywalled"),
                         names.reliability("status").alias("source_reliability"),
                         F.when(F.col("region").isNotNull(), F.array("region")).otherwise(
                             F.array().cast("array<string>")).alias("structured_regions"))
    return kept.join(reg, "source").select(
        DATE, "now", "seq", urls.stable_id("canonical_url").alias("id"),
        T.clean_text("title").alias("title"), "source",
        names.publisher_key("source").alias("publisher"), "category",
        F.col("link").alias("url"), "canonical_url", "published_at",
        T.snippet("description").alias("snippet"), "paywalled", "source_reliability",
        "structured_regions")


def cluster_stats(df: DataFrame) -> DataFrame:
    """Add cluster_size and cluster_sources (distinct publishers) per (date, cluster) (A2).

    Publishers are pre-aggregated, so a hot cluster shuffles one row per publisher and task.
    """
    pub = F.coalesce("publisher", "source") if "publisher" in df.columns else F.col("source")
    per_pub = df.groupBy(DATE, "cluster_id", pub.alias("_p")).agg(F.count("*").alias("_n"))
    stats = per_pub.groupBy(DATE, "cluster_id").agg(
        F.sum("_n").alias("cluster_size"), F.count("*").alias("cluster_sources"))
    return df.join(stats, [DATE, "cluster_id"])


def id_collisions(df: DataFrame) -> DataFrame:
    """Ids that stand for more than one canonical URL on a date."""
    urls_per_id = df.select(DATE, "id", "canonical_url").distinct()
    return (urls_per_id.groupBy(DATE, "id").agg(F.count("*").alias("urls"))
            .filter(F.col("urls") > 1))


def reason_counts(df: DataFrame, reason: str) -> DataFrame:
    """Rows per date and reason; kept rows count under 'kept' (A5)."""
    return df.groupBy(DATE, F.coalesce(reason, F.lit("kept")).alias("reason")).agg(
        F.count("*").alias("n"))


def ingest_report(df: DataFrame) -> DataFrame:
    """Candidates per date and source (A4)."""
    return df.groupBy(DATE, "source").agg(F.count("*").alias("candidates"))


def cluster_report(df: DataFrame) -> DataFrame:
    """Clusters of two or more rows with the first title and the outlets' first words (A4).

    Outlets are distinct before they are collected: at most one entry per source.
    """
    multi = df.filter(F.col("cluster_size") > 1)
    outlets = multi.select(DATE, "cluster_id", F.split("source", " ")[0].alias("outlet")).distinct()
    lists = outlets.groupBy(DATE, "cluster_id").agg(
        F.array_join(F.array_sort(F.collect_list("outlet")), ", ").alias("outlets"))
    heads = multi.groupBy(DATE, "cluster_id").agg(
        F.max("cluster_size").alias("cluster_size"), F.min_by("title", "seq").alias("title"))
    return heads.join(lists, [DATE, "cluster_id"])


def prepare_pool_source(df: DataFrame) -> DataFrame:
    """Add ``drop_reason`` for rows the pool contract cannot represent; first copy wins."""
    canon = urls.pool_url(F.coalesce(F.when(text("canonical_url") != "", F.col("canonical_url")),
                                     F.col("url")))
    empty = ((T.py_strip(text("title")) == "") | (T.py_strip(text("snippet")) == "")
             | (T.py_strip(text("source")) == ""))
    reason = (F.when(empty, F.lit("empty_copy"))
              .when(F.col("_canon") == "", F.lit("unusable_url"))
              .when(F.col("published_at").isNull(), F.lit("invalid_timestamp")))
    marked = df.withColumn("_canon", canon).withColumn("drop_reason", reason)
    kept_seq = F.when(F.col("drop_reason").isNull(), F.col("seq"))
    firsts = marked.groupBy(DATE, "_canon").agg(F.min(kept_seq).alias("_first"))
    return (marked.join(firsts, [DATE, "_canon"])
            .withColumn("drop_reason", F.when(F.col("drop_reason").isNotNull(), F.col("drop_reason"))
                        .when(F.col("seq") != F.col("_first"), F.lit("duplicate_canonical")))
            .drop("_first", "_canon"))
