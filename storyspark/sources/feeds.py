"""Feed documents and the source registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names

RSS = ("channel struct<item:array<struct<title:string,link:string,description:string,"
       "pubDate:string>>>")
ATOM = ("entry array<struct<title:string,link:array<struct<_href:string,_rel:string>>,"
        "summary:string,updated:string,published:string>>")


def load_sources(df: DataFrame) -> DataFrame:
    """Registry rows with their feed slug and reliability.

    ``df``: source (or name), category, paywalled, status, region, feed_id.
    """
    named = df if "source" in df.columns else df.withColumnRenamed("name", "source")
    return named.withColumns({
        "slug": names.slug(F.coalesce("feed_id", "source")),
        "source_reliability": names.reliability("status")})


def read_feeds(spark: SparkSession, path: str, sources: DataFrame) -> DataFrame:
    """Items of cached feed files ``<slug>.xml`` in document order.

    RSS items are read from every document; Atom entries only from documents without an item.
    Schemas are given, so every value stays text.  Adds source and position.
    """
    def load(tag: str, schema: str) -> DataFrame:
        return (spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
                .withColumn("slug", F.regexp_extract(F.col("_metadata.file_name"), r"([^/]+)\.xml$", 1)))

    def item(link, description, pub_date):
        return [F.col("slug"), F.col("pos").alias("position"),
                F.trim(F.coalesce("i.title", F.lit(""))).alias("title"), link.alias("link"),
                F.coalesce(description, F.lit("")).alias("description"), pub_date.alias("pub_date")]

    rss = load("rss", RSS).select("slug", F.posexplode("channel.item").alias("pos", "i")).select(
        *item(F.trim(F.coalesce("i.link", F.lit(""))), F.col("i.description"),
              F.coalesce("i.pubDate", F.lit(""))))
    alternate = F.filter("i.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    atom = load("feed", ATOM).select("slug", F.posexplode("entry").alias("pos", "i")).select(
        *item(F.coalesce(F.get(F.reverse(alternate), F.lit(0))["_href"], F.lit("")),
              F.col("i.summary"), F.coalesce("i.updated", "i.published", F.lit(""))))
    only_atom = atom.join(rss.select("slug").distinct(), "slug", "left_anti")
    reg = load_sources(sources).select("slug", "source")
    return rss.unionByName(only_atom).join(reg, "slug")


def feed_failures(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources that delivered no items, with the reason (part of the A4 report)."""
    seen = items.select("source").distinct()
    return load_sources(sources).join(seen, "source", "left_anti").select(
        "source", F.lit("no-items").alias("reason"))
