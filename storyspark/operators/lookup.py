"""Edition lookup and assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.rules import text

DATE = "edition_date"


def resolve_edition(requests: DataFrame, dates: DataFrame) -> DataFrame:
    """Edition date served to each request: its local date, else the newest one.

    ``requests``: ts (UTC) and timezone.  Adds local_date, served_date and is_exact.
    """
    local = requests.withColumn("local_date", F.to_date(F.from_utc_timestamp("ts", F.col("timezone"))))
    known = dates.select(F.col(DATE).alias("local_date"), F.lit(True).alias("_have")).distinct()
    newest = dates.agg(F.max(DATE).alias("_newest")).withColumn("_one", F.lit(1))
    return (local.join(known, "local_date", "left").withColumn("_one", F.lit(1))
            .join(newest, "_one", "left")
            .withColumns({"is_exact": F.coalesce("_have", F.lit(False)),
                          "served_date": F.when(F.col("_have"), F.col("local_date")).otherwise(
                              F.col("_newest"))}).drop("_have", "_newest", "_one"))


def assemble_edition(ranked: DataFrame) -> DataFrame:
    """Edition rows from ranked stories: number = importance = rank, rank 1 leads.

    ``ranked``: edition_date, rank, category, source, title, summary, key_takeaways, why, url,
    read_time, imageURL, placeTime.
    """
    return ranked.select(
        DATE, F.col("rank").cast("int").alias("number"), F.col("rank").cast("int").alias("importance"),
        (F.col("rank") == 1).alias("lead"), F.coalesce("category", F.lit("OTHER")).alias("category"),
        "source", F.col("title").alias("headline"), "summary",
        F.col("key_takeaways").alias("keyTakeaways"), F.col("why").alias("whyItMatters"),
        F.col("url").alias("originalURL"), T.read_time_int(F.col("read_time").cast("string"))
        .alias("readTime"), text("imageURL").alias("imageURL"), text("placeTime").alias("placeTime"),
        F.lit("").alias("audioURL"))


def assemble_mix(picks: DataFrame, enriched: DataFrame) -> DataFrame:
    """Feed rows of every complete mix, in selector order (P14); short mixes are left out."""
    full = picks.groupBy(DATE, "mix_id").agg(F.count("*").alias("_n")).filter("_n = 5")
    story = enriched.select(DATE, "id", "editorial.*")
    rows = picks.select(DATE, "mix_id", "rank", "id").join(full, [DATE, "mix_id"], "left_semi")
    return rows.join(story, [DATE, "id"]).select(
        DATE, "mix_id", F.col("rank").cast("int").alias("number"),
        F.col("rank").cast("int").alias("importance"), (F.col("rank") == 1).alias("lead"),
        "category", "source", "headline", "summary", "keyTakeaways", "whyItMatters", "originalURL",
        "readTime", "imageURL", "placeTime", "audioURL")
