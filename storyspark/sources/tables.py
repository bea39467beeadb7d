"""Candidate, edition, manifest, image and pool tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import times
from ..operators import pool as P
from ..operators.dialogue import TRACK
from ..session import written

DATE = "edition_date"
CANDIDATE = (
    "generated_at string, candidates array<struct<id:string,title:string,source:string,"
    "publisher:string,category:string,url:string,canonical_url:string,published_at:string,"
    "snippet:string,paywalled:boolean,source_reliability:string,structured_regions:array<string>,"
    "cluster_id:bigint,cluster_size:bigint,cluster_sources:bigint>>")
BLOCK = ("struct<headline:string,summary:string,keyTakeaways:array<string>,whyItMatters:string,"
         "audioURL:string>")
SIGNAL = (
    "number int, importance int, lead boolean, category string, source string, headline string, "
    "summary string, keyTakeaways array<string>, whyItMatters string, originalURL string, "
    "readTime int, imageURL string, placeTime string, audioURL string, "
    f"localized map<string,{BLOCK}>, listen map<string,string>")


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidate documents to rows; ``seq`` is the position in the document (S3)."""
    docs = spark.read.schema(CANDIDATE).option("multiLine", True).json(path)
    rows = docs.select(F.col("_metadata.file_name").alias("file"),
                       times.iso_time("generated_at").alias("now"),
                       F.posexplode("candidates").alias("seq", "c"))
    return rows.select("file", "now", F.to_date("now").alias(DATE), F.col("seq").cast("long"),
                       "c.*").withColumn("published_at", times.iso_time("published_at"))


def write_candidates(df: DataFrame, path: str) -> None:
    """Candidate table, one partition per date."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path)


def read_editions(spark: SparkSession, path: str) -> DataFrame:
    """Signals of every ``YYYY-MM-DD.json``, dated by file name, with their JSON text.

    Unreadable files and other names are neutral: they yield no rows.
    """
    docs = spark.read.text(path, wholetext=True, pathGlobFilter="*.json").select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{4}-\d{2}-\d{2})\.json$", 1).alias("d"),
        "value")
    feed = F.from_json("value", "date string, focus string, version int, signals array<string>")
    rows = docs.filter(F.col("d") != "").withColumn("f", feed).select(
        F.to_date("d").alias(DATE), F.col("f.date").alias("inner_date"), "f.focus", "f.version",
        F.posexplode("f.signals").alias("pos", "json"))
    return rows.withColumn("s", F.from_json("json", SIGNAL)).select(
        DATE, "inner_date", "focus", "version", "pos", "json", "s.*")


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """What was published under ``path``; None when nothing was."""
    try:
        return spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return None


def write_edition(df: DataFrame, path: str, replace: bool = False) -> DataFrame:
    """Write editions, one immutable partition per date; returns the refused dates.

    Dates that exist are refused, unless ``replace`` asks to correct them.
    """
    dates = df.select(DATE).distinct()
    there = published(df.sparkSession, path)
    have = dates.limit(0) if there is None else there.select(DATE).distinct()
    refused = dates.limit(0) if replace else dates.join(have, DATE, "left_semi")
    refused = written(refused, "refused")
    fresh = df.join(refused, DATE, "left_anti")
    (fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DATE).parquet(path))
    return refused


def stale_dates(df: DataFrame, latest: DataFrame) -> DataFrame:
    """Dates older than the served one: publishing them would be a regression."""
    served = latest.agg(F.max(DATE).alias("_served"))
    return df.select(DATE).distinct().join(served, F.col(DATE) < F.col("_served")).select(DATE)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Clip and dialogue manifests as flat rows.

    (edition_date, number, format, lang, key, audioURL, gap, captions); a track given as plain
    text is an object key.  A missing or unreadable document yields no rows.
    """
    docs = spark.read.text(path, wholetext=True)
    per_date = F.from_json(F.get_json_object("value", "$.editions"),
                           "map<string,map<string,map<string,string>>>")
    rows = (docs.select(F.explode(per_date).alias("d", "numbers"))
            .select("d", F.explode("numbers").alias("number", "entry"))
            .select("d", "number", F.col("entry")["format"].alias("format"),
                    F.explode("entry").alias("lang", "raw")))
    track = F.from_json("raw", TRACK.replace("struct<audioURL", "struct<key:string,audioURL"))
    is_object = F.col("raw").startswith("{")
    return rows.filter((F.col("lang") != "format")).select(
        F.to_date("d").alias(DATE), F.col("number").try_cast("int").alias("number"), "format", "lang",
        F.when(is_object, track["key"]).otherwise(F.col("raw")).alias("key"),
        F.when(is_object, track["audioURL"]).alias("audioURL"),
        F.when(is_object, track["gap"]).alias("gap"),
        F.when(is_object, track["captions"]).alias("captions"))


def load_image_pools(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Image configuration (JSON) as dims: pools, topic keywords and category aliases."""
    entry = "array<struct<imageURL:string,placeTime:string,source:string,license:string,credit:string>>"
    doc = spark.read.schema(
        f"category_pools map<string,{entry}>, topic_pools map<string,{entry}>, default_pool {entry}, "
        "topic_keywords map<string,array<string>>, aliases map<string,string>"
    ).option("multiLine", True).json(path)

    def pools(kind: str, column: str) -> DataFrame:
        return (doc.select(F.explode(column).alias("pool_key", "e"))
                .select(F.lit(kind).alias("pool_kind"), "pool_key", F.posexplode("e").alias("pos", "i"))
                .select("pool_kind", "pool_key", "pos", "i.*"))

    default = doc.select(F.lit("default").alias("pool_kind"), F.lit("").alias("pool_key"),
                         F.posexplode("default_pool").alias("pos", "i")).select(
                             "pool_kind", "pool_key", "pos", "i.*")
    images = pools("category", "category_pools").unionByName(pools("topic", "topic_pools")).unionByName(default)
    words = doc.select(F.explode("topic_keywords").alias("topic", "w")).select(
        "topic", F.explode("w").alias("keyword"))
    aliases = doc.select(F.explode("aliases").alias("category", "pool_key"))
    return images, words, aliases


def publish_pool(pool: DataFrame, path: str, today: Column, enriched: bool = False) -> DataFrame:
    """Publish valid pools of the retention window, one partition per date.

    Returns per date: status (published, invalid, oversized, empty, too-few, too-many, expired),
    rows and bytes.  Nothing of a refused date is written.
    """
    check = P.validate_enriched(pool) if enriched else P.validate_pool(pool)
    bad = check.select("key").distinct().withColumn("_bad", F.lit(True))
    ident = P.editorial_identity(pool) if enriched else P.pool_identity(pool)
    low, high = (V.ENRICH_MINIMUM, V.ENRICH_TARGET) if enriched else (1, 100_000)
    status = (ident.join(bad, F.col(DATE).cast("string") == F.col("key"), "left").withColumn(
        "status", F.when(F.col(DATE) < F.date_sub(today, V.POOL_RETENTION_DAYS), F.lit("expired"))
        .when(F.coalesce("_bad", F.lit(False)), F.lit("invalid"))
        .when(F.col("rows") < low, F.lit("too-few")).when(F.col("rows") > high, F.lit("too-many"))
        .when(~F.col("within_limit"), F.lit("oversized")).otherwise(F.lit("published")))
        .drop("key", "_bad"))
    good = status.filter("status = 'published'").select(DATE)
    (pool.join(good, DATE, "left_semi").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path))
    return status


def read_pool(spark: SparkSession, path: str, today: Column) -> DataFrame:
    """Published pools still inside the retention window."""
    return spark.read.parquet(path).filter(
        F.col(DATE) >= F.date_sub(today, V.POOL_RETENTION_DAYS))
