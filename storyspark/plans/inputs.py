"""Story tables derived from the driver's parquet tables, with the same derivation as SQL.

The given text is invented prose, so two thirds of the documents get a news headline in front of
their first words; everything else (source, URL, times) follows from ``doc_id`` arithmetic.  All
rows and whole texts are used, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab as V
from ..session import spread, written

DATES = 10
HEADLINES = [
    "Tokyo hospitals begin a national care robot trial",
    "Bank of Japan holds interest rates as the yen strengthens",
    "White House signs executive order on AI safety rules",
    "Congress debates new tariff policy on China imports",
    "Ceasefire talks resume in Gaza after missile strikes",
    "Iran and United States near nuclear deal at summit",
    "Ukraine reports overnight drone strikes near Kyiv",
    "Earthquake in Turkey leaves dozens dead and missing",
    "Samsung unveils Galaxy Z Fold 8 phone at Unpacked",
    "Galaxy Unpacked: the 6 biggest announcements",
    "Apple launches new iPhone with faster camera",
    "MacBook and iPad refresh announced by Apple",
    "Google introduces Pixel phone and new assistant",
    "Astronomers discover new species of fossil in Kenya",
    "Vaccine trial shows promise against disease in Nigeria",
    "Album review: a quiet return to form",
    "The best headphones to buy under $100",
    "New podcast episode looks back at the summer",
    "Trailer for the next Marvel movie lands",
    "Why I still love my garden in spring",
    "Amazon quarterly results beat as revenue rises",
    "Stocks slide as inflation fears return to markets",
    "Protest over labour law draws thousands in Paris",
    "Election officials count ballots in Brazil runoff",
    "Corruption scandal shakes the government of Peru",
    "United Nations agrees global treaty on plastics",
    "California wildfire grows as heatwave continues",
    "Live: flood warnings across Texas and Florida",
    "Museum in Osaka opens exhibition on Japanese heritage",
    "Sony says Japanese console sales will expand",
    "Supreme Court ruling reshapes antitrust law",
    "Russia and China plan to build a power grid",
    "NASA spacecraft reaches orbit around the moon",
    "Hospital strike enters a third week in England",
    "OpenAI and Microsoft in cloud partnership talks",
    "Anthropic releases an app for research assistants",
    "Festival of film and novel writing opens in Seoul",
]
_SRC = [s[0] for s in V.SOURCES]


_TABLES: dict = {}


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if name == "events" else df


def derived(fn):
    """Write a derived table once per session and folder, like any table of a pipeline."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf, fn.__name__)
        if key not in _TABLES:
            _TABLES[key] = written(fn(spark, sf), fn.__name__)
        return _TABLES[key]
    return run


def _pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _words(c, start: int, n: int) -> Column:
    # The last part of a limited split is the rest of the text.
    return F.array_join(F.slice(F.split(c, r"\s+", start + n), start, n), " ")


def raw_items(spark: SparkSession, sf: str) -> DataFrame:
    """Feed items as they arrive: strings only, plus date, source name and arrival order."""
    d = read(spark, sf, "documents")
    i = F.col("doc_id")
    turn = F.floor(i / 10)
    headline = _pick(HEADLINES, turn % len(HEADLINES))
    title = F.when(i % 3 != 0, F.concat(headline, F.lit(" "), _words("text", 1, 4))
                   ).otherwise(_words("text", 1, 10))
    story = F.when((i % 11 == 5) & (i >= 10), i - 10).otherwise(i)
    host = F.concat(F.when(i % 13 == 0, F.lit("http://News")).otherwise(F.lit("https://News")),
                    (i % 5).cast("string"), F.lit(".Example.com/"))
    tail = F.when(i % 7 == 0, F.lit("?utm_source=feed&page=2")).when(
        i % 7 == 1, F.lit("#top")).when(i % 7 == 2, F.lit("/")).otherwise(F.lit(""))
    link = (F.when(i % 29 == 0, host)
            .when(i % 31 == 0, F.concat(host, F.lit("videos/clip-"), story.cast("string")))
            .when(i % 37 == 0, F.lit(""))
            .otherwise(F.concat(host, F.col("lang"), F.lit("/story-"), story.cast("string"), tail)))
    day = F.date_add(F.lit("2026-07-20").cast("date"), (i % DATES).cast("int"))
    published = F.when(i % 17 != 0, day.cast("timestamp") + F.make_dt_interval(
        F.lit(0), (F.lit(6) - (i * 7) % 60).cast("int")))
    return d.select(
        day.alias("edition_date"),
        (day.cast("timestamp") + F.expr("INTERVAL 9 HOURS")).alias("now"),
        i.alias("seq"), _pick(_SRC, turn % len(_SRC)).alias("source"),
        F.trim(title).alias("title"), link.alias("link"),
        F.substring(F.trim(F.regexp_replace("text", r"\s+", " ")), 1, 400).alias("description"),
        F.coalesce(F.concat(F.date_format(published, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")),
                   F.lit("")).alias("pub_date"),
        published.alias("published_at"), F.col("text").alias("body"), F.col("lang"))


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        V.SOURCES, "source string, category string, paywalled boolean, status string, "
                   "region string, feed_id string")


@derived
def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Ingested candidates; the cluster is the shared headline (own cluster otherwise)."""
    from ..functions import names, urls
    from ..operators.ingest import cluster_stats

    r = spread(raw_items(spark, sf).filter(F.col("link") != ""))
    i = F.col("seq")
    turn = F.floor(i / 10)
    n = len(V.SOURCES)
    cu = urls.canonical_url("link")
    base = r.select(
        "edition_date", "now", "seq", urls.stable_id(cu).alias("id"), "title", "source",
        names.publisher_key("source").alias("publisher"),
        _pick([s[1] for s in V.SOURCES], turn % n).alias("category"),
        F.col("link").alias("url"), cu.alias("canonical_url"), "published_at",
        F.col("description").alias("snippet"),
        _pick([s[2] for s in V.SOURCES], turn % n).alias("paywalled"),
        names.reliability(_pick([s[3] for s in V.SOURCES], turn % n)).alias("source_reliability"),
        F.when(turn % n == 5, F.array(F.lit("united_states"))).otherwise(
            F.array().cast("array<string>")).alias("structured_regions"),
        F.when(i % 3 != 0, turn % len(HEADLINES)).otherwise(F.lit(1000) + i)
         .cast("long").alias("cluster_id"), "body")
    return cluster_stats(base)


# --- the same derivation for the SQL side ---------------------------------------------------

def _q(s) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) if isinstance(v, str) else str(v).lower() for v in values) + "]"


ITEMS_SQL = f"""items AS (
  SELECT CAST(DATE '2026-07-20' + CAST(doc_id % {DATES} AS INTEGER) AS DATE) AS edition_date,
    CAST(DATE '2026-07-20' + CAST(doc_id % {DATES} AS INTEGER) AS TIMESTAMP) + INTERVAL 9 HOUR AS now,
    doc_id AS seq, {_list(_SRC)}[1 + (doc_id // 10) % {len(_SRC)}] AS source,
    trim(CASE WHEN doc_id % 3 <> 0 THEN {_list(HEADLINES)}[1 + (doc_id // 10) % {len(HEADLINES)}]
           || ' ' || array_to_string(list_slice(string_split_regex(text, '\\s+'), 1, 4), ' ')
         ELSE array_to_string(list_slice(string_split_regex(text, '\\s+'), 1, 10), ' ') END) AS title,
    CASE WHEN doc_id % 29 = 0 THEN host WHEN doc_id % 31 = 0 THEN host || 'videos/clip-' || story
         WHEN doc_id % 37 = 0 THEN '' ELSE host || lang || '/story-' || story ||
           CASE doc_id % 7 WHEN 0 THEN '?utm_source=feed&page=2' WHEN 1 THEN '#top'
                WHEN 2 THEN '/' ELSE '' END END AS link,
    substring(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 400) AS description,
    CASE WHEN doc_id % 17 <> 0 THEN
      CAST(DATE '2026-07-20' + CAST(doc_id % {DATES} AS INTEGER) AS TIMESTAMP)
        + to_hours(CAST(6 - (doc_id * 7) % 60 AS INTEGER)) END AS published_at,
    text AS body, lang
  FROM (SELECT *, CASE WHEN doc_id % 13 = 0 THEN 'http://News' ELSE 'https://News' END
           || (doc_id % 5) || '.Example.com/' AS host,
           CASE WHEN doc_id % 11 = 5 AND doc_id >= 10 THEN doc_id - 10 ELSE doc_id END AS story
        FROM documents))"""

# Only utm_ parameters occur in the derived links, so the SQL form can stay short.
CANON_SQL = ("regexp_extract(link, '^(https?)://', 1) || '://' || "
             "lower(regexp_extract(link, '^https?://([^/?#]*)', 1)) || "
             "CASE WHEN rtrim(regexp_extract(link, '^https?://[^/?#]*([^?#]*)', 1), '/') = '' "
             "THEN '/' ELSE rtrim(regexp_extract(link, '^https?://[^/?#]*([^?#]*)', 1), '/') END "
             "|| CASE WHEN link LIKE '%page=2%' THEN '?page=2' ELSE '' END")
_FAM = _list([s[1] for s in V.SOURCES])
_PAY = _list([s[2] for s in V.SOURCES])
_REL = _list([V.STATUS_RELIABILITY[s[3]] for s in V.SOURCES])
CANDIDATES_SQL = ITEMS_SQL + f""",
base AS (
  SELECT edition_date, now, seq, substring(sha1({CANON_SQL}), 1, 6) AS id, title, source,
    trim(regexp_replace(source, '\\s*\\(.*?\\)\\s*$', '')) AS publisher,
    {_FAM}[1 + (seq // 10) % {len(_SRC)}] AS category, link AS url, {CANON_SQL} AS canonical_url,
    published_at, description AS snippet, {_PAY}[1 + (seq // 10) % {len(_SRC)}] AS paywalled,
    {_REL}[1 + (seq // 10) % {len(_SRC)}] AS source_reliability,
    CASE WHEN seq % 3 <> 0 THEN (seq // 10) % {len(HEADLINES)} ELSE 1000 + seq END AS cluster_id,
    body
  FROM items WHERE link <> ''),
candidates AS (
  SELECT b.*, s.cluster_size, s.cluster_sources FROM base b JOIN (
    SELECT edition_date, cluster_id, count(*) AS cluster_size,
           count(DISTINCT publisher) AS cluster_sources
    FROM base GROUP BY ALL) s USING (edition_date, cluster_id))"""
