"""URL filters as a temporal list join (operator 5).

Dated list entries (an entry is added to or removed from a list on a day) become validity intervals
with ``lead`` over each entry's own history. A capture is looked up by its host, every parent domain
and every path prefix, and an as-of join evaluates it against the entries that were active when it was
fetched. Intervals are dealt over periods, so an entry that changes often meets only the captures of
its period. While the intervals are counted small they are broadcast; beyond that captures are salted
and intervals repeated per salt, so a hot host is spread over ``SALTS`` tasks.

Defined cases: intervals are closed at the start and open at the end; of several events of an entry on
a day the removal wins; a removal without an addition before it changes nothing; a null URL or one
without a host matches nothing and passes; a null fetch day matches nothing; repeated captures give
repeated results; ties between rules go to the longer rule, then to allowing; other columns of the
inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyspark.llm.common import can_broadcast
from storyspark.session import written

#: Days of a period, salts of the shuffled way, and the last day (the end of open intervals).
PERIOD, SALTS, FOREVER = 32, 16, 10_000_000


def host(url: Column) -> Column:
    found = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.regexp_replace(F.regexp_replace(found, r"^.*@", ""), r":\d*$", "")


def path(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.when(found == "", "/").otherwise(found)


def keys(url: Column) -> Column:
    """Rules that a URL can fall under: its host and parents, and the folders of its path."""
    labels = F.split(host(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(
        F.slice(labels, k, F.size(labels)), "."))
    folders = F.split(F.regexp_extract(path(url), r"^/(.*)/[^/]*$", 1), "/")
    prefixes = F.transform(F.filter(F.sequence(F.lit(1), F.size(folders)), lambda k: folders[0] != ""),
                           lambda k: F.concat(host(url), F.lit("/"), F.array_join(F.slice(folders, 1, k), "/"),
                                              F.lit("/")))
    return F.when(host(url) == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(domains, prefixes)))


def intervals(events: DataFrame) -> DataFrame:
    """``list``, ``rule``, ``action``, ``valid_from``, ``valid_to`` from dated events.

    ``events`` has ``list``, ``rule``, ``action`` (block or allow), ``day`` (a number) and ``added``.
    """
    entry = ["list", "rule", "action"]
    by_day = (events.where("rule IS NOT NULL AND day IS NOT NULL AND added IS NOT NULL")
              .groupBy(*entry, "day").agg(F.min("added").alias("added")))
    history = Window.partitionBy(*entry).orderBy("day")
    turns = by_day.withColumn("before", F.lag("added").over(history)).where(
        F.col("added") != F.coalesce("before", F.lit(False)))
    return (turns.withColumn("valid_to", F.coalesce(F.lead("day").over(history), F.lit(FOREVER).cast("long")))
            .where("added").select(*entry, F.col("day").alias("valid_from"), "valid_to"))


def filter_urls(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url",
                day_col: str = "day") -> DataFrame:
    """``id_col``, ``day``, ``n_active`` (active entries met), ``lists``, ``rule`` (the one that decides) and ``blocked``."""
    rows = written(captures.select(F.col(id_col).alias("id"), F.col(day_col).cast("long").alias("day"),
                                   keys(F.col(url_col)).alias("rules")).withColumn("row", F.monotonically_increasing_id()),
                   "captures")
    span = rows.agg(F.min("day").alias("low"), F.max("day").alias("high")).first()
    low, high = span.low or 0, span.high or 0
    period = lambda c: F.floor(c / PERIOD)
    valid = (intervals(events).where((F.col("valid_from") <= high) & (F.col("valid_to") > low))
             .withColumn("period", F.explode(F.sequence(
                 period(F.greatest("valid_from", F.lit(low))),
                 period(F.least(F.col("valid_to") - 1, F.lit(high)))))))
    valid = written(valid, "intervals")
    asked = (rows.select("row", "day", F.explode("rules").alias("rule"))
             .withColumn("period", period(F.col("day"))))
    if can_broadcast(valid.count(), 200):
        met = asked.join(F.broadcast(valid), ["rule", "period"])
    else:
        salted = valid.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = asked.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(
            salted, ["rule", "period", "salt"])
    met = met.where("day >= valid_from AND day < valid_to")
    decides = F.max(F.struct(F.char_length("rule").alias("n"), (F.col("action") == "allow").alias("allow"), "rule"))
    found = met.groupBy("row").agg(F.count("*").alias("n_active"), F.collect_set("list").alias("lists"),
                                   decides.alias("best"))
    return rows.join(found, "row", "left").select(
        F.col("id").alias(id_col), "day", F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"),
        F.array_join(F.array_sort(F.coalesce("lists", F.array().cast("array<string>"))), ",").alias("lists"),
        F.col("best.rule").alias("rule"), F.coalesce(~F.col("best.allow"), F.lit(False)).alias("blocked"))
