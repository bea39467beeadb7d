"""Image choice with topic and category pools and a cooldown."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import text

DATE = "edition_date"
MAX_POOL_ROWS = 5000
_POOLS = "map<string,array<struct<url:string,place:string>>>"


def topic_score(headline, summary, keywords: dict) -> Column:
    """array<struct<k, topic>> of matching topics: 2 x headline + 1 x summary keyword hits."""
    h, s = F.lower(text(headline)), F.lower(text(summary))
    out = []
    for topic, words in keywords.items():
        score = F.lit(0)
        for word in words:
            rx = r"(?U)\b" + re.escape(str(word).lower()) + r"\b"
            score = score + F.when(h.rlike(rx), 2).otherwise(0) + F.when(s.rlike(rx), 1).otherwise(0)
        out.append(F.struct((-score).alias("k"), F.lit(topic).alias("topic")))
    scores = F.array(*out).cast("array<struct<k:int,topic:string>>")
    return F.filter(scores, lambda x: x["k"] < 0)


def match_topic(df: DataFrame, keywords: dict, headline="headline", summary="summary") -> DataFrame:
    """Add ``topic`` and ``topic_score``: highest score, topic name on ties, NULL when none."""
    best = F.array_min(topic_score(headline, summary, keywords))
    return df.withColumn("_t", best).withColumns({
        "topic": F.col("_t.topic"), "topic_score": F.coalesce(-F.col("_t.k"), F.lit(0))}).drop("_t")


def rotate(pool: Column, day: Column) -> Column:
    """Pool rotated left by the day of the year."""
    n = F.size(pool)
    shift = F.pmod(F.dayofyear(day), F.greatest(n, F.lit(1)))
    return F.when(n == 0, pool).otherwise(F.concat(
        F.slice(pool, shift + 1, n), F.slice(pool, F.lit(1), shift)))


class ImagePools:
    """Image configuration as constants: a small editorial file, size-checked when read."""

    def __init__(self, df: DataFrame, keywords: dict, aliases: dict | None = None):
        """``df``: pool_kind (category, topic or default), pool_key, pos, imageURL, placeTime."""
        rows = (df.select("pool_kind", "pool_key", "pos", "imageURL", "placeTime")
                .limit(MAX_POOL_ROWS + 1).collect())
        if len(rows) > MAX_POOL_ROWS:
            raise ValueError(f"image configuration has more than {MAX_POOL_ROWS} entries")
        self.keywords, self.aliases = keywords, aliases or {}
        self.pools: dict[str, dict[str, list]] = {"category": {}, "topic": {}, "default": {}}
        for r in sorted(rows, key=lambda r: (r.pool_kind, r.pool_key or "", r.pos)):
            self.pools[r.pool_kind].setdefault(r.pool_key or "", []).append(
                {"url": r.imageURL, "place": r.placeTime})

    def _map(self, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(self.pools[kind])), _POOLS)

    def topic_pool(self, topic: Column) -> Column:
        return F.coalesce(F.element_at(self._map("topic"), F.coalesce(topic, F.lit(""))), self.empty())

    def category_pool(self, category: Column) -> Column:
        alias = F.lit("")
        for a, b in self.aliases.items():
            alias = F.when(category == a, F.lit(b)).otherwise(alias)
        known = self._map("category")
        return F.coalesce(F.element_at(known, category), F.element_at(known, alias),
                          F.element_at(self._map("default"), F.lit("")), self.empty())

    def every(self) -> Column:
        ordered = [p for kind in ("category", "topic", "default")
                   for _, p in sorted(self.pools[kind].items())]
        return F.from_json(F.lit(json.dumps(ordered)), "array<array<struct<url:string,place:string>>>")

    @staticmethod
    def empty() -> Column:
        return F.array().cast("array<struct<url:string,place:string>>")


def assign_images(items: DataFrame, pools: ImagePools, recent: DataFrame, lead_first: bool = True
                  ) -> DataFrame:
    """(edition_date, number, imageURL, placeTime, topic, tier) for every item.

    ``items``: edition_date, number, lead, category, headline, summary; at most 20 per date (an
    edition or an enriched pool), checked here.  ``recent``: edition_date, avoid (see
    ``history.recent_images``).  In order, each item takes the first image of its topic pool, its
    category pool or any pool that is neither used in the set nor cooling down; only when none is
    left an image inside the cooldown is used again.
    """
    matched = match_topic(items, pools.keywords)
    turn = F.when(F.col("lead") & F.lit(lead_first), 0).otherwise(1)
    lists = matched.groupBy(DATE).agg(F.array_sort(F.collect_list(F.struct(
        turn.alias("turn"), "number", F.coalesce("category", F.lit("OTHER")).alias("category"),
        "topic"))).alias("items"))
    checked = lists.withColumn("items", F.when(
        F.size("items") <= 20, F.col("items")).otherwise(
            F.raise_error(F.lit("more than 20 items on a date")).cast(
                "array<struct<turn:int,number:int,category:string,topic:string>>")))
    day = F.col(DATE)
    base = checked.join(recent, DATE, "left").withColumn(
        "avoid", F.coalesce("avoid", F.array().cast("array<string>")))
    base = base.withColumn("_all", F.transform(pools.every(), lambda p: rotate(p, day)))

    def pick(acc, it):
        def first(pool, cooling):
            return F.get(F.filter(pool, lambda e: (F.coalesce(e["url"], F.lit("")) != "")
                                  & ~F.array_contains(acc["used"], e["url"])
                                  & (F.lit(cooling) | ~F.array_contains("avoid", e["url"]))), F.lit(0))
        topic_pool = rotate(pools.topic_pool(it["topic"]), day)
        cat_pool = rotate(pools.category_pool(it["category"]), day)
        flat = F.flatten("_all")
        tiers = [(first(topic_pool, False), "topic"), (first(cat_pool, False), "category"),
                 (first(flat, False), "cross-pool"), (first(cat_pool, True), "reused"),
                 (first(flat, True), "reused")]
        chosen = F.coalesce(*[F.when(img["url"].isNotNull(), F.struct(
            img["url"].alias("url"), img["place"].alias("place"), F.lit(t).alias("tier")))
            for img, t in tiers], F.struct(F.lit("").alias("url"), F.lit("").alias("place"),
                                           F.lit("none").alias("tier")))
        return F.transform(F.array(chosen), lambda c: F.struct(
            F.concat(acc["used"], F.array(c["url"])).alias("used"),
            F.concat(acc["out"], F.array(F.struct(
                it["number"].alias("number"), c["url"].alias("url"), c["place"].alias("place"),
                it["topic"].alias("topic"), c["tier"].alias("tier")))).alias("out")))[0]

    start = F.struct(F.array().cast("array<string>").alias("used"), F.array().cast(
        "array<struct<number:int,url:string,place:string,topic:string,tier:string>>").alias("out"))
    out = base.select(DATE, F.explode(F.aggregate(F.col("items").cast(
        "array<struct<turn:int,number:int,category:string,topic:string>>"), start, pick,
        lambda a: a["out"])).alias("o"))
    return out.select(DATE, F.col("o.number").alias("number"), F.col("o.url").alias("imageURL"),
                      F.col("o.place").alias("placeTime"), F.col("o.topic").alias("topic"),
                      F.col("o.tier").alias("tier"))


def enriched_images(assigned: DataFrame) -> DataFrame:
    """Add ``drop_reason`` for pool items without a usable own image: https and first use of it."""
    firsts = assigned.filter(F.col("imageURL").startswith("https://")).groupBy(
        DATE, "imageURL").agg(F.min("number").alias("_first"))
    return assigned.join(firsts, [DATE, "imageURL"], "left").withColumn(
        "drop_reason", F.when(F.col("_first").isNull(), F.lit("invalid_image"))
        .when(F.col("number") != F.col("_first"), F.lit("duplicate_image"))).drop("_first")
