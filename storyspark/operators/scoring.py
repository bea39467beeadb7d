"""Candidate scores and eligibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import classify as C, names, times, urls
from ..functions.rules import in_list, literal_map, text

DATE = "edition_date"
# What scoring and selection read of a candidate; anything else (such as article text) is not
# carried through their shuffles.
CANDIDATE = [DATE, "now", "seq", "id", "title", "source", "publisher", "category", "url",
             "canonical_url", "published_at", "snippet", "paywalled", "source_reliability",
             "structured_regions", "cluster_id", "cluster_size", "cluster_sources"]


def narrow(cands: DataFrame) -> DataFrame:
    return cands.select(*[c for c in CANDIDATE if c in cands.columns])


def category_weight(category) -> Column:
    return F.coalesce(F.element_at(literal_map(V.LEAD_WEIGHT, "int"), F.upper(text(category))),
                      F.lit(0))


def _at_least_one(c) -> Column:
    return F.when(F.coalesce(F.col(c), F.lit(0)) == 0, 1).otherwise(F.col(c)).cast("int")


def score_candidates(df: DataFrame, fresh_hours: float = 36) -> DataFrame:
    """Add source_risk, kind, important, live, reliable, cat_weight, base_score, lead_score.

    The sum keeps a fixed term order so that equal stories get bit-equal scores.
    """
    staged = df.withColumns({
        "reliable": names.is_reliable("source"),
        "live": urls.is_live_blog("title", "url"),
        "source_risk": C.source_risk("paywalled", "source", "source_reliability", "snippet"),
        "kind": C.editorial_kind("title"),
        "important": C.is_important("title"),
        "cat_weight": category_weight("category"),
        "cluster_size": _at_least_one("cluster_size"),
        "cluster_sources": _at_least_one("cluster_sources"),
    })
    s = F.lit(3.0) * F.least("cluster_size", F.lit(4))
    s = s + F.when(F.col("reliable"), F.lit(2.0)).otherwise(F.lit(0.0))
    s = s + F.lit(2.0) * times.recency("published_at", "now", fresh_hours)
    s = s + F.lit(1.5) * F.col("cat_weight")
    s = F.when(F.col("published_at").isNull(), s - F.lit(0.5)).otherwise(s)
    s = F.when(F.col("live"), s - F.lit(4.0)).otherwise(s)
    s = s - F.lit(0.6) * F.col("source_risk")
    s = s - F.when(F.col("kind") != "", F.lit(6.0)).otherwise(F.lit(0.0))
    s = s + F.when(F.col("important"), F.lit(2.0)).otherwise(F.lit(0.0))
    return staged.withColumn("base_score", s).withColumn(
        "lead_score", F.col("base_score") + F.lit(1.5) * F.col("cat_weight"))


def resolvable() -> Column:
    """The stored id is the one derived from the canonical URL."""
    return F.col("id") == urls.stable_id("canonical_url")


def with_eligibility(scored: DataFrame, stale_hours: float = 48) -> DataFrame:
    """Add ``real_url``, ``stale``, ``complete`` and ``eligible``."""
    return scored.withColumns({
        "real_url": urls.has_real_url("url"),
        "stale": times.is_stale("published_at", "now", stale_hours),
        "complete": C.likely_complete("paywalled", "source", "snippet"),
    }).withColumn("eligible", F.col("real_url") & ~F.col("stale") & resolvable()
                  & F.col("complete") & (F.col("kind") == ""))


def dedup_by_cluster(scored: DataFrame) -> DataFrame:
    """Best base score per cluster, first row on ties; a missing cluster is its own (A3).

    The rank filter lets Spark keep one row per cluster and task before the shuffle.
    """
    group = F.coalesce(F.col("cluster_id").cast("string"), F.concat(F.lit("row:"), F.col("seq")))
    w = Window.partitionBy(DATE, "_g").orderBy(F.col("base_score").desc(), F.col("seq"))
    return (scored.withColumn("_g", group).withColumn("_r", F.row_number().over(w))
            .filter(F.col("_r") == 1).drop("_g", "_r"))


def exclude_ids(df: DataFrame, excluded: DataFrame) -> DataFrame:
    """Rows whose id, in either form, is not on the date's exclusion list."""
    ids = excluded.select(DATE, F.col("id").alias("_x")).distinct()
    kept = df.withColumn("_s", urls.stable_id("canonical_url"))
    return (kept.join(ids, (kept[DATE] == ids[DATE]) & (kept["id"] == ids["_x"]), "left_anti")
            .join(ids, [(F.col("_s") == F.col("_x")), kept[DATE] == ids[DATE]], "left_anti")
            .drop("_s"))


def excluded_rows(df: DataFrame, excluded: DataFrame) -> DataFrame:
    """The audit side of ``exclude_ids``."""
    kept = exclude_ids(df, excluded).select(DATE, "seq")
    return df.join(kept, [DATE, "seq"], "left_anti")


def with_classes(df: DataFrame) -> DataFrame:
    """Add fingerprint ``fp``, metadata ``mm`` and identity ``sid`` of title and snippet."""
    df = df.withColumn("fp", C.topic_fingerprint("title", "snippet"))
    df = C.with_story_metadata(df, reliability="source_reliability", published_at="published_at",
                               now="now")
    return C.with_story_identity(df)


def mix_static(df: DataFrame) -> DataFrame:
    """Add ``static_delta`` and ``static_notes`` from ``mm`` and history ``run``/``run_dates`` (K3)."""
    m = F.col("mm")
    run = F.coalesce(F.col("run"), F.lit(0))
    penalty = F.get(F.array(*[F.lit(p) for p in V.HISTORY_PENALTIES]),
                    F.least(run, F.lit(len(V.HISTORY_PENALTIES))) - 1)
    parts = [(m["consumer_launch"], F.lit(V.LAUNCH_BOOST), F.lit(f"launch+{V.LAUNCH_BOOST}")),
             (m["discovery_value"], F.lit(V.DISCOVERY_BOOST),
              F.lit(f"discovery+{V.DISCOVERY_BOOST}")),
             (m["event_family"] == "earnings", F.lit(V.EARNINGS_PENALTY),
              F.lit(f"earnings{V.EARNINGS_PENALTY}")),
             (run > 0, penalty, F.concat(
                 F.lit("history"), penalty.cast("string"), F.lit(" ("), m["country"], F.lit("/"),
                 m["event_family"], F.lit(" in "), F.array_join("run_dates", ", "), F.lit(")")))]
    delta = F.lit(0.0)
    for cond, value, _ in parts:
        delta = F.when(cond, delta + value).otherwise(delta)
    return df.withColumns({
        "static_delta": delta,
        "static_notes": F.array_compact(F.array(*[F.when(c, note) for c, _, note in parts]))})


def mix_dynamic(chosen: Column) -> tuple[Column, Column]:
    """(delta, notes) against the stories already chosen (K4); row columns are the candidate's."""
    m = F.col("mm")
    same = F.get(F.filter(chosen, lambda s: s["country"] == m["country"]), F.lit(0))
    other_event = same["event_family"] != m["event_family"]
    dominant = F.col("cluster_sources") >= 3
    heavy = F.size(F.filter(chosen, lambda s: in_list(s["tone"], V.CONFLICT_TONES))) >= 2
    third = in_list(m["tone"], V.CONFLICT_TONES) & heavy
    same_cost = (same.isNotNull() & ~F.coalesce(other_event, F.lit(True)) & ~dominant)
    delta = (F.when(same_cost, F.lit(V.SAME_COUNTRY_PENALTY)).otherwise(F.lit(0.0))
             + F.when(third, F.lit(V.CONFLICT_TONE_PENALTY)).otherwise(F.lit(0.0)))
    head = F.when(same.isNotNull(), F.when(other_event, F.concat(
        F.lit("country-dup waived vs "), same["id"],
        F.lit(" (event family materially different)"))).when(dominant, F.concat(
            F.lit("country-dup waived vs "), same["id"],
            F.lit(" (dominant multi-publisher story)"))).otherwise(F.concat(
                F.lit(f"same-country{V.SAME_COUNTRY_PENALTY} (vs "), same["id"], F.lit(")"))))
    notes = F.array_compact(F.array(
        head, F.when(third, F.lit(f"third-conflict-tone{V.CONFLICT_TONE_PENALTY}"))))
    return delta, notes
