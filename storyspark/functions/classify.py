"""Rule-table classification of stories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from . import names, times
from .mixes import canonical_topics, normalize_regions
from .rules import all_labels, col, first_label, folded, hits, in_list, screened, str_array, text
from .text import jaccard, py_strip


def blob(title, snippet) -> Column:
    return F.concat(text(title), F.lit(" "), text(snippet))


def topic_fingerprint(title, snippet) -> Column:
    """Sorted canonical topic tokens of a story; empty when nothing is recognised."""
    return all_labels(blob(title, snippet), V.FINGERPRINT)


def topics(category, title, snippet) -> Column:
    """Topics from the category and from the text."""
    return F.array_sort(F.array_union(canonical_topics(category),
                                      all_labels(blob(title, snippet), V.TEXT_TOPICS)))


def editorial_kind(title) -> Column:
    """Exclusion class of a headline, '' for core news."""
    return first_label(title, V.EDITORIAL_KINDS, default="")


def is_important(title) -> Column:
    return hits(title, V.IMPORTANCE)


def snippet_length(snippet) -> Column:
    return F.length(py_strip(text(snippet)))


def likely_complete(paywalled, source, snippet) -> Column:
    return ~F.coalesce(col(paywalled), F.lit(False)) & (
        names.is_reliable(source) | (snippet_length(snippet) >= V.MIN_SNIPPET))


def source_risk(paywalled, source, source_reliability, snippet) -> Column:
    n = snippet_length(snippet)
    return (F.when(F.coalesce(col(paywalled), F.lit(False)), 5).otherwise(0)
            + F.when(names.is_reliable(source), 0).otherwise(1)
            + F.when(F.lower(text(source_reliability)) == "low", 1).otherwise(0)
            + F.when(n < 60, 3).when(n < 120, 2).when(n < V.MIN_SNIPPET, 1).otherwise(0))


def consumer_launch(title, snippet, reliability, published_at, now) -> Column:
    """A current, credible consumer product launch claimed by the headline."""
    b = blob(title, snippet)
    fresh = F.lit(True)
    if published_at is not None and now is not None:
        fresh = F.coalesce(times.hours_old(published_at, now) <= V.LAUNCH_FRESH_HOURS, F.lit(True))
    credible = F.lit(True) if reliability is None else (text(reliability) != "low")
    return (credible & fresh & hits(title, V.LAUNCH_VERB) & ~hits(title, V.ACCESSORY)
            & screened(b, lambda t, low: hits(t, V.CONSUMER_PRODUCT, low) & ~hits(t, V.LAUNCH_EXCLUDE, low)))


def _event_family(b: Column, low: Column) -> Column:
    out = None
    for family, pattern in V.EVENT_FAMILIES:
        cond = hits(b, pattern, low)
        if family == "science_discovery":
            cond = cond & ~hits(b, V.CRISIS, low)
        out = F.when(cond, F.lit(family)) if out is None else out.when(cond, F.lit(family))
    return out.otherwise(F.lit("other"))


def with_story_metadata(df: DataFrame, title="title", snippet="snippet", reliability=None,
                        published_at=None, now=None, out="mm") -> DataFrame:
    """Add struct ``out``: country, region, event_family, tone, consumer_launch, discovery_value.

    Computed in steps, so that each rule ladder runs once per row.
    """
    country = first_label(F.col("_b"), [(rx, f"{c}|{r}") for r, c, rx in V.COUNTRIES])
    family = F.col("_f")
    crisis = hits(F.col("_b"), V.CRISIS, F.col("_low"))
    quiet = in_list(family, ["science_discovery", "health_breakthrough", "consumer_launch"])
    discovery = in_list(family, ["science_discovery", "health_breakthrough"])
    tone = (F.when(family == "conflict", F.lit("negative_conflict"))
            .when((family == "disaster") | (crisis & ~quiet), F.lit("negative_crisis"))
            .when(discovery, F.lit("discovery"))
            .when((family == "consumer_launch") | hits(F.col("_b"), V.FORWARD, F.col("_low")),
                  F.lit("forward_looking"))
            .otherwise(F.lit("neutral")))
    return (df.withColumns({
                "_b": blob(title, snippet), "_low": folded(blob(title, snippet)),
                "_l": consumer_launch(title, snippet, reliability, published_at, now)})
            .withColumns({
                "_c": country,
                "_f": F.when(F.col("_l"), F.lit("consumer_launch"))
                       .otherwise(_event_family(F.col("_b"), F.col("_low")))})
            .withColumn(out, F.struct(
                F.substring_index("_c", "|", 1).alias("country"),
                F.substring_index("_c", "|", -1).alias("region"),
                family.alias("event_family"), tone.alias("tone"),
                F.col("_l").alias("consumer_launch"), discovery.alias("discovery_value")))
            .drop("_b", "_low", "_l", "_c", "_f"))


def with_story_identity(df: DataFrame, title="title", snippet="snippet", meta="mm",
                        out="sid") -> DataFrame:
    """Add struct ``out``: consumer-product identity, NULL when no brand is recognised."""
    labels = [label for _, label in V.PRODUCT_FAMILIES]
    matched = F.col("_m")
    pruned = F.filter(matched, lambda f: ~F.exists(
        matched, lambda g: (g != f) & g.startswith(F.concat(f, F.lit(" ")))))
    rank = {label: i for i, label in enumerate(labels)}
    ordered = F.array_sort(F.transform(matched, lambda f: F.struct(
        F.array_position(str_array(list(rank)), f).alias("p"), f.alias("f"))))
    family = F.get(ordered, F.lit(0))["f"]
    family_kind = F.col(meta)["event_family"]
    event = F.col("_e")
    product = ((F.col(meta)["consumer_launch"] | (F.size(matched) > 0) | event.isNotNull())
               & in_list(family_kind, V.PRODUCT_EVENT_FAMILIES))
    return (df.withColumn("_b", blob(title, snippet))
            .withColumns({"_n": first_label(F.col("_b"), V.BRANDS),
                          "_m": all_labels(F.col("_b"), V.PRODUCT_FAMILIES),
                          "_e": first_label(F.col("_b"), V.LAUNCH_EVENTS)})
            .withColumn(out, F.when(F.col("_n").isNotNull(), F.struct(
                F.col("_n").alias("brand"), family.alias("product_family"),
                pruned.alias("covered_families"), event.alias("event"),
                family_kind.alias("event_family"),
                hits(title, V.ROUNDUP_TITLE).alias("is_roundup"),
                product.alias("is_product_story"))))
            .drop("_b", "_n", "_m", "_e"))


# --- regions -----------------------------------------------------------------------------------

def classify_regions(title, summary, metadata=None, structured=None) -> Column:
    """array<struct<id, strength, evidence>> for japan, united_states and world, in that order."""
    members = []
    for region in V.SUPPORTED_REGIONS:
        def found(field, value):
            if value is None:
                return F.array().cast("array<string>")
            return screened(value, lambda t, low: F.array_compact(F.array(*[
                F.when(hits(t, rx, low), F.lit(f"{label}:{field}")) for label, rx in V.REGION_RULES[region]])))
        in_title, in_sum = found("title", title), found("summary", summary)
        in_meta = found("metadata", metadata)
        evidence = F.concat(in_title, in_sum, in_meta)
        primary = (F.size(in_title) > 0) | (F.size(in_sum) >= 2) | (F.size(in_meta) > 0)
        strength = F.when(primary, F.lit("primary")).when(
            F.size(evidence) > 0, F.lit("incidental")).otherwise(F.lit("none"))
        if region == "japan":
            company_only = ((in_title == F.array(F.lit("japanese:title")))
                            & hits(title, V.REGION_COMPANIES)
                            & (F.size(in_sum) == 0) & (F.size(in_meta) == 0))
            strength = F.when(company_only, F.lit("incidental")).otherwise(strength)
        if structured is not None:
            given = F.array_contains(normalize_regions(structured), region)
            given = F.coalesce(given, F.lit(False))
            strength = F.when(given, F.lit("primary")).otherwise(strength)
            evidence = F.when(given, F.array(F.lit(f"{region}:structured"))).otherwise(evidence)
        members.append(F.struct(F.lit(region).alias("id"), strength.alias("strength"),
                                evidence.alias("evidence")))
    return F.array(*members)


def primary_regions(memberships) -> Column:
    """Sorted ids of the regions a story is primary in."""
    return F.array_sort(F.transform(F.filter(col(memberships), lambda m: m["strength"] == "primary"),
                                    lambda m: m["id"]))


def primary_in(memberships, regions) -> Column:
    return F.arrays_overlap(primary_regions(memberships), col(regions))


# --- pair predicates ---------------------------------------------------------------------------

def fingerprint_overlap(a: Column, b: Column) -> Column:
    """Two fingerprints describe the same story."""
    shared = F.array_intersect(a, b)
    ents = F.size(F.array_intersect(shared, str_array(V.FINGERPRINT_ENTITIES)))
    themes = F.size(F.array_intersect(shared, str_array(V.FINGERPRINT_THEMES)))
    union = F.size(F.array_union(a, b))
    return (F.size(a) > 0) & (F.size(b) > 0) & (
        (ents >= 2)
        | ((ents >= 1) & (themes >= 1) & (2 * F.size(shared) >= union))
        | (10 * F.size(shared) >= 6 * union))


def _related(a: Column, b: Column) -> Column:
    return F.coalesce((a == b) | a.startswith(F.concat(b, F.lit(" ")))
                      | b.startswith(F.concat(a, F.lit(" "))), F.lit(False))


def same_story_rule(a: Column, b: Column) -> Column:
    """Name of the first rule that decides whether two story identities are one story."""
    fa, fb = a["product_family"], b["product_family"]
    covers = (
        (a["is_roundup"] & fb.isNotNull()
         & F.exists(a["covered_families"], lambda f: _related(fb, f)))
        | (b["is_roundup"] & fa.isNotNull()
           & F.exists(b["covered_families"], lambda f: _related(fa, f))))
    return (F.when(a.isNull() | b.isNull(), F.lit("no-identity"))
            .when(a["brand"] != b["brand"], F.lit("different-brand"))
            .when(~(a["is_product_story"] & b["is_product_story"]), F.lit("not-product-story"))
            .when(F.coalesce(a["event"] == b["event"], F.lit(False)),
                  F.lit("same-launch-event"))
            .when(_related(fa, fb), F.lit("same-product-family"))
            .when(F.coalesce(covers, F.lit(False)), F.lit("roundup-covers-family"))
            .when(fa.isNotNull() & fb.isNotNull(), F.lit("distinct-product-families"))
            .when(a["is_roundup"] | b["is_roundup"], F.lit("roundup-contains-broad"))
            .when(fa.isNull() & fb.isNull(), F.lit("brand-product-news-no-line"))
            .otherwise(F.lit("distinct-product-families")))


SAME_STORY_RULES = ["same-launch-event", "same-product-family", "roundup-covers-family",
                    "roundup-contains-broad", "brand-product-news-no-line"]


def same_story_reason(rule: Column, a: Column, b: Column) -> Column:
    """Readable reason for a duplicate rule, '' when not a duplicate."""
    fa, fb = a["product_family"], b["product_family"]
    head = F.concat(F.lit("same brand ("), a["brand"], F.lit(") "))
    a_covers = a["is_roundup"] & fb.isNotNull() & F.exists(
        a["covered_families"], lambda f: _related(fb, f))
    line = F.when(F.coalesce(a_covers, F.lit(False)), fb).otherwise(fa)
    return (F.when(rule == "same-launch-event",
                   F.concat(head, F.lit("+ same launch event ("), a["event"], F.lit(")")))
            .when(rule == "same-product-family",
                  F.concat(head, F.lit("+ same product family ("), F.coalesce(fa, fb), F.lit(")")))
            .when(rule == "roundup-covers-family",
                  F.concat(head, F.lit("+ roundup covers that product line ("), line, F.lit(")")))
            .when(rule == "roundup-contains-broad",
                  F.concat(head, F.lit("+ event roundup and a story with no distinct product line")))
            .when(rule == "brand-product-news-no-line",
                  F.concat(head, F.lit("product news with no distinguishing product line")))
            .otherwise(F.lit("")))


def is_same_story(a: Column, b: Column) -> Column:
    return in_list(same_story_rule(a, b), SAME_STORY_RULES)
