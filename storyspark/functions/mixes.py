"""Preference normalisation, mix identity and nested-JSON key checks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab as V
from .rules import col, literal_map, str_array, text


def _key(v: Column) -> Column:
    t = F.lower(F.regexp_replace(F.regexp_replace(text(v), r"^\s+|\s+$", ""), r"[.\s\-]+", "_"))
    return F.regexp_replace(F.regexp_replace(t, "_+", "_"), "^_|_$", "")


def _normalize(arr, aliases: dict) -> Column:
    known = literal_map(aliases, "string")
    mapped = F.transform(F.coalesce(col(arr), F.array().cast("array<string>")),
                         lambda v: F.element_at(known, _key(v)))
    return F.array_sort(F.array_distinct(F.array_compact(mapped)))


def _unsupported(arr, aliases: dict) -> Column:
    known = literal_map(aliases, "string")
    return F.array_sort(F.filter(F.coalesce(col(arr), F.array().cast("array<string>")),
                                 lambda v: ~F.map_contains_key(known, _key(v))))


def normalize_regions(arr) -> Column:
    return _normalize(arr, V.REGION_ALIASES)


def normalize_topics(arr) -> Column:
    return _normalize(arr, {t: t for t in V.SUPPORTED_TOPICS})


def unsupported_regions(arr) -> Column:
    return _unsupported(arr, V.REGION_ALIASES)


def unsupported_topics(arr) -> Column:
    return _unsupported(arr, {t: t for t in V.SUPPORTED_TOPICS})


def mix_identity(date, regions, topics, version: int = V.SELECTOR_VERSION,
                 size: int = V.STORY_COUNT) -> Column:
    """Canonical text identity of one (date, regions, topics) mix; inputs already normalised."""
    return F.concat(F.lit("date="), F.trim(col(date).cast("string")),
                    F.lit("|regions="), F.array_join(col(regions), ","),
                    F.lit("|topics="), F.array_join(col(topics), ","),
                    F.lit(f"|selector={version}|size={size}"))


def canonical_topics(category) -> Column:
    """Topics implied by a category; empty for general news."""
    out = None
    for cat, topics in V.CATEGORY_TOPICS.items():
        cond = F.upper(text(category)) == cat
        out = F.when(cond, str_array(topics)) if out is None else out.when(cond, str_array(topics))
    return out.otherwise(F.array().cast("array<string>"))


def topic_allowed(category, topics) -> Column:
    """Every topic of the category is selected; no selection or no topic allows all."""
    t = col(topics)
    return (F.size(t) == 0) | F.forall(canonical_topics(category), lambda x: F.array_contains(t, x))


def priority_regions(regions) -> Column:
    return F.filter(str_array(V.REGION_PRIORITY), lambda r: F.array_contains(col(regions), r))


def quotas(regions, size: int = V.STORY_COUNT) -> Column:
    """map region -> slots: the US takes three when mixed, the rest split in priority order."""
    table = []
    for n in range(1, len(V.REGION_PRIORITY) + 1):
        for combo in combinations(V.REGION_PRIORITY, n):
            slots = dict.fromkeys(combo, 0)
            rest, left = list(combo), size
            if n > 1 and combo[0] == "united_states":
                slots["united_states"] = min(V.US_MIN_QUOTA, size)
                rest, left = list(combo[1:]), size - slots["united_states"]
            for i, region in enumerate(rest):
                slots[region] = left // len(rest) + (1 if i < left % len(rest) else 0)
            table.append((",".join(sorted(combo)), slots))
    key = F.array_join(F.array_sort(col(regions)), ",")
    out = None
    for name, slots in table:
        value = literal_map(slots, "int")
        out = F.when(key == name, value) if out is None else out.when(key == name, value)
    return out


# --- nested JSON -------------------------------------------------------------------------------

def forbidden_keys(json, keys) -> Column:
    """Forbidden member names used anywhere in a JSON text."""
    pattern = '(?i)"(' + "|".join(keys) + r')"\s*:'
    return F.array_sort(F.array_distinct(F.transform(
        F.regexp_extract_all(text(json), F.lit(pattern), F.lit(1)), lambda k: F.lower(k))))


def has_local_path(json) -> Column:
    """A string value that is a file:// URL or names a home folder."""
    return text(json).rlike('[:\\[,]\\s*"file://|/Users/')


def missing_keys(json, keys) -> Column:
    have = F.coalesce(F.json_object_keys(col(json)), F.array().cast("array<string>"))
    return F.array_sort(F.array_except(str_array(keys), have))


def extra_keys(json, keys) -> Column:
    have = F.coalesce(F.json_object_keys(col(json)), F.array().cast("array<string>"))
    return F.array_sort(F.array_except(have, str_array(keys)))
