"""Source names: publisher key and family, slug, brand key, reliability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab as V
from .rules import literal_map, str_array, text


def publisher_key(source) -> Column:
    """Source name without a trailing section in brackets."""
    return F.trim(F.regexp_replace(text(source), r"\s*\(.*?\)\s*$", ""))


def publisher_family(source) -> Column:
    base = F.lower(publisher_key(source))
    return F.coalesce(F.element_at(literal_map(V.PUBLISHER_FAMILIES, "string"), base), base)


def slug(name) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text(name)), "[^a-z0-9]+", "-"),
                            "^-+|-+$", "")


def brand_key(source) -> Column:
    """Longest telling word of a source name (the first of equally long ones), or ''."""
    words = F.filter(F.regexp_extract_all(F.lower(text(source)), F.lit("[a-z]{3,}"), F.lit(0)),
                     lambda w: ~F.array_contains(str_array(V.KEYWORD_STOPWORDS), w))
    longest = F.array_max(F.transform(words, lambda w: F.length(w)))
    return F.coalesce(F.get(F.filter(words, lambda w: F.length(w) == longest), F.lit(0)),
                      F.lit(""))


def is_reliable(source) -> Column:
    low = F.lower(text(source))
    out = F.lit(False)
    for name in V.RELIABLE_OUTLETS:
        out = out | low.contains(name)
    return out


def reliability(status) -> Column:
    return F.coalesce(F.element_at(literal_map(V.STATUS_RELIABILITY, "string"), text(status)),
                      F.lit("unknown"))
