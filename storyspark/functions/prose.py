"""Copy quality rules as arrays of issue texts (V9, V2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab as V
from . import text as T
from .rules import folded, hits, hits_cs, in_list, let, text


def _issues(*pairs) -> Column:
    return F.array_compact(F.array(*[F.when(cond, msg if isinstance(msg, Column) else F.lit(msg))
                                     for cond, msg in pairs])).cast("array<string>")


def _strip(c) -> Column:
    return T.py_strip(text(c))


def facts(s, screened=None) -> Column:
    """Struct of everything the rules below ask about one text; each pattern runs once.

    ``screened``: true where captions and metadata are known to have been taken out already.
    """
    unknown = F.lit(True) if screened is None else ~screened
    words = F.regexp_extract_all(s, F.lit(T.PROSE_WORD), F.lit(0))
    return let(folded(s), lambda low: F.struct(
        s.alias("s"), F.size(words).alias("n"), T.starts_upper(s).alias("upper"),
        T.starts_quote(s).alias("quote"), hits_cs(s, V.SENTENCE_END_CS).alias("ends"),
        T.ends_cut(s).alias("cut"), in_list(F.lower(F.coalesce(
            F.get(words, F.size(words) - 1), F.lit(""))), V.DANGLING_END).alias("dangling"),
        hits_cs(s, V.COMPOUND_DANGLE_CS, low).alias("compound"),
        hits_cs(s, V.ABBREVIATION_END_CS, low).alias("abbrev"),
        hits(s, V.CONNECTIVE_OPEN, low).alias("connective"), T.is_roundup(s, low).alias("roundup"),
        T.unbalanced(s).alias("unbalanced"), (unknown & T.is_caption(s, low)).alias("caption"),
        (unknown & T.is_metadata(s, low)).alias("metadata"), low.alias("low")))


def _summary_rules(f: Column):
    full = f["s"] != ""
    return (
        (f["n"] < 12, "summary too short (<12 words)"),
        (full & ~f["upper"], "summary begins mid-sentence (not capitalized)"),
        (full & ~f["ends"], "summary is a headline fragment (no sentence-ending punctuation)"),
        (f["cut"], "summary is cut off (ends in an ellipsis)"),
        (f["dangling"], "summary ends mid-clause (cut off)"),
        (f["compound"], "summary ends with a dangling phrase (e.g. 'between the U.S.')"),
        (f["abbrev"], "summary ends at an abbreviation (split fragment)"),
        (f["connective"], "summary starts with a context-free connective (e.g. 'And,')"),
        (f["roundup"], "summary is a newsletter/roundup table-of-contents line"),
        (f["unbalanced"].isNotNull(), F.concat(F.lit("summary has "), f["unbalanced"])),
        (f["caption"], "summary is a photo caption / scene description"),
        (f["metadata"], "summary is author bio / publication metadata / stitched-quote text"),
    )


def _why_rules(f: Column):
    return (
        (f["quote"], "whyItMatters is a quote, not an explanation"),
        (f["n"] < 6, "whyItMatters too short (<6 words)"),
        (~f["upper"], "whyItMatters begins mid-sentence"),
        (~f["ends"], "whyItMatters is a fragment (no sentence end)"),
        (f["cut"], "whyItMatters is cut off (ends in an ellipsis)"),
        (f["dangling"], "whyItMatters ends mid-clause (cut off)"),
        (f["compound"], "whyItMatters ends with a dangling phrase (e.g. 'between the U.S.')"),
        (f["abbrev"], "whyItMatters ends at an abbreviation (split fragment)"),
        (f["connective"], "whyItMatters starts with a context-free connective (e.g. 'And,')"),
        (f["unbalanced"].isNotNull(), F.concat(F.lit("whyItMatters has "), f["unbalanced"])),
        (f["caption"], "whyItMatters is a photo caption, not an explanation"),
        (f["metadata"],
         "whyItMatters is author bio / publication metadata, not an explanation"),
    )


def _any(rules) -> Column:
    out = F.lit(False)
    for cond, _ in rules:
        out = out | cond
    return out


def summary_issues(summary) -> Column:
    """Everything wrong with a summary; empty when it is fit to publish."""
    return let(facts(_strip(summary)), lambda f: _issues(*_summary_rules(f)))


def bad_summary(f: Column) -> Column:
    """The facts of a text rule it out as a summary."""
    return _any(_summary_rules(f))


def bad_why(f: Column) -> Column:
    """The facts of a text rule it out as a why-it-matters line, whatever the story."""
    return _any(_why_rules(f))


def repeats_headline(keywords: Column, headline_keywords: Column) -> Column:
    return mostly(F.size(F.array_intersect(keywords, headline_keywords)), F.size(keywords))


def mostly(shared: Column, size: Column) -> Column:
    return (size > 0) & (shared / size >= 0.85)


def why_issues(why, summary, headline) -> Column:
    """Everything wrong with a why-it-matters line."""
    low_summary = F.lower(_strip(summary))
    w = _strip(why)
    repeats = (text(headline) != "") & repeats_headline(T.keywords(w), T.keywords(headline))
    more = _issues(
        (F.contains(low_summary, F.lower(w)), "whyItMatters is copied verbatim from the summary"),
        (repeats, "whyItMatters just repeats the headline"))
    return F.when(w == "", F.array(F.lit("whyItMatters empty"))).otherwise(
        F.concat(let(facts(w), lambda f: _issues(*_why_rules(f))), more))


def good_bullet(f: Column) -> Column:
    """One complete standalone sentence of 7 to 40 words."""
    return ((f["n"] >= 7) & (f["n"] <= 40) & f["upper"] & ~f["quote"] & f["ends"] & ~f["cut"]
            & ~f["dangling"] & ~f["compound"] & ~f["abbrev"] & ~f["connective"] & ~f["roundup"]
            & ~f["caption"] & ~f["metadata"])


def publish_issues(value) -> Column:
    """Failure classes the final prose gate looks for in any one field."""
    s = _strip(value)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(_issues(
        (hits_cs(s, V.COMPOUND_DANGLE_CS),
         "dangling compound ending (e.g. 'between the U.S.')"),
        (hits_cs(s, V.ABBREVIATION_END_CS), "ends at an abbreviation (split fragment)"),
        (hits(s, V.CAPTION_MEDIA), "photo/video credit caption text"),
        (hits(s, V.BIO_JOINED) | hits_cs(s, V.BIO_YEARS_AT_CS), "author-bio text"),
        (hits(s, V.CONNECTIVE_OPEN), "starts with a context-free connective (e.g. 'And,')"),
        (T.is_roundup(s), "newsletter/roundup table-of-contents line"),
        (hits_cs(s, r"\s[,.;:!?]"), "whitespace before punctuation (scrape artifact)"),
    ))


def headline_glued(headline, summary) -> Column:
    h, s = T.headline_key(headline), T.headline_key(summary)
    return (h != "") & (s != "") & (s != h) & s.startswith(F.concat(h, F.lit(" ")))
