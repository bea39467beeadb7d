"""Text clean-up, tokens and sentences."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import vocab as V
from .rules import contains_any, folded, hits, hits_cs, in_list, let, may_hit, str_array, text

WORD = r"[A-Za-z0-9'$%.\-]+"
PROSE_WORD = r"[A-Za-z0-9']+"


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    """Decode every HTML entity."""
    return s.map(lambda x: None if x is None else (html.unescape(x) if "&" in x else x))


def decoded(s) -> Column:
    """``unescape`` that sends only texts with an entity to Python."""
    t = text(s)
    return F.coalesce(unescape(F.when(F.contains(t, F.lit("&")), t)), t)


def clean_text(s) -> Column:
    """Tags removed, entities decoded, trimmed."""
    return py_strip(unescape(F.regexp_replace(text(s), "<[^>]+>", "")))


def py_strip(c: Column) -> Column:
    """Trim every kind of white space on both sides."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def snippet(s) -> Column:
    return F.substring(clean_text(s), 1, V.SNIPPET_CHARS)


def page_text(doc) -> Column:
    """Readable text of a page: chrome blocks dropped, block tags become line breaks."""
    drop = (r"(?is)<(script|style|noscript|nav|header|footer|aside|figure|figcaption|form)\b"
            r".*?</\1>")
    block = r"(?is)<(br|/p|/div|/li|/h[1-6]|/section|/article)\s*/?>"
    body = F.regexp_replace(F.regexp_replace(text(doc), drop, " "), block, "\n")
    plain = F.replace(unescape(F.regexp_replace(body, "<[^>]+>", " ")), F.lit("\u00a0"),
                      F.lit(" "))
    lines = F.regexp_replace(plain, r"(?U)\n\s*\n+", "\n")
    return py_strip(F.regexp_replace(lines, "[ \t]+", " "))


def title_tokens(title) -> Column:
    """Sorted set of stemmed title words used for title similarity."""
    words = F.regexp_extract_all(F.lower(text(title)), F.lit("[a-z0-9]+"), F.lit(0))
    kept = F.filter(words, lambda w: (F.length(w) > 2)
                    & ~F.array_contains(str_array(V.TITLE_STOPWORDS), w))
    stemmed = F.transform(kept, lambda w: F.when(
        w.endswith("s") & (F.length(w) > 4),
        F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w))
    return F.array_sort(F.array_distinct(stemmed))


def keywords(s) -> Column:
    """Set of telling words of four or more characters."""
    words = F.regexp_extract_all(F.lower(text(s)), F.lit("[a-z0-9]{4,}"), F.lit(0))
    return F.array_distinct(F.filter(words, lambda w: ~in_list(w, V.KEYWORD_STOPWORDS)))


def headline_key(s) -> Column:
    return F.trim(F.regexp_replace(F.lower(text(s)), "[^a-z0-9]+", " "))


def norm_tokens(s) -> Column:
    key = headline_key(s)
    return F.when(key == "", F.array().cast("array<string>")).otherwise(F.split(key, " "))


def jaccard(a: Column, b: Column) -> Column:
    """Set Jaccard of two arrays; 0 when both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(a, b)).cast("double") / union)


def word_count(s) -> Column:
    return F.size(F.regexp_extract_all(text(s), F.lit(WORD), F.lit(0)))


def read_time(s) -> Column:
    """Whole minutes at 200 words a minute, half-even, at least one."""
    return minutes(word_count(s))


def minutes(words: Column) -> Column:
    return F.greatest(F.lit(1), F.bround(words / 200.0, 0).cast("int"))


def read_time_int(s) -> Column:
    """Digits of the value as an integer, 0 when there are none."""
    digits = F.regexp_replace(text(s), "[^0-9]", "")
    return F.when(digits == "", F.lit(0)).otherwise(digits.cast("int"))


def trunc(s, n: int) -> Column:
    """Trimmed text, cut to ``n`` characters with an ellipsis."""
    t = py_strip(text(s))
    cut = F.regexp_replace(F.substring(t, 1, n - 1), r"(?U)\s+$", "")
    return F.when(F.length(t) <= n, t).otherwise(F.concat(cut, F.lit("…")))


# --- sentence predicates -----------------------------------------------------------------------

def is_caption(s, low: Column | None = None) -> Column:
    """Photo caption or scene description; ``low`` is the ``folded`` text."""
    return (hits(s, V.CAPTION_LEAD, low) | hits(s, V.CAPTION_CUE, low) | hits(s, V.CAPTION_SCENE, low)
            | hits(s, V.CAPTION_VERB, low) | hits(s, V.CAPTION_MEDIA, low))


def is_metadata(s, low: Column | None = None) -> Column:
    """Author biography, publication metadata, photo credit or stitched quote."""
    return (hits(s, V.METADATA_BIO, low) | hits(s, V.METADATA_CAPTION, low)
            | hits(s, V.STITCHED_QUOTE, low) | hits(s, V.BIO_JOINED, low)
            | hits_cs(s, V.BIO_YEARS_AT_CS, low))


def occurrences(s, needle: str) -> Column:
    return ((F.length(text(s)) - F.length(F.replace(text(s), F.lit(needle), F.lit(""))))
            / len(needle))


def is_roundup(s, low: Column | None = None) -> Column:
    """Newsletter contents line or a semicolon list of topics."""
    return hits(s, V.ROUNDUP_LINE, low) | (occurrences(s, ";") >= 2)


def starts_upper(s) -> Column:
    return text(s).rlike(r"^\p{Lu}")


def starts_quote(s) -> Column:
    return text(s).rlike("^[\"“'‘]")


def ends_cut(s) -> Column:
    return text(s).rlike("(?U)" + V.ELLIPSIS_END)


def last_word(s) -> Column:
    words = F.regexp_extract_all(text(s), F.lit(PROSE_WORD), F.lit(0))
    return F.lower(F.coalesce(F.get(words, F.size(words) - 1), F.lit("")))


def prose_words(s) -> Column:
    return F.size(F.regexp_extract_all(text(s), F.lit(PROSE_WORD), F.lit(0)))


def unbalanced(s) -> Column:
    """'unmatched quotation marks' / 'unmatched brackets/parentheses' / NULL."""
    t = text(s)
    quotes = ((occurrences(t, '"').cast("int") % 2 != 0)
              | (occurrences(t, "“") != occurrences(t, "”")))
    brackets = F.lit(False)
    for o, c in (("(", ")"), ("[", "]"), ("{", "}")):
        brackets = brackets | (occurrences(t, o) != occurrences(t, c))
    return F.when(t.rlike(r'["“”()\[\]{}]'), F.when(quotes, F.lit("unmatched quotation marks")).when(
        brackets, F.lit("unmatched brackets/parentheses")))


# --- sentences ---------------------------------------------------------------------------------

_TITLES = "Mr|Mrs|Ms|Dr|Prof|Gen|Sen|Rep|Gov|St|Jr|Sr|vs|No|Inc|Ltd|Co|Corp"
# A sentence ends at white space after . ! ? unless the full stop belongs to an abbreviation.
SENTENCE_BREAK = (r"(?U)(?<=[.!?])(?<!\b[A-Za-z]\.[A-Za-z]\.)(?<!\b(?:" + _TITLES + r")\.)\s+"
                  r"|\n+")


# Every pattern that marks a sentence as no body text.
_MARKS = [V.BYLINE, V.AUTHOR_BIO, V.AFFILIATE, V.CREDIT_END, V.CAPTION_LEAD, V.CAPTION_CUE, V.CAPTION_SCENE,
          V.CAPTION_VERB, V.CAPTION_MEDIA, V.METADATA_BIO, V.METADATA_CAPTION, V.STITCHED_QUOTE, V.BIO_JOINED,
          V.BIO_YEARS_AT_CS]


def _misshapen(s: Column) -> Column:
    """Too short, too long, or without the form of a sentence."""
    words = F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) + 1
    return ((s == "") | (words < 6) | (words > 60)
            | ~s.rlike("[.!?][\"')”]?$") | ~s.rlike("[a-z]") | ends_cut(s))


def _marked(s: Column, low: Column, fold: Column, brand: Column) -> Column:
    """Boilerplate, byline, caption, metadata or navigation text."""
    brand_twice = (brand != "") & (
        F.length(low) - F.length(F.replace(low, brand, F.lit(""))) >= 2 * F.length(brand))
    return (contains_any(low, V.BOILERPLATE)
            | hits(s, V.BYLINE, fold) | hits(s, V.AUTHOR_BIO, fold) | hits(s, V.AFFILIATE, fold)
            | hits(s, V.CREDIT_END, fold) | brand_twice | is_caption(s, fold) | is_metadata(s, fold))


def _bad_sentence(s: Column, brand: Column) -> Column:
    """The rules are asked one by one only where the one search finds a literal of any, or the brand occurs."""
    def marked(fold):
        maybe = may_hit(fold, _MARKS, V.BOILERPLATE) | ((brand != "") & F.contains(fold, brand))
        return maybe & let(F.lower(s), lambda low: _marked(s, low, fold, brand))

    return _misshapen(s) | let(folded(s), marked)


def clean_sentences(decoded, brand) -> Column:
    """Body sentences of entity-decoded text, in order, without boilerplate or repeats.

    ``brand`` is the source's ``brand_key`` (repetition of it marks navigation text).
    """
    raw = F.split(F.replace(text(decoded), F.lit("\u00a0"), F.lit(" ")), SENTENCE_BREAK)
    tidy = F.transform(raw, lambda s: F.regexp_replace(
        F.trim(F.regexp_replace(s, r"(?U)\s+", " ")), r"\s+([,.;:!?])", "$1"))
    return F.array_distinct(F.filter(tidy, lambda s: ~_bad_sentence(s, text(brand))))


def strip_headline(s: Column, headline) -> Column:
    """Drop a headline glued onto a sentence; '' when no real sentence is left."""
    return let(headline_key(headline), lambda head: strip_head(s, head))


def strip_head(s: Column, head: Column) -> Column:
    """``strip_headline`` for the ``headline_key`` of a headline."""
    glued = (head != "") & headline_key(s).startswith(F.concat(head, F.lit(" ")))
    walk = F.concat(F.lit("(?is)^.*?"), F.replace(head, F.lit(" "), F.lit(".*?")))
    rest = F.regexp_replace(F.regexp_replace(s, walk, F.lit("")),
                            "^[ \t\\-–—:;,.\"'“”’]+", "")
    keep = (F.size(F.split(F.trim(rest), r"\s+")) >= 6) & starts_upper(rest)
    return F.when(~glued, s).when(keep, rest).otherwise(F.lit(""))


def ungrounded(draft, source) -> Column:
    """Sorted numbers and proper nouns of the draft that the source does not contain."""
    tokens = F.array_distinct(F.regexp_extract_all(text(draft), F.lit(WORD), F.lit(0)))
    telling = F.filter(tokens, lambda t: t.rlike("[0-9]") | t.rlike("^[A-Z][a-zA-Z]{2,}$"))
    words = F.regexp_extract_all(text(source), F.lit(WORD), F.lit(0))
    # Tokens hold no white space, so a word stands between two blanks in one text of all words.
    known = F.lower(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")))
    return let(known, lambda src: F.array_sort(F.filter(
        telling, lambda t: ~F.contains(src, F.concat(F.lit(" "), F.lower(t), F.lit(" "))))))
