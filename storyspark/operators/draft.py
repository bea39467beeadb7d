"""Extractive drafts: source text, summary, takeaways, why it matters.

Everything about one story happens inside its row, on arrays of its own sentences, so drafting is
a narrow map over the story table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import names, prose as P, text as T, urls
from ..functions.rules import hits, in_list, str_array, text
from ..functions.prose import let
from .violations import each, rule, union, violations

DATE = "edition_date"
MIN_PAGE_WORDS = 120
_EMPTY = "array<string>"


def article_texts(pages: DataFrame) -> DataFrame:
    """(id, text) of raw article pages whose readable text has at least 120 words."""
    read = pages.select("id", T.page_text("html").alias("text"))
    return read.filter(T.word_count("text") >= MIN_PAGE_WORDS)


def resolve_source_text(items: DataFrame, articles: DataFrame, bypass: DataFrame | None = None,
                        unavailable: DataFrame | None = None) -> DataFrame:
    """Add ``source_text`` and ``source_text_used``: article, else snippet, else none.

    ``articles`` is (id, text); ids in ``bypass`` skip their article, ids in ``unavailable`` have
    nothing at all.
    """
    keyed = items.join(articles.select("id", T.py_strip(text("text")).alias("_a")), "id", "left")
    for name, ids in (("_bypass", bypass), ("_gone", unavailable)):
        keyed = (keyed.withColumn(name, F.lit(False)) if ids is None else
                 keyed.join(ids.select("id").distinct().withColumn(name, F.lit(True)), "id", "left")
                 .withColumn(name, F.coalesce(name, F.lit(False))))
    snip = T.py_strip(text("snippet"))
    used = (F.when(F.col("_gone"), F.lit("none"))
            .when(~F.col("_bypass") & (text("_a") != ""), F.lit("full_article"))
            .when(snip != "", F.lit("rss_snippet")).otherwise(F.lit("none")))
    return keyed.withColumn("source_text_used", used).withColumn(
        "source_text", F.when(F.col("source_text_used") == "full_article", F.col("_a"))
        .when(F.col("source_text_used") == "rss_snippet", snip).otherwise(F.lit(""))
    ).drop("_a", "_bypass", "_gone")


def _summary(sents: Column) -> Column:
    """First fit sentence (headline-relevant first), else the first fit run of sentences."""
    order = F.array_sort(F.transform(sents, lambda x: F.struct(
        (x["score"] == 0).alias("off"), x["i"].alias("i"), x["s"].alias("s"), x["bad"].alias("bad"))))

    def run(start, body):
        return F.aggregate(
            F.slice(body, start["i"] + 2, F.size(body)),
            F.struct(start["s"].alias("s"), F.lit(False).alias("ok")),
            lambda acc, nxt: F.when(acc["ok"], acc).otherwise(let(
                F.concat(acc["s"], F.lit(" "), nxt["s"]),
                lambda joined: F.struct(joined.alias("s"),
                                        (~let(P.facts(joined), P.bad_summary)).alias("ok")))),
            lambda acc: F.when(acc["ok"], acc["s"]).otherwise(F.lit("")))

    def joined(o, body):
        return F.aggregate(F.filter(o, lambda x: T.starts_upper(x["s"])), F.lit(""),
                           lambda acc, x: F.when(acc != "", acc).otherwise(run(x, body)))

    return let(F.struct(order.alias("o"), sents.alias("b")), lambda v: F.coalesce(
        F.get(F.filter(v["o"], lambda x: ~x["bad"]), F.lit(0))["s"], joined(v["o"], v["b"])))


def _why(sents: Column, summary: Column) -> Column:
    """First usable stakes sentence about the headline, else any stakes, else any sentence."""
    def pick(v):
        usable = F.filter(v["s"], lambda x: ~x["bad_why"] & ~x["echo"]
                          & ~F.contains(v["low"], F.lower(x["s"])))
        return let(usable, lambda u: F.coalesce(
            F.get(F.filter(u, lambda x: x["stakes"] & (x["score"] > 0)), F.lit(0))["s"],
            F.get(F.filter(u, lambda x: x["stakes"]), F.lit(0))["s"],
            F.get(u, F.lit(0))["s"], F.lit("")))

    return let(F.struct(sents.alias("s"), F.lower(summary).alias("low")), pick)


def top_takeaways(sents: Column, summary: Column, why: Column, limit: int = 3) -> Column:
    """Up to three bullets, headline-relevant first, none close to another or to the copy."""
    def pick(v):
        pool = F.array_sort(F.transform(
            F.filter(v["s"], lambda x: ~F.contains(v["sum"], x["s"]) & (x["s"] != v["why"])
                     & x["bullet"]),
            lambda x: F.struct((x["score"] == 0).alias("off"), x["i"].alias("i"),
                               x["s"].alias("s"), x["words"].alias("words"))))
        start = F.struct(
            F.array().cast(_EMPTY).alias("out"),
            F.filter(F.array(T.keywords(v["sum"]), T.keywords(v["why"])),
                     lambda k: F.size(k) > 0).alias("used"))

        def step(acc, x):
            return F.when(F.size(acc["out"]) >= limit, acc).otherwise(let(
                x["words"], lambda k: F.when(
                    (F.size(k) == 0) | F.exists(acc["used"], lambda u: T.jaccard(k, u) >= 0.6), acc
                ).otherwise(F.struct(F.concat(acc["out"], F.array(x["s"])).alias("out"),
                                     F.concat(acc["used"], F.array(k)).alias("used")))))

        return F.aggregate(pool, start, step, lambda acc: acc["out"])

    return let(F.struct(sents.alias("s"), summary.alias("sum"), why.alias("why")), pick)


def sentence_table(clean: Column, headline: Column, screened: Column) -> Column:
    """array<struct<i, s, words, score, bad, bad_why, bullet, echo, stakes>> of clean sentences."""
    def row(s, i, hk, ok):
        told = let(T.keywords(s), lambda w: F.struct(w.alias("w"), F.size(F.array_intersect(w, hk)).alias("n")))
        return let(F.struct(P.facts(s, ok).alias("f"), told.alias("k")), lambda x: F.struct(
            i.alias("i"), s.alias("s"), x["k"]["w"].alias("words"), x["k"]["n"].alias("score"),
            P.bad_summary(x["f"]).alias("bad"), P.bad_why(x["f"]).alias("bad_why"),
            P.good_bullet(x["f"]).alias("bullet"),
            P.mostly(x["k"]["n"], F.size(x["k"]["w"])).alias("echo"), hits(s, V.STAKES, x["f"]["low"]).alias("stakes")))

    return let(F.struct(clean.alias("c"), T.keywords(headline).alias("hk"), screened.alias("ok")),
               lambda v: F.transform(v["c"], lambda s, i: row(s, i, v["hk"], v["ok"])))


def with_clean_sentences(df: DataFrame, body: str = "source_text", source: str = "source",
                         out: str = "clean") -> DataFrame:
    """Add the clean body sentences of a text column."""
    return df.withColumn("_text", T.decoded(body)).withColumn(
        out, _clean(F.col("_text"), source)).drop("_text")


def _clean(decoded: Column, source) -> Column:
    return let(F.struct(decoded.alias("t"), names.brand_key(source).alias("b")),
               lambda v: T.clean_sentences(v["t"], v["b"]))


def without_headline(clean: Column, headline: Column) -> Column:
    """Sentences with a glued-on headline taken off."""
    return let(F.struct(clean.alias("c"), T.headline_key(headline).alias("h")), lambda v: F.filter(
        F.transform(v["c"], lambda s: T.strip_head(s, v["h"])), lambda s: s != ""))


def draft(items: DataFrame) -> DataFrame:
    """Add ``summary``, ``key_takeaways``, ``why``, ``read_time``, ``confidence``, ``flags``.

    Input: title, source, paywalled, source_text, source_text_used (see ``resolve_source_text``).
    """
    none = (F.col("source_text_used") == "none") | (F.col("source_text") == "")
    snippet_only = F.col("source_text_used") == "rss_snippet"
    df = items.withColumns({"_plain": T.decoded("source_text"), "_words": T.word_count("source_text")})
    df = df.withColumn("_found", _clean(F.col("_plain"), "source"))
    df = df.withColumn("_clean", without_headline(F.col("_found"), F.col("title")))
    df = df.withColumn("_sents", sentence_table(F.col("_clean"), F.col("title"),
                                                F.col("_clean") == F.col("_found")))
    raw = F.when(snippet_only, F.regexp_replace(F.trim(F.regexp_replace(
        T.py_strip(F.col("_plain")), r"(?U)\s+", " ")), r"\s+([,.;:!?])", "$1")).otherwise(F.lit(""))
    bare = F.size("_clean") == 0
    df = df.withColumn("summary", F.when(none, F.lit("")).when(
        bare, let(raw, lambda r: F.when((r != "") & (F.size(P.summary_issues(r)) == 0), r)
                  .otherwise(F.lit("")))).otherwise(_summary(F.col("_sents"))))
    told = ~none & ~bare & (F.col("summary") != "")
    df = df.withColumn("_why", F.when(told, _why(F.col("_sents"), F.col("summary")))
                       .otherwise(F.lit("")))
    df = df.withColumn("key_takeaways", F.when(told, top_takeaways(
        F.col("_sents"), F.col("summary"), F.col("_why"))).otherwise(F.array().cast(_EMPTY)))
    spare = let(F.struct(F.col("_clean").alias("c"), F.col("summary").alias("sum"),
                         F.col("key_takeaways").alias("k")),
                lambda v: F.filter(v["c"], lambda s: ~F.contains(v["sum"], s)
                                   & ~F.array_contains(v["k"], s)))
    closing = F.coalesce(F.get(F.reverse(spare), F.lit(0)),
                         F.get(F.reverse("key_takeaways"), F.lit(0)), F.col("summary"))
    df = df.withColumn("why", F.when(told & (F.col("_why") == ""), closing).otherwise(F.col("_why")))
    copy = F.concat_ws(" ", "summary", F.array_join("key_takeaways", " "), "why")
    df = df.withColumn("_ung", F.when(none, F.array().cast(_EMPTY)).otherwise(
        T.ungrounded(copy, F.concat(F.col("_plain"), F.lit(" "), F.col("title")))))
    open_why = told & (F.size(P.why_issues(F.col("why"), F.col("summary"), F.col("title"))) > 0)
    human = F.when(~told, F.array_compact(F.array(
        F.when(F.col("summary") == "", F.lit("summary_needs_human")),
        F.when(F.col("summary") == "", F.lit("needs_review")),
        F.lit("keyTakeaways_needs_human"), F.lit("whyItMatters_needs_human"))))
    drafted = F.concat(
        F.array(F.lit("extractive_draft")),
        F.when(snippet_only, str_array(["thin_source", "rss_snippet_only"])).otherwise(
            F.array().cast(_EMPTY)),
        F.coalesce(human, F.array().cast(_EMPTY)),
        F.array_compact(F.array(
            F.when(open_why, F.lit("whyItMatters_needs_human")),
            F.when(told & (F.size("key_takeaways") < 3), F.lit("keyTakeaways_thin")),
            F.when(F.coalesce("paywalled", F.lit(False)), F.lit("paywalled")),
            F.when(F.size("_ung") > 0, F.concat(F.lit("ungrounded_tokens:"), F.array_join(
                F.slice("_ung", 1, 6), ","))),
            F.when(F.size("_ung") > 0, F.lit("needs_review")))))
    flags = F.when(none, str_array(["source_unavailable", "needs_review"])).otherwise(drafted)
    confidence = (F.when(~told | (F.size("_ung") > 0) | snippet_only, F.lit("low"))
                  .when((F.col("_words") >= 250) & (F.size("_clean") >= 4), F.lit("high"))
                  .otherwise(F.lit("medium")))
    return df.withColumns({
        "flags": flags, "confidence": confidence,
        "read_time": F.when(none, F.lit(0)).otherwise(T.minutes(F.col("_words"))),
    }).drop("_found", "_clean", "_sents", "_plain", "_words", "_why", "_ung")


# --- validation --------------------------------------------------------------------------------

def draft_vs_selection(drafts: DataFrame, selection: DataFrame) -> DataFrame:
    """Id-set equality both ways and unchanged url, source and lead."""
    a = drafts.select(DATE, "id", F.col("url").alias("d_url"), F.col("source").alias("d_source"),
                      F.col("lead").alias("d_lead"), F.lit(True).alias("_d"))
    b = selection.select(DATE, "id", F.col("url").alias("s_url"), F.col("source").alias("s_source"),
                         F.col("lead").alias("s_lead"), F.lit(True).alias("_s"))
    both = a.join(b, [DATE, "id"], "full_outer")
    known = F.col("_d").isNotNull() & F.col("_s").isNotNull()

    def differs(x, y):
        return known & ~F.col(x).eqNullSafe(F.col(y))

    return violations(both, F.col(DATE), [
        rule(F.col("_s").isNull(), "selection-mismatch", F.col("id"), "draft is not in the selection"),
        rule(F.col("_d").isNull(), "selection-mismatch", F.col("id"), "selected story has no draft"),
        rule(differs("d_lead", "s_lead"), "lead-mismatch", F.col("id"), "lead changed"),
        rule(differs("d_url", "s_url"), "url-changed", F.col("id"), "URL changed from selection."),
        rule(differs("d_source", "s_source"), "source-changed", F.col("id"),
             "source changed from selection."),
    ])


def validate_drafts(drafts: DataFrame, strict: bool = True) -> DataFrame:
    """Draft rules; rows of rule 'warn' do not block (V9, strict as for automatic publishing)."""
    ident = F.col("id")
    flagged = F.exists("flags", lambda f: in_list(f, [
        "needs_review", "source_unavailable", "thin_source", "keyTakeaways_needs_human",
        "whyItMatters_needs_human"]))
    missing = F.array_join(F.array_compact(F.array(
        F.when(text("title") == "", F.lit("headline")),
        F.when(text("summary") == "", F.lit("summary")),
        F.when(F.size("key_takeaways") == 0, F.lit("keyTakeaways")))), ", ")
    rules = [
        rule(~urls.is_https_article("url"), "url", ident, "originalURL is not a real https article URL."),
        rule((missing != "") & ~flagged, "missing", ident,
             F.concat(F.lit("missing ["), missing, F.lit("] with no explaining flag."))),
        rule((missing != "") & flagged, "warn", ident,
             F.concat(F.lit("missing ["), missing, F.lit("] (flagged: ok to hand-fill)."))),
        rule(F.col("confidence") == "low", "warn", ident, "low confidence."),
        rule(F.col("source_text_used") == "rss_snippet", "warn", ident, "snippet-only source (thin)."),
        rule(F.col("source_text_used") == "none", "warn", ident, "extraction/source failure."),
        rule(F.exists("flags", lambda f: f.startswith("ungrounded_tokens")), "warn", ident,
             "possible unsupported numbers/proper nouns."),
        rule(F.array_contains("flags", "paywalled"), "warn", ident, "paywalled source."),
    ]
    arrays = []
    if strict:
        bad = F.array_sort(F.array_intersect(F.array_distinct("flags"), str_array(V.BLOCKING_FLAGS)))
        rules += [
            rule(F.size(bad) > 0, "blocking-flag", ident, F.concat(
                F.lit("unresolved blocking flag(s): "), F.array_join(bad, ", "))),
            rule(F.col("confidence") == "low", "low-confidence", ident,
                 "low confidence — too uncertain to auto-publish."),
            rule(F.size("key_takeaways") < 1, "takeaways", ident,
                 "needs at least one keyTakeaway to auto-publish."),
            rule(T.py_strip(text("why")) == "", "why", ident,
                 "missing whyItMatters — required to auto-publish."),
        ]
        empty = F.array().cast(_EMPTY)
        arrays = [
            each(F.when(text("summary") != "", P.summary_issues("summary")).otherwise(empty),
                 "summary", ident),
            each(F.when(text("why") != "", P.why_issues("why", "summary", "title")).otherwise(empty),
                 "why", ident)]
    return violations(drafts, F.col(DATE), rules, arrays)


def validation_report(drafts: DataFrame, found: DataFrame) -> DataFrame:
    """Per date: result, failed ids, hard and warning counts."""
    hard = F.col("rule") != "warn"
    per = found.groupBy("key").agg(
        F.count_if(hard).alias("hard"), F.count_if(~hard).alias("warnings"),
        F.array_sort(F.collect_set(F.when(hard, F.col("field")))).alias("failed_ids"))
    return (drafts.select(F.col(DATE).cast("string").alias("key")).distinct()
            .join(per, "key", "left").select(
        "key", F.when(F.coalesce("hard", F.lit(0)) > 0, F.lit("fail")).otherwise(F.lit("pass"))
        .alias("result"), F.coalesce("hard", F.lit(0)).alias("hard"),
        F.coalesce("warnings", F.lit(0)).alias("warnings"),
        F.coalesce("failed_ids", F.array().cast(_EMPTY)).alias("failed_ids")))


def strict_check(drafts: DataFrame, selection: DataFrame) -> DataFrame:
    """All violations of drafted editions: selection match and draft rules."""
    return union(draft_vs_selection(drafts, selection), validate_drafts(drafts))
