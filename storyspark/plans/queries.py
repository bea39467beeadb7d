"""Registered queries: every operator over whole driver tables (or tables derived from them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import classify as C, mixes as M, names, numbers as N, prose as P, text as T, times, urls
from ..operators import (dialogue as DG, draft as D, duplicates as DU, edition as E, history as H,
                         images as IM, ingest as G, lookup as L, mix as X, pool as PO, quality as Q,
                         scoring as S, similarity as SI)
from ..operators.violations import error_categories
from ..session import prepare, spread, written
from ..streaming import keyed as K
from . import inputs as I, jobs as J

DATE = "edition_date"
QUERIES: dict = {}


def day():
    """The edition date as text."""
    return F.col(DATE).cast("string").alias(DATE)


def register(fn):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(prepare(spark), sf)
    QUERIES[fn.__name__] = run
    return fn


def joined(c, sep="|"):
    return F.array_join(c, sep)


def flag(c):
    """Booleans as 0/1."""
    return F.coalesce(c.cast("int"), F.lit(0))


# --- derived tables ----------------------------------------------------------------------------

def sliced(candidates, size: int) -> DataFrame:
    """Candidates cut into days of ``size`` in their order, each next one ``I.DATES`` days earlier; with ``number``."""
    at = F.row_number().over(Window.partitionBy(DATE).orderBy("seq")) - 1
    rows = candidates.withColumn("_at", at)
    return rows.withColumns({"number": F.col("_at") % size + 1, DATE: F.date_sub(
        DATE, (F.floor(F.col("_at") / size) * I.DATES).cast("int"))}).drop("_at")


@I.derived
def editions(spark, sf) -> DataFrame:
    """Past editions: the candidates of a date, five by five; the first five ran on the day before it and
    every next five ``I.DATES`` days earlier, so each candidate is in one edition."""
    rows = sliced(I.candidates(spark, sf), 5)
    return rows.select(
        F.date_sub(DATE, F.lit(1)).alias(DATE), F.col("number").cast("int"),
        F.col("number").cast("int").alias("importance"), (F.col("number") == 1).alias("lead"),
        "category", "source", F.col("title").alias("headline"), F.col("snippet").alias("summary"),
        F.array("title", "snippet").alias("keyTakeaways"),
        F.col("snippet").alias("whyItMatters"), F.col("url").alias("originalURL"),
        F.length("snippet").alias("readTime"),
        F.concat(F.lit("https://img.example.com/"), (F.col("seq") % 7).cast("string"),
                 F.lit(".jpg")).alias("imageURL"),
        F.lit("").alias("placeTime"), F.lit("").alias("audioURL"))


def requests(spark, sf) -> DataFrame:
    """Mix requests: one per event, with regions and topics spelled as clients spell them."""
    e = I.read(spark, sf, "events")
    u = F.col("user_id")
    regions = F.filter(F.array(
        F.when(u % 7 != 1, F.lit("U.S")), F.when(u % 2 == 1, F.lit("JP")),
        F.when((u % 7 == 1) | (u % 3 == 0), F.lit(" World "))), lambda x: x.isNotNull())
    topics = F.filter(F.array(*[F.when((u / (i + 2)).cast("int") % 3 == 0, F.lit(t.upper()))
                                for i, t in enumerate(V.SUPPORTED_TOPICS)]), lambda x: x.isNotNull())
    return e.select("event_id", "user_id", "ts", F.date_add(F.lit("2026-07-20").cast("date"), (
        u % I.DATES).cast("int")).alias(DATE), regions.alias("regions"), topics.alias("topics"))


def scored(spark, sf) -> DataFrame:
    return S.with_eligibility(S.score_candidates(I.candidates(spark, sf)))


@I.derived
def pool(spark, sf) -> DataFrame:
    """Frozen pools, without the 6-hex ids that stand for several stories at larger sizes."""
    built = PO.build_pool(G.prepare_pool_source(S.narrow(I.candidates(spark, sf))).filter(
        "drop_reason IS NULL").drop("drop_reason"))
    return built.filter(F.col("exclusion_reason").isNull())


@I.derived
def classed(spark, sf) -> DataFrame:
    return S.with_classes(spread(S.narrow(I.candidates(spark, sf))))


# --- urls, text, times (F1-F22, P2-P4) ---------------------------------------------------------

@register
def url_forms(spark, sf):
    p = I.read(spark, sf, "pages")
    return p.select("page_id", urls.canonical_url("url").alias("canonical"),
                    urls.pool_url("url").alias("pool_form"), urls.selector_url("url").alias("selector_form"),
                    urls.story_url_key("url").alias("story_key"), urls.stable_id("url").alias("id"),
                    flag(urls.has_real_url("url")).alias("real_url"),
                    flag(urls.is_homepage("url")).alias("homepage"))


@register
def url_id_collisions(spark, sf):
    p = I.read(spark, sf, "pages").select(
        F.lit("all").alias(DATE), urls.stable_id("url").alias("id"),
        urls.canonical_url("url").alias("canonical_url"))
    return G.id_collisions(p)


@register
def html_snippets(spark, sf):
    p = spread(I.read(spark, sf, "pages"))
    return p.select("page_id", T.clean_text("html").alias("clean"), T.snippet("html").alias("snippet"))


@register
def html_page_text(spark, sf):
    p = spread(I.read(spark, sf, "pages")).select("page_id", T.page_text("html").alias("text"))
    return p.select("page_id", "text", T.word_count("text").alias("words"))


@register
def feed_times(spark, sf):
    r = I.raw_items(spark, sf).withColumn("t", times.feed_time("pub_date"))
    return r.select("seq", F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("published"),
                    F.round(times.hours_old("t", "now"), 6).alias("hours_old"),
                    F.round(times.recency("t", "now", 36), 6).alias("recency"),
                    flag(times.is_stale("t", "now", 48)).alias("stale"),
                    flag(times.iso_time(times.iso_z(F.col("t"))) == F.col("t")).alias("round_trip"))


@register
def source_names(spark, sf):
    r = I.raw_items(spark, sf)
    return r.groupBy("source").agg(F.count("*").alias("items")).select(
        "source", "items", names.publisher_key("source").alias("publisher"),
        names.publisher_family("source").alias("family"), names.slug("source").alias("slug"),
        names.brand_key("source").alias("brand"), flag(names.is_reliable("source")).alias("reliable"))


@register
def title_token_sets(spark, sf):
    d = I.read(spark, sf, "documents")
    return d.select("doc_id", joined(T.title_tokens("text")).alias("tokens"))


@register
def keyword_sets(spark, sf):
    d = I.read(spark, sf, "documents")
    return d.select("doc_id", joined(F.array_sort(T.keywords("text"))).alias("keywords"),
                    F.md5(T.headline_key("text")).alias("headline_key_md5"))


@register
def reading_times(spark, sf):
    d = I.read(spark, sf, "documents")
    return d.select("doc_id", T.word_count("text").alias("words"), T.read_time("text").alias("minutes"),
                    T.read_time_int(F.concat(T.read_time("text").cast("string"), F.lit(" min"))).alias("parsed"),
                    T.trunc("text", 130).alias("short"))


@register
def clean_sentence_sets(spark, sf):
    d = spread(I.read(spark, sf, "documents"))
    c = D.with_clean_sentences(d, "text", "source", "clean")
    return c.select("doc_id", F.size("clean").alias("sentences"),
                    F.md5(F.array_join("clean", "\n")).alias("digest"))


@register
def ungrounded_titles(spark, sf):
    r = I.raw_items(spark, sf)
    return r.select("seq", joined(T.ungrounded("title", "body")).alias("tokens"))


@register
def stated_numbers(spark, sf):
    d = spread(I.read(spark, sf, "documents"))
    return d.select("doc_id", joined(N.source_numbers("text")).alias("numbers"))


@register
def score_contract(spark, sf):
    e = I.read(spark, sf, "events")
    x = F.col("value") * F.when(F.col("event_id") % 5 == 0, 100.0).otherwise(1.0) - 20.0
    v = F.round(x, 2)
    return e.select("event_id", N.score_text(v).alias("score_text"), N.score_problem(v).alias("problem"))


@register
def json_member_checks(spark, sf):
    e = I.read(spark, sf, "events")
    doc = F.concat(F.lit('{"event":"'), F.col("event_type"), F.lit('","body":'), F.col("props"),
                   F.when(F.col("event_id") % 50 == 0, F.lit(',"Api_Key":"file:///x"')).otherwise(F.lit("")),
                   F.lit("}"))
    j = e.select("event_id", doc.alias("json"))
    return j.select("event_id", joined(M.forbidden_keys("json", V.ENRICHED_FORBIDDEN_KEYS)).alias("forbidden"),
                    flag(M.has_local_path("json")).alias("local_path"),
                    joined(M.missing_keys("json", ["event", "body", "id"])).alias("missing"),
                    joined(M.extra_keys("json", ["event", "body"])).alias("extra"))


@register
def mix_identities(spark, sf):
    r = requests(spark, sf)
    regions, topics = M.normalize_regions("regions"), M.normalize_topics("topics")
    return r.select("event_id", joined(regions, ",").alias("regions"), joined(topics, ",").alias("topics"),
                    M.mix_identity(DATE, regions, topics).alias("mix_id"),
                    F.size(M.unsupported_regions("regions")).alias("unsupported"))


@register
def region_quotas(spark, sf):
    r = requests(spark, sf).withColumn("r", M.normalize_regions("regions"))
    q = M.quotas("r")
    return r.select(joined("r", ",").alias("regions"), *[
        F.coalesce(F.element_at(q, n), F.lit(0)).alias(n) for n in V.REGION_PRIORITY]).groupBy(
            "regions", *V.REGION_PRIORITY).agg(F.count("*").alias("requests"))


@register
def paste_detection(spark, sf):
    c = I.read(spark, sf, "conversations")
    first = c.filter("turn <= 1").groupBy("conv_id").agg(F.min_by("text", "turn").alias("source"))
    rows = c.join(first, "conv_id").withColumn("runs", N.paste_runs("text", "source"))
    return rows.select("conv_id", "turn", F.size("runs").alias("n_runs"),
                       flag(N.is_paste(F.col("runs"), "text", "source")).alias("pasted"))


# --- ingest (P1, P12, W1, A2, A4, A5, J1, A1, Q1) ----------------------------------------------

@register
def ingest_reasons(spark, sf):
    f = G.ingest_filter(I.raw_items(spark, sf))
    return f.select("seq", "canonical_url", F.coalesce("skip_reason", F.lit("kept")).alias("reason"))


@register
def ingest_counts(spark, sf):
    f = G.ingest_filter(I.raw_items(spark, sf))
    return G.reason_counts(f, "skip_reason").select(day(), "reason", "n")


@register
def ingest_sources(spark, sf):
    return G.ingest_report(I.candidates(spark, sf)).select(day(), "source", "candidates")


@register
def cluster_outlets(spark, sf):
    return G.cluster_report(I.candidates(spark, sf)).select(
        day(), "cluster_id", "cluster_size", "title", "outlets")


@register
def cluster_sizes(spark, sf):
    return I.candidates(spark, sf).select("seq", "cluster_id", "cluster_size", "cluster_sources")


@register
def first_urls(spark, sf):
    p = I.read(spark, sf, "pages").withColumn("host", F.lower(urls.authority("url")))
    return G.first_by(p, ["host"], "page_id").select("page_id", "host", flag(F.col("is_first")).alias("is_first"))


@register
def pool_source_drops(spark, sf):
    return G.prepare_pool_source(I.candidates(spark, sf)).select(
        "seq", F.coalesce("drop_reason", F.lit("kept")).alias("reason"))


@register
def similar_titles(spark, sf):
    return SI.similar_titles(I.raw_items(spark, sf)).select(
        day(), "seed", "member", F.col("shared").cast("long"), F.col("total").cast("long"))


@register
def title_clusters(spark, sf):
    return SI.cluster_titles(I.raw_items(spark, sf)).select(day(), "seq", "cluster_id")


@register
def ingest_job(spark, sf):
    return J.ingest_job(I.raw_items(spark, sf).drop("body", "lang"), I.sources(spark)).candidates.select(
        day(), "seq", "id", "publisher", "category", "source_reliability", "cluster_id", "cluster_size",
        "cluster_sources")


# --- scoring and eligibility (K1, P3-P9, A3) ---------------------------------------------------

@register
def base_scores(spark, sf):
    return scored(spark, sf).select(
        "seq", F.round("base_score", 6).alias("base_score"), F.round("lead_score", 6).alias("lead_score"),
        "source_risk", "kind", flag(F.col("live")).alias("live"), flag(F.col("important")).alias("important"),
        flag(F.col("complete")).alias("complete"), flag(F.col("eligible")).alias("eligible"))


@register
def best_of_clusters(spark, sf):
    return S.dedup_by_cluster(scored(spark, sf)).select(day(), "cluster_id", "seq")


@register
def lead_picks(spark, sf):
    s = scored(spark, sf).filter("eligible").withColumns({
        "fp": F.array().cast("array<string>"),
        "mm": F.struct(F.lit("").alias("country"), F.lit("").alias("event_family"), F.lit("").alias("tone")),
        "sid": F.lit(0)})
    return E.pick_lead(s).select(day(), F.col("lead.story.id").alias("id"), F.col("lead.story.seq").alias("seq"))


@register
def pool_exclusions(spark, sf):
    b = PO.build_pool(I.candidates(spark, sf))
    return b.select("seq", F.coalesce("exclusion_reason", F.lit("kept")).alias("reason"))


# --- classification (C1-C7) --------------------------------------------------------------------

@register
def topic_fingerprints(spark, sf):
    c = I.candidates(spark, sf)
    return c.select("seq", joined(C.topic_fingerprint("title", "snippet")).alias("fingerprint"),
                    joined(C.topics("category", "title", "snippet")).alias("topics"))


@register
def story_metadata(spark, sf):
    return C.with_story_metadata(spread(I.candidates(spark, sf)), reliability="source_reliability",
                                 published_at="published_at", now="now").select(
        "seq", "mm.country", "mm.region", "mm.event_family", "mm.tone",
        flag(F.col("mm.consumer_launch")).alias("launch"), flag(F.col("mm.discovery_value")).alias("discovery"))


@register
def story_identities(spark, sf):
    s = F.col("sid")
    return classed(spark, sf).select(
        "seq", s["brand"].alias("brand"), s["product_family"].alias("family"),
        joined(F.array_sort(s["covered_families"])).alias("covers"), s["event"].alias("event"),
        flag(s["is_roundup"]).alias("roundup"), flag(s["is_product_story"]).alias("product"))


@register
def region_memberships(spark, sf):
    c = I.candidates(spark, sf).withColumn("m", F.explode(C.classify_regions(
        "title", "snippet", None, "structured_regions")))
    return c.select("seq", F.col("m.id").alias("region"), F.col("m.strength").alias("strength"),
                    joined("m.evidence").alias("evidence"))


@register
def image_topics(spark, sf):
    return IM.match_topic(I.candidates(spark, sf), TOPIC_KEYWORDS, "title", "snippet").select(
        "seq", "topic", "topic_score")


# --- duplicates (J2-J4, V19) -------------------------------------------------------------------

@register
def duplicate_signatures(spark, sf):
    s = DU.signatures(classed(spark, sf))
    return DU.duplicate_pairs(s).select(day(), "src", "dst", "rule")


@register
def first_duplicates(spark, sf):
    s = DU.signatures(classed(spark, sf))
    return DU.first_duplicate_pair(s).select(day(), "src", "dst")


# --- history (W2, W3, J5, J6, J11, V6) ---------------------------------------------------------

@register
def recent_edition_dates(spark, sf):
    return H.recent_editions(I.candidates(spark, sf), editions(spark, sf), 7).select(
        day(), F.col("prior_date").cast("string").alias("prior_date"), "edition_rank")


@register
def history_runs(spark, sf):
    return H.history_pairs(I.candidates(spark, sf), editions(spark, sf)).select(
        day(), "country", "event_family", F.col("run").cast("long"), joined("run_dates").alias("dates"))


@register
def recent_repeats(spark, sf):
    r = H.recent_repeats(classed(spark, sf), editions(spark, sf))
    return r.select("seq", F.coalesce("repeat_rule", F.lit("")).alias("rule"),
                    F.coalesce(F.col("prior_date").cast("string"), F.lit("")).alias("prior_date"))


@register
def image_cooldowns(spark, sf):
    return H.image_cooldown(I.candidates(spark, sf), editions(spark, sf), 4).select(day(), "imageURL")


@register
def image_reuse(spark, sf):
    return H.image_reuse(editions(spark, sf)).select("key", "field", "message")


# --- edition (Q2, K5, K12, A6, V17, V18, J7, J8, K11) ------------------------------------------

@register
def edition_picks(spark, sf):
    e = J.edition_job(I.candidates(spark, sf), editions(spark, sf))
    return e.picks.select(day(), "rank", "tag", "id", "seq", "category", F.round("base_score", 6).alias("base"),
                          F.round("static_delta", 6).alias("delta"))


@register
def edition_gates(spark, sf):
    e = J.edition_job(I.candidates(spark, sf), editions(spark, sf))
    return E.gate_reasons(e.gates).select(day(), "total", "urls", "complete", "distinct_stories", "gate", "reason")


@register
def edition_audit(spark, sf):
    e = J.edition_job(I.candidates(spark, sf), editions(spark, sf))
    return E.audit(e).select(day(), "seq", "id", F.round("adjusted", 6).alias("adjusted"),
                             joined("notes", "; ").alias("notes"), "verdict")


@register
def diversity_report(spark, sf):
    told = C.with_story_metadata(editions(spark, sf), "headline", "summary")
    return E.mix_report(told).select(day(), "categories", "regions", "per_country", "conflict", "forward",
                                     *[flag(F.col(c)).alias(c) for c in (
                                         "met_categories", "met_regions", "met_countries", "met_conflict",
                                         "met_forward")])


def _exclusions(spark, sf):
    return editions(spark, sf).select(F.date_add(DATE, 1).alias(DATE), urls.stable_id(
        urls.canonical_url("originalURL")).alias("id"))


@register
def excluded_candidates(spark, sf):
    return S.excluded_rows(I.candidates(spark, sf), _exclusions(spark, sf)).select(day(), "seq", "id")


@register
def kept_candidates(spark, sf):
    return S.exclude_ids(I.candidates(spark, sf), _exclusions(spark, sf)).groupBy(DATE).agg(
        F.count("*").alias("kept")).select(day(), "kept")


@register
def manual_selection(spark, sf):
    """Days of eight candidates each; the first five of a day are chosen."""
    days = sliced(I.candidates(spark, sf), 8)
    sel = days.filter("number <= 5").select(DATE, "number", F.when(F.col("seq") % 9 == 4, F.lit("unseen")).otherwise(
        F.col("id")).alias("id"))
    return E.check_selection(sel, days.drop("number")).select("key", "rule", "field", "message")


@register
def review_board(spark, sf):
    return E.review_board(I.candidates(spark, sf)).select(day(), "section", "k2", "k3", "seq", "cluster_size")


# --- pools and mixes (P13, A9, K10, V10, V16, A10, Q4, Q6, K6-K9, A7, A8, A14) -----------------

@register
def frozen_pool(spark, sf):
    return PO.freeze_pool(pool(spark, sf)).select(day(), "id", F.md5(PO.pool_json()).alias("digest"), "url",
                                                  "identity", F.round("base_score", 6).alias("score"))


@register
def pool_identities(spark, sf):
    return PO.pool_identity(PO.freeze_pool(pool(spark, sf))).select(day(), "rows", "bytes", "pool_identity")


@register
def pool_violations(spark, sf):
    return PO.validate_pool(PO.freeze_pool(PO.build_pool(I.candidates(spark, sf)))).select(
        "key", "rule", "field", "message")


@register
def pool_error_categories(spark, sf):
    v = PO.validate_pool(PO.freeze_pool(PO.build_pool(I.candidates(spark, sf)))).withColumn(
        "message", F.concat("field", F.lit(" "), "message"))
    return error_categories(v, V.POOL_ERROR_CATEGORIES, keys=["key"])


@register
def enrichment_choice(spark, sf):
    return PO.select_for_enrichment(pool(spark, sf)).select(day(), "id", "position")


@register
def pool_admission(spark, sf):
    w = F.col("user_id")
    e = I.read(spark, sf, "events").select(
        "event_id", F.lit("2026-07-20").cast("date").alias(DATE),
        F.date_add(F.lit("2026-07-20").cast("date"), F.when(w % 10 == 0, 1).otherwise(0)).alias("requested_date"),
        (w % 25).alias("candidate_count"), F.col("ts").alias("generated_at"), F.lit(1).alias("schema_version"),
        F.when(w % 13 == 0, 2).otherwise(1).alias("selector_version"), (w % 11 == 0).cast("int").alias("errors"),
        F.lit("a").alias("stored_identity"), F.when(w % 17 == 0, F.lit("b")).otherwise(F.lit("a")).alias("derived_identity"))
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return PO.admit_pools(e, now).select("event_id", F.coalesce("refusal", F.lit("admitted")).alias("refusal"))


@register
def mix_eligibility(spark, sf):
    p = pool(spark, sf).withColumn("source", F.when(F.col("seq") % 19 == 0, F.lit("")).otherwise(F.col("source")))
    return p.select("seq", F.coalesce(X.mix_ineligible(), F.lit("eligible")).alias("reason"),
                    flag(M.topic_allowed("category", F.array(F.lit("tech"), F.lit("business")))).alias("tech_business"),
                    flag(C.primary_in("memberships", F.array(F.lit("japan"), F.lit("world")))).alias("japan_world"))


def _mix(spark, sf):
    p = pool(spark, sf)
    top = PO.select_for_enrichment(p)
    return J.mix_job(written(p.join(top, [DATE, "id"], "left_semi"), "pool"), requests(spark, sf))


@register
def mix_picks(spark, sf):
    return _mix(spark, sf).picks.select(day(), "mix_id", "rank", "id", "phase", "assigned_region",
                                        F.round("final_score", 6).alias("score"))


@register
def pool_mix_picks(spark, sf):
    """Mixes of whole pools, not only of the enriched stories."""
    m = J.mix_job(pool(spark, sf), requests(spark, sf))
    return m.picks.select(day(), "mix_id", "rank", "id", "phase", "assigned_region",
                          F.round("final_score", 6).alias("score"))


@register
def pool_mix_counts(spark, sf):
    """Distinct stories per mix over whole pools."""
    counts = X.dedup_count(written(X.prepare(pool(spark, sf)), "selector"),
                           written(X.normalize_requests(requests(spark, sf)), "mixes"))
    return counts.select(day(), "mix_id", "qualifying", "distinct_stories")


@register
def mix_summaries(spark, sf):
    s = _mix(spark, sf).summary
    return s.select(day(), "mix_id", "pool_total", "qualifying", "distinct_stories", "regional_stories",
                    "fallback_slots", "fallback_reason", "unfilled", joined("selected_ids", ",").alias("ids"))


@register
def mix_logs(spark, sf):
    return _mix(spark, sf).audit.select(day(), "mix_id", "id", F.round("final_score", 6).alias("score"),
                                        "phase", "rejection_reason")


@register
def mix_reports(spark, sf):
    p = pool(spark, sf)
    m = _mix(spark, sf)
    r = PO.pool_report(PO.pool_identity(PO.freeze_pool(p)), m.summary, m.picks, m.audit)
    return r.select(day(), "mix_id", "pool_identity", F.size("selection_phases").alias("selected"),
                    joined("rejected_duplicates", ",").alias("rejected_duplicates"))


# --- drafts and editions (S8, C8, C9, K13, V2, V7-V9, A11, J12, K14, Q3, Q5, Q7, Q8) -----------

def _articles(spark, sf):
    return I.candidates(spark, sf).groupBy("id").agg(F.min_by("body", "seq").alias("text"))


@register
def source_texts(spark, sf):
    c = I.candidates(spark, sf)
    gone = c.filter(F.col("category") == "HEALTH").select("id")
    skip = c.filter(F.col("category") == "CULTURE").select("id")
    r = D.resolve_source_text(c, _articles(spark, sf), skip, gone)
    return r.select("seq", "source_text_used", F.length("source_text").alias("chars"))


@register
def drafts(spark, sf):
    c = I.candidates(spark, sf)
    d = D.draft(D.resolve_source_text(c, _articles(spark, sf)))
    return d.select("seq", "summary", joined("key_takeaways").alias("takeaways"), "why", "read_time",
                    "confidence", joined("flags", ",").alias("flags"))


@register
def draft_checks(spark, sf):
    c = I.candidates(spark, sf).withColumn("lead", F.col("seq") % 5 == 0)
    d = D.draft(D.resolve_source_text(c, _articles(spark, sf)))
    return D.validation_report(d, D.validate_drafts(d)).select(
        "key", "result", "hard", "warnings", F.size("failed_ids").alias("failed"))


@register
def prose_gate(spark, sf):
    return Q.validate_prose(editions(spark, sf))


@register
def prose_gate_later(spark, sf):
    """The same editions in the opposite order after a fixed day, so the gate covers every one of them."""
    turn = F.lit("2026-08-20").cast("date")
    later = F.date_add(turn, F.datediff(turn, F.col(DATE)))
    return Q.validate_prose(editions(spark, sf).withColumn(DATE, later))


@register
def edition_structure(spark, sf):
    e = editions(spark, sf)
    flawed = e.withColumn("importance", F.when(F.col("number") == 2, F.lit(9)).otherwise(F.col("importance"))
                          ).withColumn("json", Q.signal_json(e.columns))
    return Q.validate_structure(flawed).select("key", "rule", "field", "message")


@register
def edition_composition(spark, sf):
    return Q.validate_composition(editions(spark, sf)).select("key", "rule", "field", "message")


@register
def feed_schema(spark, sf):
    e = editions(spark, sf)
    s = e.withColumn("json", Q.signal_json(e.columns))
    feeds = e.select(DATE).distinct().withColumns({
        "inner_date": F.col(DATE).cast("string"), "focus": F.lit("MIXED"), "version": F.lit(1)})
    return Q.validate_feed_schema(s, feeds).select("key", "rule", "field", "message")


@register
def listen_readiness(spark, sf):
    e = editions(spark, sf)
    s = e.select(DATE, F.concat(
        F.lit('{"number":'), "number", F.lit(',"listen":{"en":{"audioURL":"https://cdn.example.com/audio/'),
        F.when(F.col("number") == F.dayofmonth(DATE) % 7, F.lit("2026-01-01")).otherwise(F.col(DATE).cast("string")),
        F.lit('/clip.mp3"}}}')).alias("json"))
    return Q.validate_listen_ready(s).select("key", "rule", "field", "message")


@register
def served_edition(spark, sf):
    e = editions(spark, sf)
    s = e.select(DATE, "number", F.concat(
        F.lit('{"number":'), "number", F.lit(',"listen":{"en":{"audioURL":"https://cdn.example.com/audio/'),
        F.when(F.col("number") == F.dayofmonth(DATE) % 7, F.lit("2026-01-01")).otherwise(F.col(DATE).cast("string")),
        F.lit('/clip.mp3"}}}')).alias("json"))
    return Q.latest_edition(s).select(day(), "number")


@register
def request_codes(spark, sf):
    e = I.read(spark, sf, "events")
    u = F.col("user_id")
    doc = F.concat(F.lit('{"date":"2026-07-'), F.lpad((u % 40).cast("string"), 2, "0"),
                   F.lit('","active":{"mode":"custom","regions":['),
                   F.when(u % 7 == 0, F.lit('"mars"')).when(u % 7 == 1, F.lit("")).otherwise(F.lit('"japan"')),
                   F.lit('],"topics":['), F.when(u % 11 == 0, F.lit('"ai","ai"')).otherwise(F.lit('"ai"')),
                   F.lit(']},"pending":null,"selectorVersion":'), F.when(u % 13 == 0, F.lit("2")).otherwise(F.lit("3")),
                   F.lit(',"storyCount":5}'))
    return e.select("event_id", F.coalesce(Q.request_code(doc), F.lit("ok")).alias("code"))


@register
def translation_checks(spark, sf):
    d = I.read(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("key"), F.element_at(F.split("text", r"\n"), 1).alias("headline"),
        F.col("text").alias("summary"), F.when(F.col("doc_id") % 6 == 0, F.lit(" ")).otherwise(
            F.col("lang")).alias("whyItMatters"),
        F.when(F.col("doc_id") % 10 != 0, F.split("text", r"\n")).alias("keyTakeaways"))
    return Q.validate_translation(d).select("key", "rule", "field")


def image_pools(spark, sf) -> IM.ImagePools:
    """Image configuration read off the page table: a bounded choice of its hosts."""
    p = I.read(spark, sf, "pages").select(
        F.concat(F.lit("https://img.example.com/"), F.sha1("url")).alias("imageURL"),
        (F.col("page_id") % 20).alias("slot")).groupBy("slot").agg(
            F.array_sort(F.collect_set("imageURL"))[0].alias("first"), F.max("imageURL").alias("second"))
    rows = p.select("slot", F.posexplode(F.array("first", "second")).alias("pos", "imageURL"))
    names_ = ["WORLD", "TECH", "SCIENCE", "HEALTH", "CULTURE", "BUSINESS"]
    topics = sorted(TOPIC_KEYWORDS)
    key = F.when(F.col("slot") < len(names_), F.get(F.array(*[F.lit(n) for n in names_]), F.col("slot").cast("int"))
                 ).when(F.col("slot") < len(names_) + len(topics), F.get(F.array(*[F.lit(t) for t in topics]), (
                     F.col("slot") - len(names_)).cast("int"))).otherwise(F.lit(""))
    kind = F.when(F.col("slot") < len(names_), F.lit("category")).when(
        F.col("slot") < len(names_) + len(topics), F.lit("topic")).otherwise(F.lit("default"))
    df = rows.select(kind.alias("pool_kind"), key.alias("pool_key"), (F.col("slot") * 2 + F.col("pos")).alias("pos"),
                     "imageURL", F.lit("Morning light").alias("placeTime"))
    return IM.ImagePools(df, TOPIC_KEYWORDS, {"ECONOMY": "BUSINESS", "OTHER": "WORLD"})


TOPIC_KEYWORDS = {
    "conflict": ["ceasefire", "missile", "strikes", "nuclear"],
    "economy": ["inflation", "tariff", "interest rates", "markets"],
    "technology": ["phone", "iphone", "app", "cloud"],
    "science": ["fossil", "orbit", "vaccine"],
    "culture": ["museum", "festival", "novel", "film"],
}


@register
def edition_images(spark, sf):
    e = editions(spark, sf)
    return IM.assign_images(e.select(DATE, "number", "lead", "category", "headline", "summary"),
                            image_pools(spark, sf), H.recent_images(e, e, window=2)).select(
        day(), "number", "imageURL", "topic", "tier")


@register
def built_editions(spark, sf):
    e = J.edition_job(I.candidates(spark, sf), editions(spark, sf))
    b = J.build_job(written(J.draft_job(e.picks, _articles(spark, sf)), "drafts"), image_pools(spark, sf),
                    editions(spark, sf))
    return b.edition.select(day(), "number", "headline", "summary", "imageURL", "readTime")


@register
def enriched_pools(spark, sf):
    p = written(PO.freeze_pool(pool(spark, sf)), "pool")
    e = J.enrichment_job(p, _articles(spark, sf), image_pools(spark, sf), H.recent_images(p, editions(spark, sf)))
    return e.dates.select(day(), "survivors", flag(F.col("ok")).alias("ok"))


@register
def recovery_rounds(spark, sf):
    r = J.recovery_job(I.candidates(spark, sf), editions(spark, sf), _articles(spark, sf))
    return r.attempts.select(day(), "attempt", "kind", "result", joined("failed_ids", ",").alias("failed_ids"))


# --- spoken versions (J10, A12, A13, W4, V13) --------------------------------------------------

@register
def speaker_turns(spark, sf):
    c = I.read(spark, sf, "conversations")
    return DG.speaker_turns(c, "conv_id", "turn", "role").select("conv_id", "turn", "role", "turn_no", "run")


@register
def collapsed_turns(spark, sf):
    c = I.read(spark, sf, "conversations")
    return DG.collapsed_turns(c, "conv_id", "turn", "role").select("conv_id", "turn_no", "role", "first_line", "lines")


def _tracks(spark, sf):
    """One English track per conversation, for the story its number names."""
    c = I.read(spark, sf, "conversations")
    w = F.col("conv_id")
    caps = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.col("role").alias("speaker"), "text", (F.length("text") / 16.0).alias("duration")))).alias("c"))
    return caps.select(
        F.date_add(F.lit("2026-07-19").cast("date"), (w % 10).cast("int")).alias(DATE),
        (F.floor(w / 10) + 1).cast("int").alias("number"), F.lit("dialogue").alias("format"),
        F.lit("en").alias("lang"), F.lit(None).cast("string").alias("audioURL"),
        F.when(w % 9 != 0, F.concat(F.lit("audio/"), w.cast("string"), F.lit(".mp3"))).alias("key"),
        F.lit(0.0).alias("gap"), F.transform("c", lambda x: F.struct(
            x["speaker"].alias("speaker"), x["text"].alias("text"), x["duration"].alias("duration"))).alias("captions"),
        "conv_id")


@register
def track_outcomes(spark, sf):
    e = editions(spark, sf).withColumns({"listen_format": F.lit(None).cast("string"),
                                         "listen": F.lit(None).cast(DG.TRACKS)})
    r = DG.inject_tracks(e, _tracks(spark, sf), "https://cdn.example.com")
    return r.select(day(), "number", "outcome", F.element_at("listen", "en")["audioURL"].alias("audio"))


@register
def track_outcome_counts(spark, sf):
    e = editions(spark, sf).withColumns({"listen_format": F.lit(None).cast("string"),
                                         "listen": F.lit(None).cast(DG.TRACKS)})
    return DG.outcome_counts(DG.inject_tracks(e, _tracks(spark, sf), "https://cdn.example.com")).select(
        day(), "outcome", "n")


@register
def caption_drifts(spark, sf):
    t = _tracks(spark, sf).withColumn("clip_seconds", F.aggregate(
        "captions", F.lit(0.0), lambda a, c: a + c["duration"]) + (F.col("conv_id") % 5) / 4.0)
    return DG.caption_drift(t).select("conv_id", F.round("spoken", 4).alias("spoken"),
                                      F.round("drift", 4).alias("drift"), flag(F.col("ok")).alias("ok"))


@register
def dialogue_checks(spark, sf):
    c = I.read(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("key"), (F.col("turn") + 1).alias("line"),
        F.when(F.col("role") == "user", F.lit("listener")).otherwise(F.lit("explainer")).alias("speaker"), "text")
    stories = c.filter("line = 1").select("key", F.col("text").alias("source"), F.col("text").alias("translation"))
    return DG.validate_dialogue(c, stories).groupBy("key", "rule").agg(F.count("*").alias("n"))


# --- lookup and keyed events (J9, T1-T4) -------------------------------------------------------

@register
def edition_lookup(spark, sf):
    e = I.read(spark, sf, "events").withColumn("timezone", F.when(
        F.col("user_id") % 3 == 0, F.lit("Asia/Tokyo")).when(F.col("user_id") % 3 == 1, F.lit("America/New_York"))
        .otherwise(F.lit("UTC")))
    served = e.select(F.to_date("ts").alias(DATE)).filter(F.dayofmonth(DATE) <= 20).distinct()
    return L.resolve_edition(e, served).select(
        "event_id", F.col("local_date").cast("string").alias("local_date"),
        F.col("served_date").cast("string").alias("served_date"), flag(F.col("is_exact")).alias("is_exact"))


@register
def quota_decisions(spark, sf):
    e = I.read(spark, sf, "events")
    return K.quota(e, "user_id", "ts", "event_id", 3, 86400).select(
        "event_id", flag(F.col("allowed")).alias("allowed"), "retry_after")


@register
def claim_outcomes(spark, sf):
    e = I.read(spark, sf, "events")
    return K.first_claim(e, "user_id", "event_type", "ts", "event_id", 24 * 7).select("event_id", "outcome")


@register
def latest_statuses(spark, sf):
    e = I.read(spark, sf, "events")
    return K.latest_status(e, "user_id", "event_type", "ts", "event_id", "2025-01-31 00:00:00").select(
        "user_id", "status", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("updated_at"))


@register
def incremental_ingest(spark, sf):
    return K.stream_ingest(I.raw_items(spark, sf).filter("link <> ''")).select("seq", "canonical_url")
