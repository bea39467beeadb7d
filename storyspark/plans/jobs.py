"""Composite jobs (Q1-Q8): the operators put together, for all dates at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import mixes as M
from ..operators import (dialogue, draft as D, edition as E, history as H, images as I, ingest as G,
                         lookup as L, mix as X, pool as P, quality as Q, scoring as S, similarity)
from ..operators.violations import union
from ..session import written
from ..sources import tables

DATE = "edition_date"


@dataclass
class Ingest:
    candidates: DataFrame
    reasons: DataFrame


def ingest_job(items: DataFrame, sources: DataFrame, max_age_hours: int = 36) -> Ingest:
    """Feed items to clustered candidates (Q1)."""
    checked = written(G.ingest_filter(items, max_age_hours), "items")
    kept = G.to_candidates(checked.filter(F.col("skip_reason").isNull()), sources)
    return Ingest(G.cluster_stats(similarity.cluster_titles(written(kept, "kept"))),
                  G.reason_counts(checked, "skip_reason"))


def edition_job(cands: DataFrame, editions: DataFrame, excluded: DataFrame | None = None,
                min_candidates: int = 20) -> E.Edition:
    """Candidates and history to the five of every date (Q2)."""
    left = cands if excluded is None else S.exclude_ids(cands, excluded)
    return E.select_edition(left, editions, min_candidates)


def draft_job(picks: DataFrame, articles: DataFrame, bypass: DataFrame | None = None) -> DataFrame:
    """Drafts of selected stories (first half of Q3)."""
    columns = [c for c in (DATE, "seq", "id", "rank", "lead", "tag", "title", "source", "category",
                           "url", "snippet", "paywalled") if c in picks.columns]
    items = D.resolve_source_text(picks.select(*columns), articles, bypass)
    return D.draft(items).withColumn("number", F.col("rank").cast("int"))


@dataclass
class Build:
    edition: DataFrame
    problems: DataFrame


def build_job(drafts: DataFrame, pools: I.ImagePools, editions: DataFrame) -> Build:
    """Validated drafts to edition rows with images; dates with any problem are left out (Q3)."""
    items = drafts.select(DATE, "number", "lead", "category", F.col("title").alias("headline"), "summary")
    chosen = I.assign_images(items, pools, H.recent_images(drafts, editions))
    approved = drafts.select(DATE).distinct().withColumn("approved", F.lit(True))
    rows = written(L.assemble_edition(drafts.join(
        chosen.select(DATE, "number", "imageURL", "placeTime"), [DATE, "number"])), "edition")
    problems = written(union(Q.validate_build(drafts, approved, None), Q.validate_composition(rows)),
                       "problems")
    bad = problems.select("key").distinct()
    good = rows.join(bad, F.col(DATE).cast("string") == F.col("key"), "left_anti")
    return Build(good, problems)


@dataclass
class Pool:
    pool: DataFrame
    manifest: DataFrame
    drops: DataFrame
    exclusions: DataFrame


def pool_job(cands: DataFrame, generated_at: Column, source: str) -> Pool:
    """Candidates to a frozen, identified pool per date (Q4)."""
    prepared = G.prepare_pool_source(S.narrow(cands))
    usable = written(prepared.filter(F.col("drop_reason").isNull()).drop("drop_reason"), "source")
    built = written(P.build_pool(usable), "built")
    pool = written(P.freeze_pool(built.filter(F.col("exclusion_reason").isNull())), "pool")
    return Pool(pool, P.pool_manifest(pool, usable, generated_at, source),
                G.reason_counts(prepared, "drop_reason"), G.reason_counts(built, "exclusion_reason"))


@dataclass
class Enriched:
    pool: DataFrame          # pool columns plus the struct ``editorial``
    failures: DataFrame      # edition_date, id, reason, stage
    dates: DataFrame         # edition_date, survivors, ok


def enrichment_job(pool: DataFrame, articles: DataFrame, images: I.ImagePools,
                   recent: DataFrame) -> Enriched:
    """Top stories of a pool, drafted and illustrated; dates below the minimum fail closed (Q5)."""
    chosen = P.select_for_enrichment(pool)
    items = pool.join(chosen, [DATE, "id"]).withColumns({
        "title": F.col("headline"), "snippet": F.col("summary"), "paywalled": F.lit(False),
        "selector_summary": F.col("summary"), "selector_headline": F.col("headline")}).drop("summary")
    drafted = written(D.draft(D.resolve_source_text(items, articles)), "enriched")
    reason = (F.when(F.col("source_text_used") == "none", F.lit("article_fetch_failed"))
              .when(F.arrays_overlap("flags", F.array(*[F.lit(f) for f in V.BLOCKING_FLAGS])),
                    F.lit("invalid_writer_output"))
              .when((F.trim("summary") == "") | (F.trim("why") == "")
                    | (F.size("key_takeaways") == 0) | (F.col("read_time") < 1),
                    F.lit("invalid_writer_output")))
    marked = drafted.withColumn("reason", reason)
    told = marked.filter(F.col("reason").isNull())
    shown = I.enriched_images(I.assign_images(told.select(
        DATE, F.col("position").cast("int").alias("number"), F.lit(False).alias("lead"), "category",
        F.col("title").alias("headline"), "summary"), images, recent, lead_first=False))
    rows = written(told.join(shown.withColumnRenamed("number", "position"), [DATE, "position"]), "shown")
    survivors = rows.filter(F.col("drop_reason").isNull())
    counts = survivors.groupBy(DATE).agg(F.count("*").alias("survivors"))
    dates = (pool.select(DATE).distinct().join(counts, DATE, "left")
             .withColumn("survivors", F.coalesce("survivors", F.lit(0)))
             .withColumn("ok", F.col("survivors") >= V.ENRICH_MINIMUM))
    editorial = F.struct(
        "category", "source", F.col("title").alias("headline"), "summary",
        F.col("key_takeaways").alias("keyTakeaways"), F.col("why").alias("whyItMatters"),
        F.col("url").alias("originalURL"), F.col("read_time").alias("readTime"), "imageURL",
        F.coalesce("placeTime", F.lit("")).alias("placeTime"), F.lit("").alias("audioURL"))
    out = (survivors.withColumn("editorial", editorial)
           .withColumns({"headline": F.col("selector_headline"), "summary": F.col("selector_summary")})
           .join(dates.filter("ok").select(DATE), DATE, "left_semi")
           .select(*P.POOL_COLUMNS, "editorial"))
    failures = marked.filter(F.col("reason").isNotNull()).select(
        DATE, "id", "reason", F.lit("story").alias("stage")).unionByName(
            rows.filter(F.col("drop_reason").isNotNull()).select(
                DATE, "id", F.col("drop_reason").alias("reason"), F.lit("image").alias("stage")))
    return Enriched(out, failures, dates)


@dataclass
class Mixes:
    """Result of a mix run; summaries and logs are worked out when asked for."""
    pool: DataFrame          # selector columns of the pools
    mixes: DataFrame         # distinct valid mixes
    state: DataFrame
    requests: DataFrame      # the requests with their mix_id

    @property
    def picks(self) -> DataFrame:
        return X.picks(self.state)

    @property
    def summary(self) -> DataFrame:
        return X.mix_summary(self.state, self.pool, self.mixes)

    @property
    def audit(self) -> DataFrame:
        return X.mix_audit(self.state, self.pool)


def mix_job(pool: DataFrame, requests: DataFrame) -> Mixes:
    """Every requested mix of every date: fives, summaries and logs (Q6).

    Equal requests are computed once; the requests come back with their mix id.
    """
    mixes = written(X.normalize_requests(requests), "mixes")
    ready = written(X.prepare(pool), "selector")
    tagged = requests.withColumn("mix_id", M.mix_identity(
        DATE, M.normalize_regions("regions"), M.normalize_topics("topics")))
    return Mixes(ready, mixes, X.select_mix(ready, mixes), tagged)


@dataclass
class Recovery:
    drafts: DataFrame | None     # accepted drafts
    attempts: DataFrame          # edition_date, attempt, kind, result, failed_ids, hard, warnings, actions


def newest_texts(articles: DataFrame, versions: DataFrame, failed: DataFrame) -> DataFrame:
    """(edition_date, id, text) of the failed stories: the newest version of each, else its article.

    ``versions``: edition_date, id, version, text; only versions of a failed story of the same date count,
    and of equal versions the greatest text, so a story has one row.
    """
    fresh = (versions.join(failed, [DATE, "id"], "left_semi").filter(F.trim(F.coalesce("text", F.lit(""))) != "")
             .groupBy(DATE, "id").agg(F.max(F.struct("version", "text")).alias("v"))
             .select(DATE, "id", F.col("v.text").alias("_fresh")))
    old = articles.groupBy("id").agg(F.max("text").alias("_old"))
    return (failed.join(fresh, [DATE, "id"], "left").join(old, "id", "left")
            .select(DATE, "id", F.coalesce("_fresh", "_old").alias("text")))


def _with_texts(five: DataFrame, articles: DataFrame, versions: DataFrame, failed: DataFrame) -> DataFrame:
    """Drafts of the five: failed stories from their newest text, the others from what they had."""
    texts = written(newest_texts(articles, versions, failed), "texts")
    kept = five.join(failed, [DATE, "id"], "left_anti")
    again = five.join(failed, [DATE, "id"], "left_semi")
    # A text belongs to a date, and drafting joins texts by id: the date becomes part of the id.
    scoped = F.concat_ws("|", F.col(DATE).cast("string"), "id")
    redone = draft_job(again.withColumn("id", scoped), texts.select(scoped.alias("id"), "text")).withColumn(
        "id", F.expr("substring(id, 12)"))
    return draft_job(kept, articles).unionByName(redone)


def _audit(drafts: DataFrame, found: DataFrame, attempt: int) -> DataFrame:
    """Per date: result, failed ids, the texts of failed rules and warnings, and the five ids."""
    note = F.concat_ws(": ", "field", "message")
    lists = found.groupBy("key").agg(*[F.array_sort(F.collect_set(F.when(test, note))).alias(c) for c, test in (
        ("hard", F.col("rule") != "warn"), ("warnings", F.col("rule") == "warn"))])
    ids = drafts.groupBy(F.col(DATE).cast("string").alias("key")).agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return (D.validation_report(drafts, found).drop("hard", "warnings").join(ids, "key").join(lists, "key", "left")
            .withColumn(DATE, F.to_date("key")).drop("key"))


def _with_actions(verdict: DataFrame, attempt: int) -> DataFrame:
    """``actions`` as ``id: what happened``: replaced stories of the round before, then the five."""
    def told(ids, what):
        return F.transform(F.coalesce(ids, F.array().cast("array<string>")), lambda i: F.concat(i, F.lit(f": {what}")))

    failed = told(F.col("failed_ids"), "refetch-retry" if attempt == 1 else "rejected")
    now = F.when(F.col("result") == "pass", told(F.col("ids"), "accepted")).otherwise(failed)
    return verdict.withColumn("actions", F.concat(told(F.col("before"), "replaced"), now)).drop("ids", "before")


def recovery_job(cands: DataFrame, editions: DataFrame, articles: DataFrame,
                 refetched: DataFrame | None = None, max_replacement_rounds: int = 3,
                 min_candidates: int = 20) -> Recovery:
    """Rank, draft and validate; failing dates retry with fresh texts, then without the failed
    stories, at most five validations in all; what still fails stays unpublished (Q7).

    ``refetched``: edition_date, id, version, text.  The audit has a row per date and attempt with the
    rules that failed and warned, and what was done with every story.
    """
    last_attempt = min(2 + max_replacement_rounds, V.MAX_VALIDATIONS)
    accepted, log = None, []
    excluded, open_cands, last = None, cands, None
    for attempt in range(1, last_attempt + 1):
        kind = "initial" if attempt == 1 else "refetch" if attempt == 2 else "replacement"
        if attempt == 2:
            # Same five stories; only failed ids draft from a fresh text, if there is one.
            failed = last.select(DATE, F.explode("failed_ids").alias("id")).distinct()
            five = written(five.join(last.select(DATE), DATE, "left_semi"), "five")
            drafts = written(draft_job(five, articles) if refetched is None else
                             _with_texts(five, articles, refetched, failed), "drafts")
        else:
            five = written(edition_job(open_cands, editions, excluded, min_candidates).picks, "five")
            drafts = written(draft_job(five, articles), "drafts")
        found = written(D.validate_drafts(drafts), "found")
        verdict = written(_audit(drafts, found, attempt).join(
            last.select(DATE, F.col("failed_ids").alias("before")) if attempt > 2 else
            drafts.select(DATE, F.array().cast("array<string>").alias("before")).limit(0), DATE, "left"), "verdict")
        missing = open_cands.select(DATE).distinct().join(verdict.select(DATE), DATE, "left_anti")
        # The dates without five stories have no drafts; their audit row says so.
        log.append(_with_actions(verdict, attempt).unionByName(
            missing.withColumn("result", F.lit("no-selection")), allowMissingColumns=True).withColumns(
                {"attempt": F.lit(attempt), "kind": F.lit(kind), **{c: F.coalesce(c, F.array().cast("array<string>"))
                 for c in ("failed_ids", "hard", "warnings", "actions")}}))
        good = drafts.join(verdict.filter("result = 'fail'").select(DATE), DATE, "left_anti")
        accepted = good if accepted is None else accepted.unionByName(good)
        last = written(verdict.filter("result = 'fail'"), "failing")
        if last.isEmpty() or attempt == last_attempt:
            break
        if attempt >= 2:
            more = last.select(DATE, F.explode("failed_ids").alias("id"))
            excluded = written(more if excluded is None else excluded.unionByName(more).distinct(),
                               "excluded")
        open_cands = written(cands.join(last.select(DATE), DATE, "left_semi"), "open")
    return Recovery(accepted, union(*log))


@dataclass
class Published:
    refused: DataFrame
    problems: DataFrame
    outcomes: DataFrame
    latest: DataFrame


def publish_job(editions: DataFrame, path: str, manifest: DataFrame, base_url: str, today: Column,
                replace: bool = False) -> Published:
    """Validate editions, merge spoken tracks, write them and read the served one back (Q8).

    Dates older than the edition served before are refused like dates that exist.
    """
    typed = editions.withColumn("json", Q.signal_json(editions.columns)).withColumn(
        "inner_date", F.col(DATE).cast("string"))
    problems = written(union(Q.validate_structure(typed), Q.validate_prose(typed),
                             Q.validate_dates(typed, today)), "problems")
    bad = problems.select("key").distinct()
    good = typed.join(bad, F.col(DATE).cast("string") == F.col("key"), "left_anti")
    if "listen" not in good.columns:
        good = good.withColumns({"listen_format": F.lit(None).cast("string"),
                                 "listen": F.lit(None).cast(dialogue.TRACKS)})
    merged = dialogue.inject_tracks(good, manifest, base_url)
    listen = F.when(F.col("listen").isNotNull(), F.concat(
        F.lit('{"format":'), F.to_json(F.array("listen_format")).substr(F.lit(2), F.length(
            F.to_json(F.array("listen_format"))) - 2), F.lit(","),
        F.substr(F.to_json("listen"), F.lit(2))))
    # The block is put into the JSON text as it is served.
    served = F.when(listen.isNull(), F.col("json")).otherwise(F.concat(
        F.substr("json", F.lit(1), F.length("json") - 1), F.lit(',"listen":'), listen, F.lit("}")))
    ready = written(merged.withColumn("json", served), "ready")
    spark = editions.sparkSession
    before = tables.published(spark, path)
    stale = ready.select(DATE).limit(0) if before is None else tables.stale_dates(ready, Q.latest_edition(before))
    stale = written(stale, "stale")
    current = ready.drop("outcome").join(stale, DATE, "left_anti")
    refused = tables.write_edition(current, path, replace).unionByName(stale)
    back = spark.read.parquet(path)
    return Published(refused, problems, dialogue.outcome_counts(ready), Q.latest_edition(back))
