"""Morning edition: one lead and four supporting stories per date.

The greedy pick runs as a short chain of rounds.  A round joins the pool with one state row per
date, drops retellings and capped stories with array predicates, and takes the best remaining
story of every date with one aggregate that is combined before the shuffle, so a date holding a
large share of the pool is never gathered anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import classify as C, urls
from ..functions.rules import in_list
from ..session import written
from . import history as H, scoring as S
from .violations import rule, violations

DATE = "edition_date"
GATES = ["too-few-candidates", "too-few-urls", "too-few-complete", "too-few-after-repeats",
         "no-lead", "too-few-supporting", "not-five-distinct"]


@dataclass
class Edition:
    """Result tables of a selection run."""
    picks: DataFrame       # edition_date, rank, lead, tag and the candidate's columns
    gates: DataFrame       # edition_date, gate (NULL = ok), reason, counts
    pool: DataFrame        # the distinct eligible pool the picks come from
    repeats: DataFrame     # candidates the repeat guard rejected


def _category() -> Column:
    return F.upper(F.coalesce("category", F.lit("OTHER")))


def _story(tag: Column) -> Column:
    return F.struct("id", "seq", F.coalesce("canonical_url", "url").alias("url"),
                    _category().alias("category"), F.col("mm.country").alias("country"),
                    F.col("mm.event_family").alias("event_family"), F.col("mm.tone").alias("tone"),
                    "fp", "sid", tag.alias("tag"))


def _retells(s: Column) -> Column:
    return C.fingerprint_overlap(F.col("fp"), s["fp"]) | C.is_same_story(F.col("sid"), s["sid"])


def pick_lead(pool: DataFrame) -> DataFrame:
    """Best lead score of a serious, corroborated or reliable story per date; id on ties (K2)."""
    fit = pool.filter((F.col("cat_weight") > 0)
                      & ((F.col("cluster_size") >= 2) | F.col("reliable")))
    return fit.groupBy(DATE).agg(F.min_by(
        F.struct(_story(F.lit("lead")).alias("story"), F.col("cluster_id").alias("cluster_id")),
        F.struct((-F.col("lead_score")).alias("k"), F.col("id").alias("i"),
                 F.col("seq").alias("s"))).alias("lead"))


def _offers(size: int, discovery: bool) -> tuple[dict, dict, Column, Column]:
    """Columns of one greedy step, in the order they are added, and the offer built from them."""
    chosen = F.col("chosen")
    n = F.size(F.filter(chosen, lambda s: s["category"] == F.col("_cat")))
    retold = F.filter(chosen, _retells)
    override = ((F.col("cluster_size") >= V.DOMINANT_CLUSTER_MIN) & (F.col("cluster_sources") >= 2)
                & ~F.exists("_retold", lambda s: s["category"] == "WORLD"))
    level = (F.when(F.col("_cat") == "WORLD",
                    F.when((F.col("_n") < V.WORLD_CAP) | ((F.col("_n") == V.WORLD_CAP) & override),
                           F.lit(0)))
             .when(F.col("_n") < V.CATEGORY_CAP, F.lit(0))
             .when(F.col("_n") < V.CATEGORY_CAP + 1, F.lit(1))
             .when(F.col("_n") < V.CATEGORY_CAP + 2, F.lit(2)))
    open_slot = ((F.size(chosen) < size) & (F.col("seq") != F.col("lead_seq"))
                 & (F.col("id") != F.col("lead_id"))
                 & ~F.col("cluster_id").eqNullSafe(F.col("lead_cluster"))
                 & ~F.exists(chosen, lambda s: s["seq"] == F.col("seq"))
                 & (F.size("_retold") == 0))
    delta, _ = S.mix_dynamic(chosen)
    if discovery:
        fit = ((F.col("mm.consumer_launch") | F.col("mm.discovery_value"))
               & (F.col("base_score") >= V.DISCOVERY_MIN_BASE) & (F.col("_level") == 0))
        step, tag = F.when(fit, F.lit(0)), F.lit("discovery-slot")
    else:
        spare = ~F.exists(chosen, lambda s: (s["id"] == F.col("id"))
                          | (s["url"] == F.coalesce("canonical_url", "url")))
        step = F.when(F.col("_level").isNotNull(), F.greatest("_level", "relax")).when(
            spare, F.lit(9))
        third = (F.col("_cat") == "WORLD") & (F.col("_n") == V.WORLD_CAP)
        tag = F.when(F.col("_level").isNull(), F.lit("emergency-fill")).when(
            third, F.lit("world-3rd-override")).otherwise(F.lit("rank"))
    offer = F.when(F.col("_open") & F.col("_step").isNotNull(), F.struct(
        F.col("_step").alias("step"), (-F.col("_score")).alias("k"), "id", "seq",
        _story(tag).alias("story")))
    return ({"_n": n, "_retold": retold, "_score": F.col("_static") + delta},
            {"_open": open_slot, "_level": level}, step, offer)


def _round(pool: DataFrame, state: DataFrame, columns) -> DataFrame:
    """One greedy step for every date at once."""
    first, second, step, offer = columns
    offers = (pool.join(state, DATE).withColumns(first).withColumns(second)
              .withColumn("_step", step).withColumn("_offer", offer))
    best = offers.groupBy(DATE).agg(
        F.any_value("chosen").alias("chosen"), F.any_value("relax").alias("relax"),
        F.any_value("lead_seq").alias("lead_seq"), F.any_value("lead_id").alias("lead_id"),
        F.any_value("lead_cluster").alias("lead_cluster"), F.min("_offer").alias("won"))
    return best.select(
        DATE, F.when(F.col("won").isNull(), F.col("chosen")).otherwise(
            F.concat("chosen", F.array("won.story"))).alias("chosen"),
        F.when(F.coalesce(F.col("won.step"), F.lit(9)) <= 2, F.greatest("relax", "won.step"))
         .otherwise(F.col("relax")).alias("relax"), "lead_seq", "lead_id", "lead_cluster")


def _ready(pool: DataFrame) -> DataFrame:
    return pool.withColumns({
        "_cat": _category(),
        "_static": F.col("base_score") + F.col("static_delta")})


def pick_supporting(pool: DataFrame, leads: DataFrame, need: int = 4) -> DataFrame:
    """(edition_date, chosen): the lead and up to ``need`` supporting stories, in pick order (K5).

    A discovery slot, then greedy fill under category caps that relax one step at a time, then an
    emergency fill that ignores caps but never lets a retelling in.
    """
    ready = _ready(pool)
    state = leads.select(DATE, F.array("lead.story").alias("chosen"), F.lit(0).alias("relax"),
                         F.col("lead.story.seq").alias("lead_seq"),
                         F.col("lead.story.id").alias("lead_id"),
                         F.col("lead.cluster_id").alias("lead_cluster"))
    discovery, fill = _offers(need + 1, True), _offers(need + 1, False)
    for step in range(need + 1):
        # One small row per date; written, so that the plan stays flat and its size is known.
        state = written(_round(ready, state, fill if step else discovery), "state")
    return state


def select_edition(cands: DataFrame, editions: DataFrame, min_candidates: int = 20,
                   stale_hours: float = 48, fresh_hours: float = 36) -> Edition:
    """Run gates, repeat guard, lead and supporting picks for every date (fails closed per date)."""
    scored = written(S.with_eligibility(S.score_candidates(S.narrow(cands), fresh_hours), stale_hours), "scored")
    counts = scored.groupBy(DATE).agg(
        F.count("*").alias("total"), F.count_if("real_url").alias("urls"),
        F.count_if("eligible").alias("complete"),
        (F.countDistinct(F.when(F.col("eligible") & ~F.col("live"), F.col("cluster_id")))
         # A story without a cluster is one of its own.
         + F.count_if(F.col("eligible") & ~F.col("live") & F.col("cluster_id").isNull()))
         .alias("calm_clusters"))
    # Live blogs join only where fewer than five other stories stand.
    eligible = scored.filter("eligible").join(counts, DATE).filter(
        ~F.col("live") | (F.col("calm_clusters") < 5)).drop(
            "total", "urls", "complete", "calm_clusters")
    best = S.with_classes(S.dedup_by_cluster(eligible))
    checked = written(S.mix_static(H.with_history(H.recent_repeats(best, editions), editions)),
                      "pool")
    repeats = checked.filter(F.col("repeat_rule").isNotNull())
    pool = checked.filter(F.col("repeat_rule").isNull())
    leads = pick_lead(pool)
    after = pool.groupBy(DATE).agg(F.count("*").alias("distinct_stories"))
    facts = (counts.join(after, DATE, "left").join(
        leads.select(DATE, F.col("lead.story.id").alias("lead_id"),
                     F.col("lead.cluster_id").alias("lead_cluster")), DATE, "left"))
    support = pool.join(leads.select(DATE, F.col("lead.story.id").alias("_l"),
                                     F.col("lead.cluster_id").alias("_c")), DATE).filter(
        ~F.col("cluster_id").eqNullSafe(F.col("_c")) & (F.col("id") != F.col("_l"))).groupBy(DATE).agg(
            F.count("*").alias("support"))
    early = facts.join(support, DATE, "left").withColumn(
        "gate", F.when(F.col("total") < min_candidates, GATES[0])
        .when(F.col("urls") < 5, GATES[1]).when(F.col("complete") < 5, GATES[2])
        .when(F.coalesce("distinct_stories", F.lit(0)) < 5, GATES[3])
        .when(F.col("lead_id").isNull(), GATES[4])
        .when(F.coalesce("support", F.lit(0)) < 4, GATES[5]))
    early = written(early, "gates")
    passed = early.filter(F.col("gate").isNull()).select(DATE)
    chosen = pick_supporting(pool, leads.join(passed, DATE))
    ids = F.array_distinct(F.transform("chosen", lambda s: s["id"]))
    links = F.array_distinct(F.transform("chosen", lambda s: s["url"]))
    whole = chosen.withColumn("_five", (F.size("chosen") == 5) & (F.size(ids) == 5)
                              & (F.size(links) == 5))
    gates = early.join(whole.select(DATE, "_five"), DATE, "left").withColumn(
        "gate", F.when(F.col("gate").isNotNull(), F.col("gate")).when(
            ~F.coalesce("_five", F.lit(False)), F.lit(GATES[6]))).drop("_five", "lead_cluster")
    five = whole.filter("_five").select(DATE, F.posexplode("chosen").alias("pos", "s")).select(
        DATE, F.col("s.seq").alias("seq"), (F.col("pos") + 1).alias("rank"),
        (F.col("pos") == 0).alias("lead"), F.col("s.tag").alias("tag"))
    picks = five.join(pool, [DATE, "seq"])
    return Edition(picks=picks, gates=gates, pool=pool, repeats=repeats)


def gate_reasons(gates: DataFrame, min_candidates: int = 20) -> DataFrame:
    """Gates with a readable reason."""
    reason = (F.when(F.col("gate") == GATES[0], F.concat(
                  F.lit("too few candidates ("), F.col("total").cast("string"),
                  F.lit(f" < {min_candidates})")))
              .when(F.col("gate") == GATES[1], F.concat(
                  F.lit("too few real article URLs ("), F.col("urls").cast("string"),
                  F.lit(" < 5)")))
              .when(F.col("gate") == GATES[2], F.concat(
                  F.lit("fewer than 5 complete-draft candidates ("),
                  F.col("complete").cast("string"), F.lit(")")))
              .when(F.col("gate") == GATES[3], F.concat(
                  F.lit("fewer than 5 distinct stories after cross-day repeat cooldown ("),
                  F.coalesce("distinct_stories", F.lit(0)).cast("string"), F.lit(")")))
              .when(F.col("gate") == GATES[4], F.lit("no lead-quality story found"))
              .when(F.col("gate") == GATES[5], F.lit("not enough eligible supporting stories"))
              .when(F.col("gate") == GATES[6], F.lit("selection is not 5 distinct stories")))
    return gates.withColumn("reason", reason)


def audit(edition: Edition, limit: int = 20) -> DataFrame:
    """Top candidates by adjusted score plus the five, each with its verdict."""
    picks = edition.picks.select(
        DATE, "rank", "lead", "tag", "seq", "id", "category", "cluster_id", "base_score",
        "static_delta", "fp", "sid", "mm")
    five = picks.groupBy(DATE).agg(
        F.array_sort(F.collect_list(F.struct(
            "rank", "id", "seq", F.upper(F.coalesce("category", F.lit("OTHER"))).alias("category"),
            F.col("mm.country").alias("country"), F.col("mm.event_family").alias("event_family"),
            F.col("mm.tone").alias("tone"), "fp", "sid", "tag", "lead",
            (F.col("base_score") + F.col("static_delta")).alias("static")))).alias("five"))
    rows = _ready(edition.pool).join(five, DATE)
    self_pick = F.get(F.filter("five", lambda s: s["seq"] == F.col("seq")), F.lit(0))
    w = Window.partitionBy(DATE).orderBy(F.col("_static").desc(), F.col("id"), F.col("seq"))
    others = (rows.join(edition.picks.filter("lead").select(
                  DATE, F.col("cluster_id").alias("_lc"), F.col("id").alias("_li")), DATE)
              .filter(~F.col("cluster_id").eqNullSafe(F.col("_lc")) & (F.col("id") != F.col("_li"))))
    top = (others.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= limit)
           .select(DATE, "seq"))
    wanted = top.unionByName(picks.select(DATE, "seq")).distinct()
    shown = rows.withColumn("_self", self_pick).join(wanted, [DATE, "seq"])
    context = F.filter("five", lambda s: s["seq"] != F.col("seq"))
    delta, notes = S.mix_dynamic(context)
    dup = F.get(F.filter("five", _retells), F.lit(0))
    dup_rule = F.when(C.fingerprint_overlap(F.col("fp"), dup["fp"]), F.lit("topic-fingerprint")
                      ).otherwise(C.same_story_rule(F.col("sid"), dup["sid"]))
    n_cat = F.size(F.filter("five", lambda s: s["category"] == F.col("_cat")))
    floor = F.array_min(F.transform("five", lambda s: s["static"]))
    own = F.col("_self")
    verdict = (F.when(own["lead"], F.lit("selected: lead"))
               .when(own.isNotNull(), F.concat(F.lit("selected: "), own["tag"]))
               .when(F.col("_dup").isNotNull(), F.concat(
                   F.lit("rejected: duplicate of selected "), F.col("_dup.id"), F.lit(" ["),
                   dup_rule, F.lit("]")))
               .when((F.col("_cat") == "WORLD") & (n_cat >= V.WORLD_CAP),
                     F.concat(F.lit("rejected: WORLD cap ("), n_cat.cast("string"),
                              F.lit(" in the five)")))
               .when(n_cat >= V.CATEGORY_CAP, F.concat(
                   F.lit("rejected: category cap ("), F.col("_cat"), F.lit(")")))
               .otherwise(F.concat(F.lit("rejected: below the selected five (floor "),
                                   F.format_number(floor, 1), F.lit(")"))))
    return (shown.withColumn("_dup", dup).withColumns({"_d": delta, "_notes": notes}).select(
        DATE, "seq", "id", F.col("_cat").alias("category"), F.col("base_score").alias("base"),
        (F.col("static_delta") + F.col("_d")).alias("mix"),
        (F.col("_static") + F.col("_d")).alias("adjusted"),
        F.concat("static_notes", "_notes").alias("notes"), verdict.alias("verdict")))


def mix_report(picks: DataFrame) -> DataFrame:
    """Five diversity targets per date (A6).  Input carries category and ``mm``."""
    per_country = picks.filter(F.col("mm.country").isNotNull()).groupBy(
        DATE, F.col("mm.country").alias("c")).agg(F.count("*").alias("n")).groupBy(DATE).agg(
            F.max("n").alias("max_per_country"))
    facts = picks.groupBy(DATE).agg(
        F.countDistinct(F.upper(F.coalesce("category", F.lit("OTHER")))).alias("categories"),
        F.countDistinct("mm.region").alias("regions"),
        F.count_if(in_list("mm.tone", V.CONFLICT_TONES)).alias("conflict"),
        F.count_if(in_list("mm.tone", ["forward_looking", "discovery"])).alias("forward"))
    return facts.join(per_country, DATE, "left").select(
        DATE, "categories", "regions", F.coalesce("max_per_country", F.lit(0)).alias("per_country"),
        "conflict", "forward", (F.col("categories") >= 3).alias("met_categories"),
        (F.col("regions") >= 3).alias("met_regions"),
        (F.coalesce("max_per_country", F.lit(0)) <= 1).alias("met_countries"),
        (F.col("conflict") <= 2).alias("met_conflict"), (F.col("forward") >= 1).alias("met_forward"))


def resolve_selection(selection: DataFrame, cands: DataFrame) -> DataFrame:
    """Chosen ids to candidate rows; an unknown id keeps its row with ``known`` false.

    ``selection``: edition_date, number (1 = lead), id.
    """
    return selection.join(cands, [DATE, "id"], "left").withColumns({
        "known": F.col("seq").isNotNull(), "lead": F.col("number") == 1})


def check_selection(selection: DataFrame, cands: DataFrame) -> DataFrame:
    """Errors and warnings of a manual selection (V18): (key, rule, field, message)."""
    rows = resolve_selection(selection, cands)
    per_row = violations(rows, F.col(DATE), [
        rule(~F.col("known"), "unknown-id", F.col("id"), "is not among the candidates"),
        rule(F.col("known") & ~urls.is_https_article("url"), "no-article-url", F.col("id"),
             "has no real https article URL"),
        rule(F.col("paywalled"), "warn-paywalled", F.col("id"), "paywalled pick")])
    facts = rows.groupBy(DATE).agg(
        F.count_if("lead").alias("leads"), F.count_if(~F.col("lead")).alias("others"),
        F.countDistinct("id").alias("ids"), F.countDistinct("category").alias("cats"))
    per_group = violations(facts, F.col(DATE), [
        rule(F.col("leads") == 0, "no-lead", "lead", "no lead id set"),
        rule(F.col("others") != 4, "supporting-count", "supporting", F.concat(
            F.lit("must list exactly 4 ids (found "), F.col("others").cast("string"), F.lit(")"))),
        rule(F.col("ids") != 5, "distinct-ids", "ids", F.concat(
            F.lit("need exactly 5 distinct ids; got "), F.col("ids").cast("string"))),
        rule(F.col("cats") <= 2, "warn-coverage", "category", "thin category coverage")])
    return per_row.unionByName(per_group)


def review_board(df: DataFrame) -> DataFrame:
    """Reading order of a date's candidates: multi-source clusters, then singles.

    Section 1 is ordered by cluster size, first title, source; section 2 by category, newest first.
    """
    heads = df.filter(F.col("cluster_size") > 1).groupBy(DATE, "cluster_id").agg(
        F.min_by("title", "seq").alias("head"))
    rows = df.join(heads, [DATE, "cluster_id"], "left")
    multi = F.col("cluster_size") > 1
    return rows.select(
        DATE, F.when(multi, 1).otherwise(2).alias("section"),
        F.when(multi, -F.col("cluster_size")).otherwise(0).alias("k1"),
        F.when(multi, F.col("head")).otherwise(F.coalesce("category", F.lit("OTHER"))).alias("k2"),
        F.when(multi, F.col("source")).otherwise(F.lit("")).alias("k3"),
        F.when(multi, F.lit(0)).otherwise(-F.coalesce(F.unix_micros("published_at"), F.lit(0)))
         .cast("long").alias("k4"),
        "seq", "id", "title", "source", "category", "cluster_id", "cluster_size"
    ).orderBy(DATE, "section", "k1", "k2", "k3", "k4", "seq")
