"""Custom five per (regions, topics) preference.

All mixes of all dates are picked together, one greedy step per round.  A pool may be of any size: a
round looks at an index of it (``class_heads``), the first rows of every class of stories that score alike
for every mix, and a mix whose pick would depend on a row behind them is done again with longer heads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import classify as C, mixes as M, names, urls
from ..functions.rules import in_list, text
from ..session import dealt, written
from .duplicates import duplicate_pairs
from .similarity import leader_rounds

DATE = "edition_date"
FALLBACK, RELAXED = 7, 8          # phases 1-3 fill quotas, 4-6 reallocate, in priority order


def mix_ineligible(edition_date="edition_date") -> Column:
    """Why a pool candidate cannot enter any mix; NULL when it can (P10)."""
    end = F.col(edition_date).cast("timestamp") + F.expr("INTERVAL 86399 SECONDS")
    age = (F.unix_micros(end) - F.unix_micros("published_at")) / 3.6e9
    return (F.when(~F.coalesce("eligible", F.lit(True)), F.lit("candidate marked ineligible"))
            .when(F.lower(text("source_reliability")) == "low", F.lit("low source reliability"))
            .when((text("id") == "") | (text("headline") == "") | (text("source") == ""),
                  F.lit("missing required field"))
            .when(~text("url").rlike("^https?://"), F.lit("invalid article URL"))
            .when(F.col("published_at").isNull(), F.lit("invalid publishedAt"))
            .when((age > 72) | (age < -24), F.lit("outside 72-hour freshness window")))


def normalize_requests(requests: DataFrame) -> DataFrame:
    """Distinct valid mixes: edition_date, mix_id, regions, topics (sorted canonical ids)."""
    norm = requests.filter((F.size(M.unsupported_regions("regions")) == 0)
                           & (F.size(M.unsupported_topics("topics")) == 0)).select(
        DATE, M.normalize_regions("regions").alias("regions"),
        M.normalize_topics("topics").alias("topics"))
    return norm.filter(F.size("regions") > 0).withColumn(
        "mix_id", M.mix_identity(DATE, "regions", "topics")).distinct()


def prepare(pool: DataFrame) -> DataFrame:
    """Selector columns of a pool: one row per candidate, dealt out before they are classified."""
    told = C.with_story_identity(C.with_story_metadata(dealt(pool), "headline", "summary"),
                                 "headline", "summary")
    return told.select(
        DATE, "id", "headline", F.lower(text("category")).alias("cat"), "category",
        names.publisher_family("source").alias("family"), text("identity").alias("identity"),
        urls.selector_url("url").alias("url"), "sid", "topics",
        C.primary_regions("memberships").alias("primary"),
        F.col("base_score").cast("double").alias("base"), mix_ineligible().alias("barred"))


def _member(phase: Column, k: Column) -> Column:
    return F.struct("id", "cat", "family", "identity", "url", "sid", phase.alias("phase"),
                    k.alias("k"))


def _is_duplicate(s: Column) -> Column:
    return (((F.col("identity") != "") & (F.col("identity") == s["identity"]))
            | ((F.col("url") != "") & (F.col("url") == s["url"]))
            | C.is_same_story(F.col("sid"), s["sid"]))


def _uk_violation(chosen: Column) -> Column:
    return (F.array_contains("regions", "united_states") & in_list("family", V.UK_FAMILIES)
            & F.exists(chosen, lambda s: in_list(s["family"], V.UK_FAMILIES)))


def _family_violation(chosen: Column) -> Column:
    return F.exists(chosen, lambda s: s["family"] == F.col("family"))


def _bonus() -> Column:
    return F.lit(V.TOPIC_BONUS) * F.size(F.array_intersect("topics_c", "topics"))


def _final(chosen: Column, bonus: Column) -> Column:
    """base + topic bonus + diversity, in that order (K7)."""
    div = (F.when(F.exists(chosen, lambda s: s["cat"] == F.col("cat")), F.lit(0.0))
           .otherwise(F.lit(V.NEW_CATEGORY_BONUS))
           + F.when(_family_violation(chosen), F.lit(0.0)).otherwise(F.lit(V.NEW_SOURCE_BONUS)))
    return F.col("base") + bonus + div


def _positions() -> Column:
    """1-based priority positions of the selected regions a candidate is primary in."""
    return F.filter(F.transform("order", lambda r: F.when(
        F.array_contains("primary", r), F.array_position("order", r).cast("int"))),
        lambda p: p.isNotNull())


def _taken(chosen: Column, phase: Column) -> Column:
    return F.size(F.filter(chosen, lambda s: s["phase"] == phase))


def _target(position: Column) -> Column:
    return F.coalesce(F.element_at("quota", F.get("order", position - 1)), F.lit(0))


def _usable() -> Column:
    return (F.col("id").isNotNull() & F.col("barred").isNull()
            & M.topic_allowed("category", "topics") & (F.size("pos") > 0))


def _columns(size: int) -> tuple[Column, Column, Column, Column]:
    """Columns of one greedy step: positions, phase, sort key and offer."""
    chosen = F.col("chosen")
    free = (_usable() & (F.size(chosen) < size)
            & ~F.exists(chosen, lambda s: s["id"] == F.col("id"))
            & ~F.exists(chosen, _is_duplicate) & ~_uk_violation(chosen))
    quota_left = F.filter("pos", lambda p: _taken(chosen, p) < _target(p))
    phase = F.when(_family_violation(chosen), F.lit(RELAXED)).otherwise(
        F.coalesce(F.array_min(quota_left), F.lit(3) + F.array_min("pos")))
    final = _final(chosen, F.when(F.col("_p") == RELAXED, F.lit(0.0)).otherwise(_bonus()))
    offer = F.when(F.col("_p").isNotNull(), F.struct(
        F.col("_p").alias("p"), F.col("_k").alias("k"), F.col("id").alias("i"),
        _member(F.col("_p"), F.col("_k")).alias("story")))
    return _positions(), F.when(free, phase).cast("int"), -final, offer


def _round(pool: DataFrame, state: DataFrame, columns) -> DataFrame:
    """One greedy step of every mix: only rows that offer something, without the mix's own columns, are
    aggregated, and their best is joined to the state."""
    positions, phase, key, offer = columns
    offers = (state.join(pool.withColumnRenamed("topics", "topics_c"), DATE)
              .withColumn("pos", positions).withColumn("_p", phase).filter(F.col("_p").isNotNull())
              .withColumn("_k", key).select(DATE, "mix_id", offer.alias("_offer")))
    best = offers.groupBy(DATE, "mix_id").agg(F.min("_offer").alias("won"))
    return state.join(best, [DATE, "mix_id"], "left").withColumn(
        "chosen", F.when(F.col("won").isNull(), F.col("chosen")).otherwise(
            F.concat("chosen", F.array("won.story")))).drop("won")


def _phase_name(p: Column) -> Column:
    one = F.size("order") == 1
    return (F.when(p == FALLBACK, F.lit("global_fallback"))
            .when(p == RELAXED, F.lit("global_fallback_relaxed"))
            .when(one, F.lit("regional_primary"))
            .when(p <= 3, F.concat(F.lit("regional_quota:"), F.get("order", p - 1)))
            .otherwise(F.concat(F.lit("regional_reallocation:"), F.get("order", p - 4))))


_MEMBER = ("struct<id:string,cat:string,family:string,identity:string,url:string,sid:struct<"
           "brand:string,product_family:string,covered_families:array<string>,event:string,"
           "event_family:string,is_roundup:boolean,is_product_story:boolean>,phase:int,k:double>")


HEADS = 2                         # rows of a class that the first attempt looks at
DEEPER = 8                        # factor of the next attempt, for the mixes that need one
_ALIKE = [DATE, "cat", "category", "family", "primary", "topics"]


def _selectable(pool: DataFrame) -> DataFrame:
    """Rows some mix may take, with the sets that decide about it in one order."""
    return pool.filter(F.col("id").isNotNull() & F.col("barred").isNull()).withColumns({
        "primary": F.array_sort(F.array_distinct("primary")),
        "topics": F.array_sort(F.array_distinct("topics"))}).filter(F.size("primary") > 0)


def _alone() -> Column:
    """The id of a row no duplicate rule can match, so that it is folded with no other; else NULL."""
    product = F.coalesce(F.col("sid.is_product_story"), F.lit(False))
    return F.when((text("identity") == "") & (text("url") == "") & ~product, F.col("id"))


def class_heads(pool: DataFrame, depth: int) -> DataFrame:
    """The first ``depth`` rows of every class and, where a class goes on, its next row as an open end.

    Rows of a class agree on category, family, primary regions and topics.  They get the same phase and
    the same bonuses in every mix at every step, so they are taken by base score and id.  Rows that also
    agree on identity, URL and story are blocked together and only the first of them can be taken.  An
    open end has the score of the first row left out, but no id and nothing a duplicate rule could match:
    it ranks at or before every row left out.  Both the fold and the limit are applied before the
    shuffle, so a class may hold any share of a pool.
    """
    place = F.struct((-F.col("base")).alias("k"), F.col("id").alias("i"))
    folded = _selectable(pool).withColumn("_own", _alone()).groupBy(
        *_ALIKE, "identity", "url", "sid", "_own").agg(F.min(place).alias("at"))
    order = Window.partitionBy(*_ALIKE).orderBy("at")
    first = folded.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= depth + 1)
    inside = F.col("rn") <= depth
    return first.select(
        *_ALIKE, *[F.when(inside, c).otherwise("").alias(n) for n, c in (
            ("id", F.col("at.i")), ("identity", F.col("identity")), ("url", F.col("url")))],
        F.when(inside, F.col("sid")).alias("sid"), (-F.col("at.k")).alias("base"),
        F.lit(None).cast("string").alias("barred"))


def select_mix(pool: DataFrame, mixes: DataFrame, size: int = V.STORY_COUNT) -> DataFrame:
    """State rows (edition_date, mix_id, regions, topics, order, quota, chosen) of every mix (K6).

    ``pool`` comes from ``prepare`` and has one row per id, ``mixes`` from ``normalize_requests``.  A mix
    is settled when no open end of ``class_heads`` was taken; others start again with longer heads, at
    the latest until no class has an open end.
    """
    none = F.array().cast(f"array<{_MEMBER}>")
    left = mixes.select(DATE, "mix_id", "regions", "topics",
                        M.priority_regions("regions").alias("order"),
                        M.quotas("regions", size).alias("quota"), none.alias("chosen")
                        ).dropDuplicates([DATE, "mix_id"])
    columns, depth, settled = _columns(size), HEADS, None
    behind = F.exists("chosen", lambda s: s["id"] == "")
    while True:
        heads, state = written(class_heads(pool, depth), "heads"), left
        for _ in range(size):
            state = written(_round(heads, state, columns), "mix")
        sure = state.filter(~behind)
        settled = sure if settled is None else settled.unionByName(sure)
        left, depth = state.filter(behind).withColumn("chosen", none), depth * DEEPER
        if left.isEmpty():
            return settled


def picks(state: DataFrame) -> DataFrame:
    """One row per picked story: edition_date, mix_id, rank, id, phase, assigned_region, score."""
    rows = state.select(DATE, "mix_id", "order", F.posexplode("chosen").alias("pos", "s"))
    p = F.col("s.phase")
    region = F.when(p >= FALLBACK, F.lit("global_fallback")).otherwise(
        F.get("order", (p - 1) % 3))
    return rows.select(DATE, "mix_id", (F.col("pos") + 1).alias("rank"), F.col("s.id").alias("id"),
                       _phase_name(p).alias("phase"), region.alias("assigned_region"),
                       (-F.col("s.k")).alias("final_score"))


def _folded(usable: DataFrame) -> DataFrame:
    """Rows of a mix view that every duplicate rule treats alike, as their first row and ``copies``.

    An identity or URL that only one row of the date has matches nothing and is left out first, so a
    group of equal identities under as many URLs becomes one row.
    """
    rows = usable
    for name in ("identity", "url"):
        shared = (usable.filter(text(name) != "").groupBy(DATE, name).count().filter("count > 1")
                  .select(DATE, name, F.lit(True).alias("_many")))
        rows = rows.join(shared, [DATE, name], "left").withColumn(
            name, F.when(F.col("_many"), F.col(name)).otherwise("")).drop("_many")
    product = F.coalesce(F.col("sid.is_product_story"), F.lit(False))
    return (rows.withColumns({"sid": F.when(product, F.col("sid")), "_own": _alone()})
            .groupBy(DATE, "category", "primary", "identity", "url", "sid", "_own")
            .agg(F.min(F.struct((-F.col("base")).alias("k"), F.col("id").alias("i"))).alias("at"),
                 F.count("*").alias("copies")).drop("_own"))


def dedup_count(pool: DataFrame, mixes: DataFrame) -> DataFrame:
    """(edition_date, mix_id, qualifying, distinct_stories): greedy distinct count by score.

    Mixes meet (category, primary regions) views of a pool and their counts, and only rows of some
    duplicate pair are looked at per mix.
    """
    view = [DATE, "category", "primary"]
    usable = _selectable(pool).withColumn("category", text("category"))
    folded = written(_folded(usable), "folded")
    sizes = folded.groupBy(*view).agg(F.sum("copies").alias("n"), F.sum(F.col("copies") - 1).alias("again"))
    seen = written(mixes.select(DATE, "mix_id", "topics", M.priority_regions("regions").alias("order"))
                   .join(sizes, DATE).withColumn("pos", _positions())
                   .filter(M.topic_allowed("category", "topics") & (F.size("pos") > 0))
                   .select(*view, "mix_id", "n", "again"), "seen")
    # A global sort numbers the rows of a date in many tasks; numbers only have to increase.
    ranked = written(folded.filter((text("identity") != "") | (text("url") != "") | F.col("sid").isNotNull())
                     .orderBy(DATE, "at").withColumn("seq", F.monotonically_increasing_id()), "ranked")
    pairs = written(duplicate_pairs(ranked, fingerprints=False, pool_rules=True), "pairs")
    nodes = pairs.select(DATE, F.explode(F.array("src", "dst")).alias("seq")).distinct()
    inside = written(ranked.select(*view, "seq").join(nodes, [DATE, "seq"], "left_semi")
                     .join(seen, view).select(DATE, "mix_id", "seq"), "inside")
    edges = (pairs.select(DATE, "src", "dst")
             .join(inside.withColumnRenamed("seq", "src"), [DATE, "src"])
             .join(inside.withColumnRenamed("seq", "dst"), [DATE, "mix_id", "dst"])
             .select(DATE, "mix_id", "src", "dst"))
    covered, _ = leader_rounds(edges, [DATE, "mix_id"])
    lost = covered.groupBy(DATE, "mix_id").agg(F.count("*").alias("lost"))
    totals = seen.groupBy(DATE, "mix_id").agg(F.sum("n").alias("n"), F.sum("again").alias("again"))
    n, again, gone = (F.coalesce(c, F.lit(0)) for c in ("n", "again", "lost"))
    return (mixes.select(DATE, "mix_id").join(totals, [DATE, "mix_id"], "left")
            .join(lost, [DATE, "mix_id"], "left")
            .select(DATE, "mix_id", n.alias("qualifying"), (n - again - gone).alias("distinct_stories")))


def mix_summary(state: DataFrame, pool: DataFrame, mixes: DataFrame,
                size: int = V.STORY_COUNT) -> DataFrame:
    """One metadata row per mix."""
    totals = pool.groupBy(DATE).agg(F.count("*").alias("pool_total"))
    counts = dedup_count(pool, mixes)
    n = F.size("chosen")
    slots = F.size(F.filter("chosen", lambda s: s["phase"] >= FALLBACK))
    region = F.transform("chosen", lambda s: F.when(
        s["phase"] >= FALLBACK, F.lit("global_fallback")).otherwise(
            F.get("order", (s["phase"] - 1) % 3)))
    tally = F.transform(F.array_sort(F.array_distinct(F.col("_r"))), lambda r: F.struct(
        r, F.size(F.filter("_r", lambda x: x == r))))
    return (state.withColumn("_r", region).join(totals, DATE, "left")
            .join(counts, [DATE, "mix_id"], "left").select(
        DATE, "mix_id", "regions", "topics", F.lit(size).alias("requested"),
        F.coalesce("pool_total", F.lit(0)).alias("pool_total"), "qualifying", "distinct_stories",
        (n - slots).alias("regional_stories"), slots.alias("fallback_slots"),
        F.when(n < size, F.lit("insufficient total eligible candidates")).when(
            slots > 0, F.lit("insufficient qualifying regional candidates"))
         .alias("fallback_reason"),
        F.lit(V.SELECTOR_VERSION).alias("selector_version"),
        F.map_from_entries(tally).alias("region_mix"), (n < size).alias("shortage"),
        (F.lit(size) - n).alias("unfilled"),
        F.transform("chosen", lambda s: s["id"]).alias("selected_ids")))


def mix_audit(state: DataFrame, pool: DataFrame, size: int = V.STORY_COUNT) -> DataFrame:
    """One log row per mix and pool candidate (the audit half of K6).

    A rejected candidate is logged at the step where the greedy order would have reached it, so
    every (candidate, step) is scored against the stories chosen before that step.
    """
    n = F.size("chosen")
    steps = F.sequence(F.lit(1), F.when(n < size, n + 1).otherwise(n))
    rows = (state.join(pool.withColumnRenamed("topics", "topics_c"), DATE)
            .withColumn("pos", _positions()).withColumn("_bonus", _bonus()))
    own = F.get(F.filter("chosen", lambda s: s["id"] == F.col("id")), F.lit(0))
    rows = rows.withColumn("_own", own)
    walk = rows.filter(_usable() & F.col("_own").isNull()).withColumn("r", F.explode(steps)).withColumns({
            "_before": F.slice("chosen", F.lit(1), F.col("r") - 1),
            "_win": F.get("chosen", F.col("r") - 1),
            "_prev": F.coalesce(F.get("chosen", F.col("r") - 2)["phase"], F.lit(0))})
    before = F.col("_before")
    until = F.coalesce(F.col("_win.phase"), F.lit(99))
    k = F.size("order")
    full = _final(before, F.col("_bonus"))
    plain = _final(before, F.lit(0.0))

    def key_of(p):
        return -F.when(p >= FALLBACK, F.col("_plain")).otherwise(F.col("_full"))

    def runs(p):
        slot = (F.when(p <= 3, (p <= k) & (_target(p) > 0))
                .when(p <= 6, (k > 1) & (p - 3 <= k)).otherwise(F.lit(True)))
        inside = (p >= FALLBACK) | F.array_contains("pos", (p - 1) % 3 + 1)
        spent = (p <= 3) & (_taken(before, p) >= _target(p))
        passed = (p >= F.greatest(F.col("_prev"), F.lit(1))) & (p < F.col("_until")) & ~spent
        beaten = (p == F.col("_until")) & (F.struct(key_of(p).alias("k"), F.col("id").alias("i"))
                                           < F.struct(F.col("_win.k").alias("k"),
                                                      F.col("_win.id").alias("i")))
        return slot & inside & (passed | F.coalesce(beaten, F.lit(False)))

    walked = (walk.withColumns({"_full": full, "_plain": plain, "_until": until})
              .withColumn("_p", F.array_max(F.filter(
                  F.array(*[F.lit(i) for i in range(1, 9)]), runs)))
              .filter(F.col("_p").isNotNull()))
    dup = F.get(F.filter(before, _is_duplicate), F.lit(0))
    rule = C.same_story_rule(F.col("sid"), F.col("_dup.sid"))
    why = (F.when(F.col("_dup").isNotNull(),
                  F.when((F.col("identity") != "") & (F.col("identity") == F.col("_dup.identity")),
                         F.concat(F.lit("duplicate underlyingStoryIdentity="), "identity"))
                  .when((F.col("url") != "") & (F.col("url") == F.col("_dup.url")),
                        F.lit("duplicate canonical URL"))
                  .otherwise(F.concat(F.lit("existing duplicate guard: "), rule, F.lit(": "),
                                      C.same_story_reason(rule, F.col("sid"), F.col("_dup.sid")))))
           .when(_uk_violation(before),
                 F.lit("UK publisher cap reached (max 1 while United States is active)"))
           .otherwise(F.concat(F.lit("publisher family '"), "family",
                               F.lit("' already selected (max 1 per family)"))))
    logs = (walked.withColumn("_dup", dup).groupBy(DATE, "mix_id", "id").agg(F.min_by(
        F.struct(F.col("_p").alias("p"), (-key_of(F.col("_p"))).alias("score"), why.alias("why")),
        F.struct((-F.col("_p")).alias("p"), F.col("r"))).alias("log")))
    out = rows.join(logs, [DATE, "mix_id", "id"], "left")
    good = _usable()
    barred = F.coalesce("barred", F.when(~M.topic_allowed("category", "topics"),
                                         F.lit("topic not selected (strict allowlist)")))
    return out.select(
        DATE, "mix_id", "id", F.col("base").alias("base_score"),
        F.col("_bonus").alias("topic_adjustment"),
        F.filter("regions", lambda r: F.array_contains("primary", r)).alias("region_eligibility"),
        F.when(F.col("_own").isNotNull(), -F.col("_own.k")).when(
            F.col("log").isNotNull(), F.col("log.score")).when(
                barred.isNull(), F.col("base") + F.col("_bonus")).alias("final_score"),
        F.when(F.col("_own").isNotNull(), _phase_name(F.col("_own.phase"))).when(
            F.col("log").isNotNull(), _phase_name(F.col("log.p"))).when(
                good, F.lit("regional_primary")).when(
                    barred.isNull(), F.lit("outside_scope")).alias("phase"),
        F.when(F.col("_own").isNotNull(), F.lit(None).cast("string")).when(
            F.col("log").isNotNull(), F.col("log.why")).when(
                good, F.lit("lower deterministic rank after requested slots filled")).when(
                    barred.isNull(), F.lit("not primary for any selected region"))
         .otherwise(barred).alias("rejection_reason"))
