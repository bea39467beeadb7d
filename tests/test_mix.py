import datetime as dt
import hashlib
import itertools
import random

from pyspark.sql import functions as F

from storyspark.operators import mix as X, pool as P

POOL = ("edition_date date, id string, headline string, summary string, source string, url string, published_at timestamp, "
        "category string, topics array<string>, memberships array<struct<id:string,strength:string,evidence:array<string>>>, "
        "base_score double, source_reliability string, identity string, eligible boolean")
DAY = dt.date(2026, 7, 27)
TITLES = ["Samsung unveils Galaxy phone", "Galaxy Unpacked: biggest announcements", "Apple launches iPhone", "A plain story",
          "Another plain story", "Pixel phone from Google"]
FAMILY = {"BBC News (World)": "bbc", "The Guardian (Science)": "guardian", "NPR": "npr", "CBS News (U.S.)": "cbs",
          "Financial Times": "ft", "Local": "local"}
TOPICS = {"TECH": ["tech"], "SCIENCE": ["science"], "AI": ["ai", "tech"], "WORLD": []}
UK = {"bbc", "guardian", "ft"}
ORDER = ["united_states", "japan", "world"]


def rows(seed, n):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        cat = rng.choice(list(TOPICS))
        out.append((DAY, f"s{k:02d}", rng.choice(TITLES), "", rng.choice(list(FAMILY)), f"https://e.com/{rng.randrange(3 * n)}",
                    dt.datetime(2026, 7, 27, 3) - dt.timedelta(hours=rng.choice([1, 5, 80])), cat,
                    sorted(set(TOPICS[cat]) | set(rng.sample(["ai", "tech", "health"], rng.randint(0, 2)))),
                    [(r, rng.choice(["primary", "primary", "none"]), ["x"]) for r in ("japan", "united_states", "world")],
                    float(rng.randint(0, 9)), rng.choice(["high", "high", "low"]), f"i{rng.randrange(2 * n)}", True))
    return out


def one_at_a_time(pool, regions, topics, size=5):
    """One story at a time, rejected stories used up; returns picked ids and the log of everyone."""
    def same(a, b):
        sa, sb = a.sid, b.sid
        if not sa or not sb or sa.brand != sb.brand or not (sa.is_product_story and sb.is_product_story):
            return False
        fa, fb = sa.product_family, sb.product_family
        if (sa.event and sa.event == sb.event) or (fa and fb and (fa == fb or fa.startswith(fb + " ") or fb.startswith(fa + " "))):
            return True
        if fa and fb:
            return False
        return sa.is_roundup or sb.is_roundup or (not fa and not fb)

    log, chosen = {}, []
    order = [r for r in ORDER if r in regions]
    ok = []
    for c in pool:
        why = c.barred or ("topic not selected (strict allowlist)" if topics and not set(TOPICS[c.category]) <= set(topics) else None)
        bonus = 10.0 * len(set(c.topics) & set(topics))
        log[c.id] = dict(final=None, phase=None, why=why, bonus=bonus)
        if why is None:
            ok.append(c)
    region_pool = [c for c in ok if set(c.primary) & set(regions)]

    def rank(c, use):
        bonus = 10.0 * len(set(c.topics) & set(use))
        div = 0.0 + (0.6 if c.cat not in {s.cat for s in chosen} else 0.0) + (0.4 if c.family not in {s.family for s in chosen} else 0.0)
        return c.base + bonus + div

    def fill(cands, count, use, phase, relax=False):
        left, got = list(cands), 0
        while left and got < count:
            best = min(left, key=lambda c: (-rank(c, use), c.id))
            left.remove(best)
            final, why = rank(best, use), None
            for s in chosen:
                if best.identity == s.identity:
                    why = f"duplicate underlyingStoryIdentity={best.identity}"
                elif best.url == s.url:
                    why = "duplicate canonical URL"
                elif same(best, s):
                    why = "existing duplicate guard"
                if why:
                    break
            if not why and "united_states" in regions and best.family in UK and any(s.family in UK for s in chosen):
                why = "UK publisher cap reached (max 1 while United States is active)"
            if not why and not relax and any(s.family == best.family for s in chosen):
                why = f"publisher family '{best.family}' already selected (max 1 per family)"
            log[best.id].update(final=final, phase=phase, why=why)
            if not why:
                chosen.append(best)
                got += 1

    fresh = lambda test: [c for c in region_pool if c not in chosen and test(c)]            # noqa: E731
    if len(order) == 1:
        fill(fresh(lambda c: order[0] in c.primary), size, topics, "regional_primary")
    else:
        slots = {}
        rest, left = list(order), size
        if order[0] == "united_states":
            slots["united_states"], rest, left = 3, order[1:], size - 3
        for k, r in enumerate(rest):
            slots[r] = left // len(rest) + (k < left % len(rest))
        for r in order:
            fill(fresh(lambda c: r in c.primary), slots[r], topics, f"regional_quota:{r}")
        for r in order:
            if len(chosen) < size:
                fill(fresh(lambda c: r in c.primary), size - len(chosen), topics, f"regional_reallocation:{r}")
    if len(chosen) < size:
        fill(fresh(lambda c: True), size - len(chosen), (), "global_fallback")
    if len(chosen) < size:
        fill(fresh(lambda c: True), size - len(chosen), (), "global_fallback_relaxed", True)
    for c in ok:
        e = log[c.id]
        if e["final"] is None:
            e["final"] = c.base + e["bonus"]
        if e["phase"] is None:
            inside = bool(set(c.primary) & set(regions))
            e["phase"] = "regional_primary" if inside else "outside_scope"
            e["why"] = ("lower deterministic rank after requested slots filled" if inside else "not primary for any selected region")
    return [c.id for c in chosen], log


def distinct_count(pool, regions, topics):
    kept = []
    for c in sorted(pool, key=lambda c: (-c.base, c.id)):
        if c.barred or (topics and not set(TOPICS[c.category]) <= set(topics)) or not set(c.primary) & set(regions):
            continue
        if not any(c.identity == s.identity or c.url == s.url or (
                c.sid and s.sid and c.sid.brand == s.sid.brand and c.sid.is_product_story and s.sid.is_product_story) for s in kept):
            kept.append(c)
    return len(kept)


def test_every_mix_matches_one_at_a_time(spark):
    pool = X.prepare(spark.createDataFrame(rows(5, 20), POOL))
    combos = [list(c) for n in (1, 2, 3) for c in itertools.combinations(["japan", "united_states", "world"], n)]
    requests = spark.createDataFrame([(DAY, r, t) for r in combos for t in ([], ["tech"], ["ai", "science", "tech"])],
                                     "edition_date date, regions array<string>, topics array<string>")
    mixes = X.normalize_requests(requests)
    state = X.select_mix(pool, mixes)
    picks = {}
    for r in X.picks(state).orderBy("mix_id", "rank").collect():
        picks.setdefault(r.mix_id, []).append(r.id)
    logs = {(r.mix_id, r.id): r for r in X.mix_audit(state, pool).collect()}
    local = pool.orderBy("id").collect()
    phases = set()
    for m in mixes.collect():
        ids, log = one_at_a_time(local, m.regions, m.topics)
        assert picks.get(m.mix_id, []) == ids, m.mix_id
        for cid, want in log.items():
            got = logs[m.mix_id, cid]
            phases.add(got.phase)
            assert got.phase == want["phase"] and got.final_score == want["final"], (m.mix_id, cid, got, want)
            why = got.rejection_reason
            assert (why or "").startswith(want["why"] or "") and bool(why) == bool(want["why"]), (m.mix_id, cid, got, want)
    assert "global_fallback_relaxed" in phases
    for r in X.mix_summary(state, pool, mixes).collect():
        assert r.unfilled == 5 - len(picks.get(r.mix_id, [])) and r.distinct_stories <= r.qualifying


def test_dedup_count(spark):
    base = rows(9, 12)
    plain = [r[:2] + ("A plain story",) + r[3:] for r in base]
    pool = X.prepare(spark.createDataFrame(plain, POOL))
    mixes = X.normalize_requests(spark.createDataFrame([(DAY, ["world", "japan"], [])],
                                                       "edition_date date, regions array<string>, topics array<string>"))
    got = X.dedup_count(pool, mixes).first()
    assert got.distinct_stories == distinct_count(pool.collect(), ["world", "japan"], [])


def brute_enrichment(cands, k=20):
    left = sorted(cands, key=lambda c: (-c[1], c[0]))
    chosen = []
    for region, floor in (("united_states", 6), ("japan", 4), ("world", 4)):
        for c in left:
            if sum(region in x[3] for x in chosen) >= floor:
                break
            if c not in chosen and region in c[3] and len(chosen) < k:
                chosen.append(c)
    for topic in ("ai", "business", "climate", "culture", "health", "science", "tech"):
        if not any(topic in x[2] for x in chosen):
            hit = next((c for c in left if c not in chosen and topic in c[2]), None)
            if hit and len(chosen) < k:
                chosen.append(hit)
    for c in left:
        if len(chosen) < k and c not in chosen:
            chosen.append(c)
    return [c[0] for c in chosen]


def test_enrichment_choice(spark):
    rng = random.Random(11)
    cands = [(f"c{k:03d}", float(rng.randint(0, 30)), rng.sample(["ai", "business", "climate", "culture", "health", "science", "tech"], rng.choice([0, 0, 1, 2])),
              rng.sample(["japan", "united_states", "world"], rng.choice([0, 0, 0, 1, 2]))) for k in range(150)]
    df = spark.createDataFrame([(DAY, c, s, t, [(r, "primary", ["e"]) for r in rs], True, (True,)) for c, s, t, rs in cands],
                               "edition_date date, id string, base_score double, topics array<string>, "
                               "memberships array<struct<id:string,strength:string,evidence:array<string>>>, eligible boolean, "
                               "quality struct<eligible:boolean>").repartition(5)
    got = [r.id for r in P.select_for_enrichment(df).orderBy("position").collect()]
    assert got == brute_enrichment(cands)


def test_pool_contract(spark):
    df = spark.createDataFrame(rows(1, 3), POOL).withColumns({
        "fp": F.array().cast("array<string>"), "quality": F.struct(
            F.lit(True).alias("eligible"), F.lit(False).alias("paywalled"), F.lit(0).alias("source_risk"),
            F.lit(1).alias("cluster_size"), F.lit(1).alias("cluster_sources")), "summary": F.lit("text")})
    assert P.validate_pool(df.withColumn("url", F.concat("url", F.lit("/"), "id"))).count() == 0
    bad = df.withColumns({"id": F.lit("x"), "base_score": F.lit(1.00000001), "category": F.lit("Nope")})
    rules = {(r.rule, r.field) for r in P.validate_pool(bad).collect()}
    assert ("unique", "id") in rules and ("numeric", "candidates[x].baseScore") in rules
    ident = P.pool_identity(df).first()
    assert len(ident.pool_identity) == 64 and ident.within_limit
    assert P.pool_identity(df.orderBy(F.desc("id")).repartition(3)).first().pool_identity == ident.pool_identity


def test_identity_of_documents_of_any_size(spark):
    rows = spark.range(4000).selectExpr("id % 3 AS k", "lpad(CAST(id AS STRING), 6, '0') AS o",
                                        "concat('{\"é\":', id, ',\"t\":\"', repeat('x', 2000), '\"}') AS json")
    got = {r.k: r for r in P.document_identity(rows.repartition(5), ["k"], "o", "json", "h").collect()}
    for k in range(3):
        whole = "[" + ",".join(r.json for r in rows.where(F.col("k") == k).orderBy("o").collect()) + "]"
        assert got[k].h == hashlib.sha256(whole.encode()).hexdigest()
        assert got[k].bytes == len(whole.encode()) > 2 << 20 and not got[k].within_limit
    assert P.document_identity(rows.limit(0), ["k"], "o", "json", "h").count() == 0


def test_mixes_of_a_pool_deeper_than_its_heads(spark, monkeypatch):
    """Open ends make mixes start again with longer heads; picks stay those of one story at a time."""
    monkeypatch.setattr(X, "HEADS", 1)
    monkeypatch.setattr(X, "DEEPER", 2)
    rng = random.Random(3)
    deep = []
    for k, r in enumerate(rows(13, 160)):
        same = r[:7] + ("TECH", ["tech"], [("japan", "primary", ["x"]), ("world", "primary", ["x"])]) + r[10:]
        r = same if k % 4 else r
        deep.append((*r[:1], f"d{k:03d}", *r[2:5], f"https://e.com/{rng.randrange(40)}", *r[6:12], f"i{rng.randrange(9)}", True))
    pool = X.prepare(spark.createDataFrame(deep, POOL))
    combos = [["japan"], ["world", "united_states"], ["japan", "united_states", "world"]]
    requests = spark.createDataFrame([(DAY, r, t) for r in combos for t in ([], ["tech"], ["ai", "science", "tech"])],
                                     "edition_date date, regions array<string>, topics array<string>")
    mixes = X.normalize_requests(requests)
    depths = []
    heads = X.class_heads
    monkeypatch.setattr(X, "class_heads", lambda p, d: depths.append(d) or heads(p, d))
    state = X.select_mix(pool, mixes)
    assert len(depths) > 2
    picks = {}
    for r in X.picks(state).orderBy("mix_id", "rank").collect():
        picks.setdefault(r.mix_id, []).append(r.id)
    local = pool.orderBy("id").collect()
    counts = {r.mix_id: r for r in X.dedup_count(pool, mixes).collect()}
    plain = [r.asDict() for r in local if r.barred is None]
    for m in mixes.collect():
        assert picks.get(m.mix_id, []) == one_at_a_time(local, m.regions, m.topics)[0], m.mix_id
        usable = [c for c in plain if (not m.topics or set(TOPICS[c["category"]]) <= set(m.topics)) and set(c["primary"]) & set(m.regions)]
        assert counts[m.mix_id].qualifying == len(usable)
    assert state.count() == mixes.count() == len(counts)


def test_distinct_counts_of_every_mix(spark):
    base = [r[:2] + ("A plain story",) + r[3:5] + (f"https://e.com/{k % 25}",) + r[6:12] + (f"i{k % 17}" if k % 3 else "", True)
            for k, r in enumerate(rows(21, 80))]
    pool = X.prepare(spark.createDataFrame(base, POOL))
    requests = [(DAY, r, t) for r in (["world"], ["japan", "world"], ["united_states"]) for t in ([], ["tech"], ["ai", "tech"])]
    mixes = X.normalize_requests(spark.createDataFrame(requests, "edition_date date, regions array<string>, topics array<string>"))
    local = [c for c in pool.collect()]
    got = {r.mix_id: r.distinct_stories for r in X.dedup_count(pool, mixes).collect()}

    def greedy(regions, topics):
        kept = []
        for c in sorted(local, key=lambda c: (-c.base, c.id)):
            if c.barred or (topics and not set(TOPICS[c.category]) <= set(topics)) or not set(c.primary) & set(regions):
                continue
            if not any((c.identity and c.identity == s.identity) or c.url == s.url for s in kept):
                kept.append(c)
        return len(kept)

    for m in mixes.collect():
        assert got[m.mix_id] == greedy(m.regions, m.topics), m.mix_id


def test_index_of_a_large_pool_stays_small(spark):
    """A class with most rows of a pool, and one identity under 20,000 URLs, give a few rows."""
    one = spark.createDataFrame(rows(1, 1), POOL).drop("id", "url", "identity", "headline", "published_at", "source_reliability")
    many = one.crossJoin(spark.range(20_000).select(
        F.format_string("s%06d", "id").alias("id"), F.format_string("https://e.com/%d", "id").alias("url"), F.lit("i").alias("identity"),
        F.lit("A plain story").alias("headline"), F.lit("2026-07-27 03:00:00").cast("timestamp").alias("published_at"),
        F.lit("high").alias("source_reliability"))).withColumn("memberships", F.expr(
            "array(named_struct('id', 'japan', 'strength', 'primary', 'evidence', array('x')))"))
    pool = X.prepare(many)
    assert X.class_heads(pool, 2).count() == 3
    mixes = X.normalize_requests(spark.createDataFrame([(DAY, ["japan"], [])], "edition_date date, regions array<string>, topics array<string>"))
    got = X.dedup_count(pool, mixes).first()
    assert (got.qualifying, got.distinct_stories) == (20_000, 1)


def test_mixes_of_an_empty_pool(spark):
    pool = X.prepare(spark.createDataFrame([], POOL))
    mixes = X.normalize_requests(spark.createDataFrame([(DAY, ["japan"], [])], "edition_date date, regions array<string>, topics array<string>"))
    assert X.picks(X.select_mix(pool, mixes)).count() == 0
    got = X.mix_summary(X.select_mix(pool, mixes), pool, mixes).first()
    assert (got.qualifying, got.distinct_stories, got.unfilled) == (0, 0, 5)
