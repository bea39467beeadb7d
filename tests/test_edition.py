import datetime as dt
import hashlib
import random

from pyspark.sql import functions as F

from storyspark.functions import classify as C
from storyspark.operators import edition as E, history as H, scoring as S

SCHEMA = ("edition_date date, now timestamp, seq long, id string, title string, source string, publisher string, "
          "category string, url string, canonical_url string, published_at timestamp, snippet string, paywalled boolean, "
          "source_reliability string, cluster_id long, cluster_size int, cluster_sources int")
TITLES = ["Ceasefire talks resume in Gaza after missile strikes", "Iran and United States near nuclear deal at summit",
          "Samsung unveils Galaxy Z Fold 8 phone at Unpacked", "Galaxy Unpacked: the 6 biggest announcements",
          "Astronomers discover new species of fossil in Kenya", "Vaccine trial shows promise in Nigeria",
          "Stocks slide as inflation fears return", "Election officials count ballots in Brazil",
          "Earthquake in Turkey leaves dozens dead", "Apple launches new iPhone with faster camera",
          "Museum in Osaka opens a new wing", "Hospital strike enters a third week in England",
          "Quarterly results beat forecasts at retailer", "Protest in Paris draws thousands", "City council opens a library"]


def pool_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for day in range(4):
        date = dt.date(2026, 7, 20 + day)
        now = dt.datetime(2026, 7, 20 + day, 9)
        cats = ["WORLD"] if day == 3 else ["WORLD", "TECH", "HEALTH", "CULTURE", "SCIENCE"]
        for k in range(n):
            seq = day * 1000 + k
            short = hashlib.sha1(f"https://e.com/{seq}".encode()).hexdigest()[:6]
            rows.append((date, now, seq, short, rng.choice(TITLES), "BBC News", "BBC News",
                         rng.choice(cats), f"https://e.com/{seq}", f"https://e.com/{seq}",
                         now - dt.timedelta(hours=rng.randint(1, 30)), "x" * 200, False, "high", seq,
                         rng.choice([1, 1, 2, 5]), rng.choice([1, 2, 3])))
    return rows


def overlap(a, b):
    ents = set("usa iran israel pakistan china russia ukraine gaza eu amazon anthropic openai google microsoft meta apple nvidia".split())
    if not a or not b:
        return False
    a, b = set(a), set(b)
    shared, j = a & b, len(a & b) / len(a | b)
    return len(shared & ents) >= 2 or (bool(shared & ents) and bool(shared - ents) and j >= 0.5) or j >= 0.6


def related(x, y):
    return bool(x and y) and (x == y or x.startswith(y + " ") or y.startswith(x + " "))


def same(a, b):
    if not a or not b or a.brand != b.brand or not (a.is_product_story and b.is_product_story):
        return False
    fa, fb = a.product_family, b.product_family
    if (a.event and a.event == b.event) or related(fa, fb):
        return True
    if (a.is_roundup and any(related(fb, f) for f in a.covered_families)) or (
            b.is_roundup and any(related(fa, f) for f in b.covered_families)):
        return True
    if fa and fb:
        return False
    return a.is_roundup or b.is_roundup or (not fa and not fb)


def greedy(pool, need=4):
    """The five of one date, one story at a time."""
    dup = lambda c, s: overlap(c.fp, s.fp) or same(c.sid, s.sid)            # noqa: E731
    lead = min((c for c in pool if c.cat_weight > 0), key=lambda c: (-c.lead_score, c.id))
    chosen = [lead]
    rest = [c for c in pool if c.cluster_id != lead.cluster_id and c.id != lead.id]

    def score(c):
        total = 0.0
        for s in chosen:
            if c.mm.country and s.mm.country == c.mm.country:
                if s.mm.event_family == c.mm.event_family and c.cluster_sources < 3:
                    total -= 3.0
                break
        heavy = [s for s in chosen if s.mm.tone.startswith("negative")]
        if c.mm.tone.startswith("negative") and len(heavy) >= 2:
            total -= 4.0
        return c.base_score + c.static_delta + total

    def level(c):
        n = sum(s.category == c.category for s in chosen)
        if c.category == "WORLD":
            big = c.cluster_size >= 4 and c.cluster_sources >= 2 and not any(
                s.category == "WORLD" and dup(c, s) for s in chosen)
            return 0 if n < 2 or (n == 2 and big) else None
        return max(0, n - 1) if n < 4 else None

    def options(test):
        return [c for c in rest if c not in chosen and not any(dup(c, s) for s in chosen) and test(c)]

    slot = options(lambda c: (c.mm.consumer_launch or c.mm.discovery_value) and c.base_score >= 4 and level(c) == 0)
    if slot:
        chosen.append(min(slot, key=lambda c: (-score(c), c.id)))
    relax = 0
    while len(chosen) < need + 1:
        fit = []
        while not fit and relax <= 2:
            fit = options(lambda c: level(c) is not None and level(c) <= relax)
            if not fit:
                relax += 1
        fit = fit or options(lambda c: c.id not in {s.id for s in chosen})
        if not fit:
            break
        chosen.append(min(fit, key=lambda c: (-score(c), c.id)))
    return [c.id for c in chosen]


def empty_editions(spark):
    return spark.createDataFrame([], "edition_date date, number int, headline string, summary string, "
                                     "originalURL string, imageURL string")


def test_picks_match_one_at_a_time(spark):
    df = spark.createDataFrame(pool_rows(3, 30), SCHEMA)
    out = E.select_edition(df, empty_editions(spark), min_candidates=5)
    got = {}
    for r in out.picks.orderBy("edition_date", "rank").collect():
        got.setdefault(r.edition_date, []).append(r.id)
    pool = {}
    for r in out.pool.collect():
        pool.setdefault(r.edition_date, []).append(r)
    assert len(got) == 4
    for date, rows in pool.items():
        assert got[date] == greedy(rows), date
    tags = {r.tag for r in out.picks.collect()}
    assert {"lead", "discovery-slot"} <= tags and tags & {"emergency-fill", "world-3rd-override"}
    report = {r.edition_date: r for r in E.mix_report(out.picks).collect()}
    assert report[dt.date(2026, 7, 23)].categories == 1
    verdicts = [r.verdict for r in E.audit(out).collect()]
    assert sum(v.startswith("selected") for v in verdicts) == 20 and any("duplicate" in v for v in verdicts)


def test_gates_fail_closed(spark):
    df = spark.createDataFrame(pool_rows(4, 30), SCHEMA).withColumn(
        "paywalled", F.col("edition_date") == F.lit("2026-07-21").cast("date"))
    few = df.filter("edition_date <> '2026-07-20' or seq < 4")
    gates = {str(r.edition_date): r.gate for r in E.select_edition(few, empty_editions(spark)).gates.collect()}
    assert gates["2026-07-20"] == "too-few-candidates" and gates["2026-07-21"] == "too-few-complete"
    assert gates["2026-07-22"] is None


def test_repeats_and_history(spark):
    day = dt.date(2026, 7, 24)
    eds = [(day - dt.timedelta(days=k), 1, "Ceasefire talks resume in Gaza", "", f"https://www.e.com/old{k}?x=1", "i") for k in (1, 2, 3)]
    eds.append((day - dt.timedelta(days=2), 2, "Samsung Galaxy Unpacked 2026: the biggest announcements", "", "https://e.com/u", "i"))
    editions = spark.createDataFrame(eds, "edition_date date, number int, headline string, summary string, originalURL string, imageURL string")
    rows = [(day, dt.datetime(2026, 7, 24, 9), k, f"{k:06x}", t, "BBC News", "BBC News", "WORLD", u, u, None, "", False, "high", k, 1, 1)
            for k, (t, u) in enumerate([("Fresh story about a library", "https://e.com/old2"),
                                        ("Ceasefire talks resume in Gaza!", "https://e.com/b"),
                                        ("Samsung's wider Z Fold 8 feels just right", "https://e.com/c"),
                                        ("Missile strikes in Gaza go on", "https://e.com/d")])]
    c = S.with_classes(spark.createDataFrame(rows, SCHEMA))
    got = {r.seq: r for r in H.recent_repeats(c, editions).collect()}
    assert got[0].repeat_rule == "recent-exact-url" and got[0].prior_date == day - dt.timedelta(days=2)
    assert got[1].repeat_rule == "recent-exact-headline" and got[1].prior_date == day - dt.timedelta(days=1)
    assert got[2].repeat_rule.startswith("recent-") and got[3].repeat_rule is None
    scored = {r.seq: r for r in S.mix_static(H.with_history(c, editions)).collect()}
    assert scored[3].run == 3 and scored[3].static_delta == -4.5


def test_story_identity_rules(spark):
    pairs = [("Samsung Galaxy Unpacked 2026: The 6 biggest announcements", "Samsung's wider Z Fold 8 feels just right", True),
             ("Apple iPhone 18 event: the 5 biggest announcements", "Apple's MacBook gets a redesign", False),
             ("Samsung phone launch", "Samsung earnings fall as chip profit drops", False)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string, want boolean")
    for side in "ab":
        df = C.with_story_identity(C.with_story_metadata(df, side, F.lit(""), out=f"m{side}"), side, F.lit(""), f"m{side}", f"s{side}")
    for r in df.select("i", "want", C.is_same_story(F.col("sa"), F.col("sb")).alias("x"), C.is_same_story(F.col("sb"), F.col("sa")).alias("y")).collect():
        assert (r.x, r.y) == (r.want, r.want), pairs[r.i]
