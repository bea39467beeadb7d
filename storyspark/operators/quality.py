"""Edition checks (V1-V5, V7, V8, V12, V14, V15) as violation rows.

Structure checks look at the JSON text of a signal, because they are about types; ``signal_json``
makes that text from typed edition rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import classify as C, mixes as M, prose as P, text as T, urls
from ..functions.rules import in_list, str_array, text
from .duplicates import duplicate_pairs, first_duplicate_pair
from .violations import ROW, each, repeated, rule, union, violations

DATE = "edition_date"
SIGNAL_FIELDS = ["number", "importance", "lead", "category", "source", "headline", "summary",
                 "keyTakeaways", "whyItMatters", "originalURL", "readTime", "imageURL",
                 "placeTime", "audioURL", "localized", "listen"]


def signal_json(columns) -> Column:
    """JSON text of an edition row, NULL members left out."""
    return F.to_json(F.struct(*[c for c in SIGNAL_FIELDS if c in columns]))


# --- JSON type helpers -------------------------------------------------------------------------

def _kind(v: Column, path: str) -> Column:
    """Type name of a JSON member ('' when absent)."""
    return F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit(""))


def _str(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _is_text(v: Column, path: str) -> Column:
    """A string with something in it."""
    return (_kind(v, path) == "STRING") & (F.trim(F.coalesce(_str(v, path), F.lit(""))) != "")


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _present(kind: Column) -> Column:
    return ~kind.isin("", "VOID")


def _where(prefix, name: str) -> Column:
    return F.concat(prefix, F.lit(name))


def _localized(v: Column, at: Column) -> list[Column]:
    loc, ja = _kind(v, "$.localized"), _kind(v, "$.localized.ja")
    is_loc, is_ja = loc.startswith("OBJECT"), ja.startswith("OBJECT")
    items = F.from_json(F.get_json_object(F.to_json(v), "$.localized.ja.keyTakeaways"),
                        "array<string>")
    kt = _kind(v, "$.localized.ja.keyTakeaways")
    good_list = (kt.startswith("ARRAY") & (F.size(items) > 0)
                 & F.forall(items, lambda x: F.trim(text(x)) != "")
                 & kt.isin("ARRAY<STRING>"))
    return [
        rule(_present(loc) & ~is_loc, "localized", at, "`localized` must be an object"),
        rule(is_loc & _present(ja) & ~is_ja, "localized", at, "`localized.ja` must be an object"),
        *[rule(is_ja & (_kind(v, f"$.localized.ja.{k}") != "") & ~_is_text(v, f"$.localized.ja.{k}"),
               "localized", _where(at, f" localized.ja.{k}"), "must be a non-empty string")
          for k in ("headline", "summary", "whyItMatters")],
        rule(is_ja & (kt != "") & ~F.coalesce(good_list, F.lit(False)), "localized",
             _where(at, " localized.ja.keyTakeaways"), "must be a non-empty list of strings"),
    ]


def _row(name, field, message) -> Column:
    return F.struct(F.lit(name).alias("rule"), field.cast("string").alias("field"),
                    F.lit(message).alias("message"))


def _listen(v: Column, at: Column) -> Column:
    """Violations of every language track of a ``listen`` block, as one array."""
    tracks = F.map_entries(F.from_json(F.get_json_object(F.to_json(v), "$.listen"),
                                       "map<string,string>"))

    def caption_rows(cap, j, where):
        c = F.try_parse_json(cap)
        here = F.concat(where, F.lit(".captions["), j.cast("string"), F.lit("]"))
        d = _kind(c, "$.duration")
        obj = cap.startswith("{")
        return F.array_compact(F.array(
            F.when(~obj, _row("listen", here, "must be an object")),
            F.when(obj & ~_is_text(c, "$.speaker"),
                   _row("listen", _where(here, ".speaker"), "must be a non-empty string")),
            F.when(obj & ~_is_text(c, "$.text"),
                   _row("listen", _where(here, ".text"), "must be a non-empty string")),
            F.when(obj & ~(_is_number(d) & F.coalesce(
                F.try_variant_get(c, "$.duration", "double") > 0, F.lit(False))),
                   _row("listen", _where(here, ".duration"), "must be a number > 0"))))

    def track_rows(entry):
        lang, raw = entry["key"], entry["value"]
        where = F.concat(at, F.lit(" listen."), lang)
        t = F.try_parse_json(raw)
        obj = raw.startswith("{")
        gap, caps = _kind(t, "$.gap"), _kind(t, "$.captions")
        own = F.array_compact(F.array(
            F.when(~obj & lang.isin("en", "ja"), _row("listen", where, "must be an object")),
            F.when(obj & (_kind(t, "$.audioURL") != "") & ~_is_text(t, "$.audioURL"),
                   _row("listen", _where(where, ".audioURL"), "must be a non-empty string")),
            F.when(obj & (gap != "") & ~(_is_number(gap) & F.coalesce(
                F.try_variant_get(t, "$.gap", "double") >= 0, F.lit(False))),
                   _row("listen", _where(where, ".gap"), "must be a number >= 0")),
            F.when(obj & (caps != "") & ~caps.startswith("ARRAY"),
                   _row("listen", _where(where, ".captions"), "must be a list"))))
        list_ = F.from_json(F.get_json_object(raw, "$.captions"), "array<string>")
        inner = F.when(obj & caps.startswith("ARRAY"), F.flatten(F.transform(
            list_, lambda c, j: caption_rows(c, j, where)))).otherwise(F.array().cast(ROW))
        return F.concat(own, F.coalesce(inner, F.array().cast(ROW)))

    kind = _kind(v, "$.listen")
    langs = F.filter(tracks, lambda e: e["key"] != "format")
    top = F.array_compact(F.array(
        F.when(_present(kind) & ~kind.startswith("OBJECT"),
               _row("listen", at, "`listen` must be an object")),
        F.when(kind.startswith("OBJECT") & (_kind(v, "$.listen.format") != "")
               & (_kind(v, "$.listen.format") != "STRING"),
               _row("listen", _where(at, " listen.format"), "must be a string"))))
    return F.concat(top.cast(ROW), F.when(kind.startswith("OBJECT"), F.flatten(
        F.transform(langs, track_rows))).otherwise(F.array().cast(ROW)))


def _signals(df: DataFrame) -> DataFrame:
    """Signals with their JSON parsed once: needs edition_date and json."""
    return df.withColumn("v", F.try_parse_json("json")).withColumn("at", F.concat(
        F.lit("signal "), F.coalesce(_str(F.col("v"), "$.number"), F.lit("?"))))


def validate_structure(signals: DataFrame) -> DataFrame:
    """Five signals, one lead in the top tier, and the fields every client needs (V1, V3)."""
    df = _signals(signals)
    v, at = F.col("v"), F.col("at")
    imp_kind, imp = _kind(v, "$.importance"), F.try_variant_get(v, "$.importance", "int")
    url = F.coalesce(_str(v, "$.originalURL"), F.lit(""))
    https = (urls.scheme(url) == "https") & (urls.authority(url) != "")
    rows = violations(df, F.col(DATE), [
        rule(~_present(imp_kind), "importance", at, "missing `importance`"),
        rule(_present(imp_kind) & ~((imp_kind == "BIGINT") & imp.between(1, 5)), "importance", at,
             "importance not in 1..5"),
        rule(~_is_text(v, "$.summary"), "summary", at, "has an empty/missing summary"),
        rule(_kind(v, "$.readTime") != "BIGINT", "readTime", at, "readTime must be an integer"),
        rule(~https, "url", at, "originalURL not https"),
        rule(https & ~urls.has_path(url), "url", at, "originalURL is a homepage, not an article"),
        *_localized(v, at)], [_listen(v, at)])
    lead = F.coalesce(F.try_variant_get(v, "$.lead", "boolean"), F.lit(False)) & (
        _kind(v, "$.lead") == "BOOLEAN")
    tier = F.when(imp_kind == "BIGINT", imp)
    per = df.groupBy(DATE).agg(F.count("*").alias("n"), F.count_if(lead).alias("leads"),
                               F.min(tier).alias("top"), F.max(F.when(lead, tier)).alias("lead_tier"))
    groups = violations(per, F.col(DATE), [
        rule(F.col("n") != 5, "count", "signals", F.concat(
            F.lit("expected 5 signals, found "), F.col("n").cast("string"))),
        rule(F.col("leads") == 0, "lead", "lead", "no signal has `lead: true`"),
        rule(F.col("leads") > 1, "lead", "lead", "multiple leads — exactly one required"),
        rule((F.col("leads") == 1) & (F.col("lead_tier") != F.col("top")), "lead", "lead",
             "the lead must be the most important story")])
    return union(rows, groups)


def validate_prose(editions: DataFrame) -> DataFrame:
    """Prose gate over summary, why and every takeaway of editions since the gate exists (V2)."""
    recent = editions.filter(F.col(DATE) >= F.lit(V.PROSE_GATE_SINCE).cast("date"))
    at = F.concat(F.lit("signal "), F.col("number").cast("string"), F.lit(" "))
    takes = F.flatten(F.transform("keyTakeaways", lambda t, i: F.transform(
        P.publish_issues(t), lambda m: F.struct(F.lit("prose").alias("rule"), F.concat(
            at, F.lit("keyTakeaways["), i.cast("string"), F.lit("]")).alias("field"),
            m.alias("message")))))
    return violations(recent, F.col(DATE), [
        rule(P.headline_glued("headline", "summary"), "prose", F.concat(at, F.lit("summary")),
             "begins with the headline glued to body text")],
        [each(P.publish_issues("summary"), "prose", F.concat(at, F.lit("summary"))),
         each(P.publish_issues("whyItMatters"), "prose", F.concat(at, F.lit("whyItMatters"))),
         F.coalesce(takes, F.array().cast(ROW))])


def validate_listen_ready(signals: DataFrame) -> DataFrame:
    """What an edition needs before it may be served: five English clips in its folder (V4)."""
    df = _signals(signals)
    v, at = F.col("v"), F.col("at")
    url = _str(v, "$.listen.en.audioURL")
    has = _is_text(v, "$.listen.en.audioURL")
    folder = F.concat(F.lit("/audio/"), F.col(DATE).cast("string"), F.lit("/"))
    rows = violations(df, F.col(DATE), [
        rule(~has, "listen-ready", at, "is missing listen.en.audioURL"),
        rule(has & ~((urls.scheme(url) == "https") & (urls.authority(url) != "")), "listen-ready",
             at, "listen.en.audioURL is not https"),
        rule(has & ~url.endswith(".mp3"), "listen-ready", at, "listen.en.audioURL is not an .mp3"),
        rule(has & ~F.contains(url, folder), "listen-ready", at,
             "listen.en.audioURL is not in this edition's audio folder")])
    per = df.groupBy(DATE).agg(F.count("*").alias("n"))
    return union(rows, violations(per, F.col(DATE), [
        rule(F.col("n") != 5, "listen-ready", "signals", F.concat(
            F.lit("a promoted pointer must have 5 signals, found "), F.col("n").cast("string")))]))


def complete_dates(signals: DataFrame) -> DataFrame:
    """Dates of editions that may be served."""
    bad = validate_listen_ready(signals).select(F.col("key").alias("_k")).distinct()
    return signals.select(DATE).distinct().join(
        bad, F.col(DATE).cast("string") == F.col("_k"), "left_anti")


def latest_edition(signals: DataFrame) -> DataFrame:
    """Rows of the newest complete edition."""
    newest = complete_dates(signals).agg(F.max(DATE).alias(DATE))
    return signals.join(newest, DATE, "left_semi")


def validate_dates(editions: DataFrame, today: Column) -> DataFrame:
    """File date equals inner date, and neither is far in the future (V5)."""
    heads = editions.select(DATE, "inner_date").distinct()
    inner = F.col("inner_date").try_cast("date")
    return violations(heads, F.col(DATE), [
        rule(inner.isNull(), "date", "date", F.concat(
            F.lit("invalid or missing feed date: "), text("inner_date"))),
        rule(inner.isNotNull() & (inner != F.col(DATE)), "date", "date", F.concat(
            F.lit("edition filename date differs from internal date "), text("inner_date"))),
        rule(inner > F.date_add(today, V.FUTURE_DATE_DAYS), "date", "date", F.concat(
            F.lit("implausible future date: "), text("inner_date")))])


def validate_pointer(signals: DataFrame, latest: DataFrame) -> DataFrame:
    """The served pointer is complete and equals the newest complete edition (V5)."""
    own = validate_listen_ready(latest).withColumn("message", F.concat(F.lit("latest: "), "message"))
    newest = complete_dates(signals).agg(F.max(DATE).alias("newest"))
    served = latest.agg(F.max(DATE).alias("served"))

    def digest(df):
        """Order-free, duplicate-safe fingerprint of an edition's rows."""
        return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("json").cast("decimal(38,0)"))
                      .alias("h"))

    both = (newest.withColumn("one", F.lit(1)).join(served.withColumn("one", F.lit(1)), "one")
            .join(digest(latest).withColumnsRenamed({"n": "ln", "h": "lh"}).withColumn("one", F.lit(1)), "one")
            .join(digest(signals.join(newest, signals[DATE] == newest["newest"], "left_semi"))
                  .withColumn("one", F.lit(1)), "one"))
    return union(own, violations(both, F.coalesce(F.col("served").cast("string"), F.lit("latest")), [
        rule(F.col("newest").isNull(), "pointer", "latest", "no complete edition exists yet"),
        rule(F.col("newest").isNotNull() & ~F.col("served").eqNullSafe(F.col("newest")), "pointer",
             "latest", F.concat(F.lit("latest date differs from newest complete edition "),
                                F.col("newest").cast("string"))),
        rule((F.col("served") == F.col("newest")) & ((F.col("n") != F.col("ln"))
             | ~F.col("h").eqNullSafe(F.col("lh"))), "pointer", "latest",
             "latest content differs from the newest complete edition")]))


def validate_composition(editions: DataFrame) -> DataFrame:
    """The five as a set: count, distinct topics and stories, clean copy (V7)."""
    told = C.with_story_identity(C.with_story_metadata(
        editions.withColumn("fp", C.topic_fingerprint("headline", "summary")), "headline",
        "summary"), "headline", "summary").withColumn("seq", F.col("number"))
    per = editions.groupBy(DATE).agg(F.count("*").alias("n"))
    at = F.concat(F.lit("signal "), F.col("number").cast("string"))
    pair = F.concat(F.lit("signal "), F.col("src").cast("string"), F.lit(" and signal "),
                    F.col("dst").cast("string"))
    same = duplicate_pairs(told, fingerprints=False)
    return union(
        violations(per, F.col(DATE), [rule(F.col("n") != 5, "count", "signals", F.concat(
            F.lit("expected exactly 5 signals, got "), F.col("n").cast("string")))]),
        violations(first_duplicate_pair(told), F.col(DATE), [
            rule(F.lit(True), "duplicate-topic", pair, "the five must cover distinct stories")]),
        violations(same, F.col(DATE), [
            rule(F.lit(True), "duplicate-story", pair, F.col("rule"))]),
        violations(editions, F.col(DATE), (), [each(P.summary_issues("summary"), "summary", at), each(
            P.why_issues("whyItMatters", "summary", "headline"), "why", at)]))


def validate_build(drafts: DataFrame, approved: DataFrame, image_categories) -> DataFrame:
    """Whether approved drafts can be built into an edition (V8).

    ``approved``: edition_date, approved.  ``image_categories``: categories an image pool, alias
    or default pool exists for (None = a default pool covers all).
    """
    at = F.col("id")
    bad = F.array_sort(F.array_intersect(F.array_distinct("flags"), str_array(V.BLOCKING_FLAGS)))
    role_lead = F.col("lead")
    rules = [
        rule(F.size(bad) > 0, "blocking-flag", at, F.concat(
            F.lit("unresolved flag(s): "), F.array_join(bad, ", "))),
        rule(F.col("confidence") == "low", "low-confidence", at, "confidence is low"),
        rule(F.trim(text("title")) == "", "missing", at, "missing headline"),
        rule(F.trim(text("summary")) == "", "missing", at, "missing summary"),
        rule(F.size("key_takeaways") < 1, "missing", at, "needs at least one keyTakeaway"),
        rule(F.trim(text("why")) == "", "missing", at, "missing whyItMatters"),
        rule(role_lead & (F.col("number") != 1), "number", at, "lead must be number 1"),
        rule(~role_lead & ~F.col("number").between(2, 5), "number", at,
             "supporting number must be 2..5"),
        rule(~((urls.scheme("url") == "https") & (urls.authority("url") != "")), "url", at,
             "originalURL not https"),
        rule((urls.scheme("url") == "https") & ~urls.has_path("url"), "url", at,
             "originalURL is a homepage, not an article"),
    ]
    if image_categories is not None:
        rules.append(rule(~in_list("category", image_categories), "image", at,
                          "no curated image for the category"))
    per = drafts.groupBy(DATE).agg(
        F.count("*").alias("n"), F.count_if(role_lead).alias("leads"),
        F.sum(F.when(F.col("number").between(1, 5), F.pow(F.lit(10), F.col("number")))).alias("sig"))
    heads = per.join(approved, DATE, "left")
    groups = violations(heads, F.col(DATE), [
        rule(~F.coalesce("approved", F.lit(False)), "approval", "approved", "approval is required"),
        rule(F.col("n") != 5, "count", "signals", "expected exactly 5 signals"),
        rule(F.col("leads") != 1, "lead", "lead", "expected exactly 1 lead"),
        rule((F.col("n") != 5) | (F.col("sig") != 111110), "number", "number",
             "signal numbers must be exactly 1..5")])
    good_url = drafts.filter((urls.scheme("url") == "https") & urls.has_path("url"))
    return union(violations(drafts, F.col(DATE), rules), groups,
                 repeated(good_url, F.col(DATE), F.col("url"), "unique", "url", "duplicate URL: "))


def validate_feed_schema(signals: DataFrame, feeds: DataFrame) -> DataFrame:
    """The stricter client feed schema: three takeaways, focus and numbers.

    ``feeds``: edition_date, inner_date, focus, version.
    """
    df = _signals(signals)
    v, at = F.col("v"), F.col("at")
    required = ["number", "lead", "category", "source", "headline", "summary", "keyTakeaways",
                "whyItMatters", "originalURL", "readTime", "imageURL"]
    takes = F.from_json(F.get_json_object("json", "$.keyTakeaways"), "array<string>")
    number = F.try_variant_get(v, "$.number", "int")
    missing = F.transform(M.missing_keys("json", required),
                          lambda k: F.concat(F.lit("missing required field "), k))
    rows = violations(df, F.col(DATE), [
        rule(~((_kind(v, "$.number") == "BIGINT") & number.between(1, 5)), "number", at,
             "number must be an integer 1-5"),
        rule(_kind(v, "$.lead") != "BOOLEAN", "lead", at, "lead must be a boolean"),
        rule(~(_kind(v, "$.keyTakeaways").startswith("ARRAY") & (F.size(takes) == 3)), "takeaways",
             at, "keyTakeaways must have exactly 3 items"),
        rule(~_is_text(v, "$.imageURL"), "image", at, "imageURL must be a non-empty string"),
        rule(~_is_text(v, "$.originalURL"), "url", at, "originalURL must be a non-empty string"),
        rule(_kind(v, "$.readTime") != "BIGINT", "readTime", at, "readTime must be an integer"),
        rule(~_kind(v, "$.audioURL").isin("", "VOID", "STRING"), "audio", at,
             "audioURL must be a string or null")], [each(missing, "required", at)])
    lead = F.coalesce(F.try_variant_get(v, "$.lead", "boolean"), F.lit(False))
    per = df.groupBy(DATE).agg(F.count("*").alias("n"), F.count_if(lead).alias("leads"),
                               F.count(F.when(number.between(1, 5), number)).alias("numbered"),
                               F.countDistinct(F.when(number.between(1, 5), number)).alias("nums"))
    heads = per.join(feeds, DATE, "left")
    return union(rows, violations(heads, F.col(DATE), [
        rule(~text("inner_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), "date", "date",
             "date must be a YYYY-MM-DD string"),
        rule(text("focus") != V.FEED_FOCUS, "focus", "focus", "focus must be MIXED"),
        rule(F.col("version").isNull(), "version", "version", "version must be an integer"),
        rule(F.col("n") != 5, "count", "signals", "signals must contain exactly 5 items"),
        rule((F.col("n") == 5) & (F.col("leads") != 1), "lead", "lead",
             "exactly one lead is required"),
        rule((F.col("numbered") == 5) & (F.col("nums") != 5), "number", "number", "numbers must be 1-5, each once")]))


def validate_translation(blocks: DataFrame) -> DataFrame:
    """Translated copy (V14): key, headline, summary, whyItMatters, keyTakeaways."""
    takes = F.slice(F.filter(F.transform("keyTakeaways", lambda x: T.py_strip(text(x))),
                             lambda x: x != ""), 1, 3)
    copy = F.concat(T.py_strip(text("headline")), T.py_strip(text("summary")),
                    T.py_strip(text("whyItMatters")),
                    F.coalesce(F.array_join(takes, ""), F.lit("")))
    return violations(blocks, F.col("key"), [
        *[rule(T.py_strip(text(c)) == "", "missing", c, f"missing {c}")
          for c in ("headline", "summary", "whyItMatters")],
        rule(F.col("keyTakeaways").isNull(), "takeaways", "keyTakeaways", "keyTakeaways not a list"),
        rule(F.col("keyTakeaways").isNotNull() & (F.size(takes) == 0), "takeaways", "keyTakeaways",
             "keyTakeaways empty"),
        rule(copy.rlike("[!！�]|[｡-ﾟ]"), "characters", "copy",
             "disallowed punctuation/half-width characters")])


def request_code(json) -> Column:
    """Error code of a request document, NULL when it obeys the contract."""
    v = F.try_parse_json(json)

    def mix_code(member):
        raw = F.get_json_object(json, f"$.{member}")
        kind = _kind(v, f"$.{member}")

        def list_code(name, allowed, code, need):
            k = _kind(v, f"$.{member}.{name}")
            items = F.from_json(F.get_json_object(json, f"$.{member}.{name}"), "array<string>")
            typed = k.isin("ARRAY<STRING>") | ((k.startswith("ARRAY")) & (F.size(items) == 0))
            bad = (~typed | (F.size(items) != F.size(F.array_distinct(items)))
                   | (F.size(F.array_except(items, str_array(allowed))) > 0))
            if need:
                bad = bad | (F.size(items) == 0)
            return F.when(F.coalesce(bad, F.lit(True)), F.lit(code))

        return (F.when(~kind.startswith("OBJECT"), F.lit("invalid_request"))
                .when(F.size(M.extra_keys(raw, ["mode", "regions", "topics"])) > 0,
                      F.lit("invalid_request"))
                .when(~F.coalesce(_str(v, f"$.{member}.mode") == "custom", F.lit(False)),
                      F.lit("invalid_request"))
                .otherwise(F.coalesce(
                    list_code("regions", V.SUPPORTED_REGIONS, "invalid_region", True),
                    list_code("topics", V.SUPPORTED_TOPICS, "invalid_topic", False))))

    date = _str(v, "$.date")
    real = (_kind(v, "$.date") == "STRING") & date.rlike(r"^\d{4}-\d{2}-\d{2}$") & date.try_cast(
        "date").isNotNull()
    return (F.when(v.isNull() | ~_kind(v, "$").startswith("OBJECT"), F.lit("invalid_request"))
            .when(F.size(M.extra_keys(json, ["date", "active", "pending", "selectorVersion",
                                             "storyCount"])) > 0, F.lit("invalid_request"))
            .when(~F.coalesce((_kind(v, "$.selectorVersion") == "BIGINT") & (
                F.try_variant_get(v, "$.selectorVersion", "int") == V.SELECTOR_VERSION), F.lit(False)),
                F.lit("unsupported_selector_version"))
            .when(~F.coalesce((_kind(v, "$.storyCount") == "BIGINT") & (
                F.try_variant_get(v, "$.storyCount", "int") == V.STORY_COUNT), F.lit(False)),
                F.lit("invalid_request"))
            .when(~F.coalesce(real, F.lit(False)), F.lit("invalid_request"))
            .otherwise(F.coalesce(mix_code("active"),
                                  F.when(_kind(v, "$.pending") != "VOID", mix_code("pending")))))


def validate_requests(requests: DataFrame, json: str = "json", key: str = "key") -> DataFrame:
    """Requests that break the contract, with their code."""
    coded = requests.withColumn("_code", request_code(json))
    return violations(coded, F.col(key), [
        rule(F.col("_code").isNotNull(), F.col("_code"), "request", F.col("_code"))])
