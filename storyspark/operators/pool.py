"""Candidate pools: build, freeze, identify, validate, enrich choice (P9, P13, A9, S12, V10, V11,
V16, K10, A14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import classify as C, mixes as M, numbers as N, text as T, times, urls
from ..functions.rules import in_list, str_array, text
from ..session import dealt, written
from . import scoring as S
from .violations import each, repeated, rule, union, violations

DATE = "edition_date"


def pool_exclusion_reason(stale_hours: float = 48) -> Column:
    """Why a scored candidate stays out of the pool; NULL keeps it."""
    return (F.when(~urls.has_real_url("url"), F.lit("invalid_article_url"))
            .when(times.is_stale("published_at", "now", stale_hours), F.lit("stale"))
            .when(~S.resolvable(), F.lit("unresolvable_candidate_id"))
            .when(~C.likely_complete("paywalled", "source", "snippet"),
                  F.lit("thin_or_paywalled_source"))
            .when(F.col("kind") != "", F.concat(F.lit("editorial_exclusion:"), F.col("kind"))))


def story_identity_text(canonical) -> Column:
    """cluster:<id> for clustered stories, else a hash of the canonical URL."""
    clustered = F.col("cluster_id").isNotNull() & (F.col("cluster_size") > 1)
    return F.when(clustered, F.concat(F.lit("cluster:"), F.col("cluster_id").cast("string"))
                  ).otherwise(F.concat(F.lit("url:"), F.substring(F.sha2(canonical, 256), 1, 24)))


def build_pool(cands: DataFrame, fresh_hours: float = 36, stale_hours: float = 48) -> DataFrame:
    """Pool rows plus ``exclusion_reason``; kept rows have it NULL.  Rows are dealt out before they are classified."""
    canon = urls.pool_url(F.coalesce(F.when(text("canonical_url") != "", F.col("canonical_url")),
                                     F.col("url")))
    based = dealt(cands).withColumn("canonical_url", canon).withColumn(
        "id", F.when(text("id") != "", F.col("id")).otherwise(urls.stable_id("canonical_url")))
    scored = S.score_candidates(based, fresh_hours)
    members = F.transform(
        C.classify_regions("title", "snippet", None,
                           "structured_regions" if "structured_regions" in cands.columns else None),
        lambda m: F.struct(m["id"].alias("id"), m["strength"].alias("strength"),
                           F.array_sort(m["evidence"]).alias("evidence")))
    return scored.select(
        DATE, "now", "seq", "id", T.py_strip(text("title")).alias("headline"),
        T.py_strip(text("snippet")).alias("summary"), T.py_strip(text("source")).alias("source"),
        F.col("canonical_url").alias("url"), "published_at",
        F.upper(F.coalesce("category", F.lit("OTHER"))).alias("category"),
        C.topics("category", "title", "snippet").alias("topics"), members.alias("memberships"),
        N.half_even("base_score").alias("base_score"),
        F.lower(F.coalesce("source_reliability", F.lit("unknown"))).alias("source_reliability"),
        C.topic_fingerprint("title", "snippet").alias("fp"),
        story_identity_text(F.col("canonical_url")).alias("identity"),
        F.struct(F.lit(True).alias("eligible"),
                 F.coalesce("paywalled", F.lit(False)).alias("paywalled"),
                 F.col("source_risk").alias("source_risk"), "cluster_size",
                 "cluster_sources").alias("quality"),
        F.lit(True).alias("eligible"), pool_exclusion_reason(stale_hours).alias("exclusion_reason"))


POOL_COLUMNS = [DATE, "id", "headline", "summary", "source", "url", "published_at", "category",
                "topics", "memberships", "base_score", "source_reliability", "fp", "identity",
                "quality", "eligible"]


def freeze_pool(pool: DataFrame) -> DataFrame:
    """Closed column set in canonical order: sorted arrays, rows sorted by id within a date.

    Dealing out by range reads its input twice, once for the ranges, so the rows are worked out before it.
    """
    return written(pool, "unsorted").withColumns({
        "topics": F.array_sort("topics"),
        "memberships": F.array_sort(F.transform("memberships", lambda m: F.struct(
            m["id"].alias("id"), m["strength"].alias("strength"),
            F.array_sort(m["evidence"]).alias("evidence")))),
    }).select(*POOL_COLUMNS).repartitionByRange(DATE, "id").sortWithinPartitions(DATE, "id")


def pool_json() -> Column:
    """Canonical JSON text of a pool row: sorted keys, no spaces, shortest score."""
    quality = F.struct(F.col("quality.cluster_size").alias("clusterSize"),
                       F.col("quality.cluster_sources").alias("clusterSources"),
                       F.col("quality.eligible").alias("eligible"),
                       F.col("quality.paywalled").alias("paywalled"),
                       F.col("quality.source_risk").alias("sourceRisk"))
    members = F.transform("memberships", lambda m: F.struct(
        m["evidence"].alias("evidence"), m["id"].alias("id"), m["strength"].alias("strength")))
    rest = F.struct(
        "category", "eligible", "headline", "id", times.iso_z(F.col("published_at")).alias("publishedAt"),
        quality.alias("quality"), members.alias("regionMemberships"), "source",
        F.col("source_reliability").alias("sourceReliability"), "summary",
        F.col("fp").alias("topicFingerprint"), "topics",
        F.col("identity").alias("underlyingStoryIdentity"), "url")
    return F.concat(F.lit('{"baseScore":'), N.score_text("base_score"), F.lit(","),
                    F.substr(F.to_json(rest, {"ignoreNullFields": "false"}), F.lit(2)))


def _digest_rows(batches):
    """One row per run of equal keys: the keys and the digest of their last column as a JSON array."""
    import hashlib

    import pyarrow as pa

    key, digest, kinds = None, None, None

    def row():
        digest.update(b"]")
        return pa.RecordBatch.from_arrays(
            [*(pa.array([v], t) for v, t in zip(key, kinds)), pa.array([digest.hexdigest()])],
            [*names, "_digest"])

    for batch in batches:
        names, kinds = batch.schema.names[:-1], [c.type for c in batch.columns[:-1]]
        for *now, json in zip(*(c.to_pylist() for c in batch.columns)):
            if digest is not None and now == key:
                digest.update(b",")
            else:
                if digest is not None:
                    yield row()
                key, digest = now, hashlib.sha256(b"[")
            digest.update(json.encode())
    if digest is not None:
        yield row()


def document_identity(rows: DataFrame, keys, order: str, json: str, out: str,
                      max_bytes: int = V.MAX_POOL_BYTES) -> DataFrame:
    """sha256 of the JSON array of a group's rows in ``order`` (A9), for documents of any size.

    A digest reads its document from front to back, so it is fed row by row from sorted partitions
    and no document is ever put together.  ``within_limit`` says whether it may be published.
    """
    keys = list(keys)
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum(
        F.octet_length(json)).alias("_b")).withColumn("bytes", F.col("_b") + F.col("rows") + 1)
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    hashed = (rows.select(*keys, F.col(order).alias("_o"), F.col(json).alias("_j")).repartition(*keys)
              .sortWithinPartitions(*keys, "_o", "_j").drop("_o")
              .mapInArrow(_digest_rows, f"{kinds}, _digest string").withColumnRenamed("_digest", out))
    return sizes.join(hashed, keys, "left").select(
        *keys, "rows", "bytes", (F.col("bytes") <= max_bytes).alias("within_limit"), out)


def pool_identity(pool: DataFrame) -> DataFrame:
    """(edition_date, rows, bytes, within_limit, pool_identity) of frozen pools."""
    return document_identity(pool.select(DATE, "id", pool_json().alias("json")), [DATE], "id",
                             "json", "pool_identity")


def input_identity(cands: DataFrame) -> DataFrame:
    """Identity of the source rows a pool was built from, in id and URL order."""
    cols = sorted(c for c in cands.columns if c not in (DATE, "now", "body"))
    rows = cands.select(DATE, F.concat_ws("|", "id", F.coalesce("canonical_url", "url")).alias("o"),
                        F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))
    return document_identity(rows, [DATE], "o", "json", "input_identity")


def pool_manifest(pool: DataFrame, cands: DataFrame, generated_at: Column, source: str) -> DataFrame:
    """Header row per date (M9)."""
    bad = validate_pool(pool).groupBy("key").agg(F.count("*").alias("errors"))
    return (pool_identity(pool).join(input_identity(cands).select(DATE, "input_identity"), DATE, "left")
            .join(bad, F.col(DATE).cast("string") == F.col("key"), "left").select(
        DATE, F.lit(V.POOL_SCHEMA_VERSION).alias("schema_version"),
        F.lit(V.POOL_SELECTOR_VERSION).alias("selector_version"),
        generated_at.alias("generated_at"), "pool_identity", F.col("rows").alias("candidate_count"),
        "bytes", F.struct(F.lit(source).alias("source"), F.col("input_identity"),
                          F.lit(V.GENERATOR_VERSION).alias("generator_version")).alias("provenance"),
        F.coalesce("errors", F.lit(0)).alias("errors"),
        (F.coalesce("errors", F.lit(0)) == 0).alias("valid")))


def validate_pool(pool: DataFrame) -> DataFrame:
    """Raw pool contract over typed rows (V10); three checks read the rows, which are worked out once."""
    pool = written(pool, "checked")
    at = F.concat(F.lit("candidates["), F.col("id"), F.lit("]"))

    def where(field):
        return F.concat(at, F.lit("." + field))

    blank = lambda c: F.trim(text(c)) == ""                                    # noqa: E731
    ids = F.transform("memberships", lambda m: m["id"])
    members = F.col("memberships")
    rules = [
        rule(blank("id"), "nonempty", "id", "must be nonempty"),
        rule(~(in_list(urls.scheme("url"), ["http", "https"]) & (urls.authority("url") != "")),
             "url", where("url"), "must be http(s)"),
        *[rule(blank(c), "nonempty", where(f), "must be nonempty") for c, f in (
            ("headline", "headline"), ("summary", "summary"), ("source", "source"),
            ("identity", "underlyingStoryIdentity"))],
        rule(F.col("published_at").isNull(), "timestamp", where("publishedAt"),
             "must be an ISO datetime"),
        rule(~in_list("category", V.CATEGORIES), "taxonomy", where("category"), "is not canonical"),
        rule(F.size(F.array_except("topics", str_array(V.SUPPORTED_TOPICS))) > 0, "taxonomy",
             where("topics"), "contains a noncanonical topic"),
        rule(F.size("topics") != F.size(F.array_distinct("topics")), "taxonomy", where("topics"),
             "contains duplicates"),
        rule(N.score_problem("base_score").isNotNull(), "numeric", where("baseScore"),
             N.score_problem("base_score")),
        rule(~in_list("source_reliability", V.RELIABILITIES), "taxonomy",
             where("sourceReliability"), "is not allowed"),
        rule(~F.col("quality.cluster_size").between(1, 100000), "numeric",
             where("quality.clusterSize"), "must be within [1, 100000]"),
        rule(~F.col("quality.cluster_sources").between(1, 100000), "numeric",
             where("quality.clusterSources"), "must be within [1, 100000]"),
        rule(~F.col("quality.source_risk").between(0, 100), "numeric", where("quality.sourceRisk"),
             "must be within [0, 100]"),
        rule(F.exists("fp", lambda x: F.trim(x) == ""), "nonempty", where("topicFingerprint"),
             "entries must be nonempty"),
        rule(F.size(F.array_except(ids, str_array(V.SUPPORTED_REGIONS))) > 0, "membership",
             where("regionMemberships"), "id is not canonical"),
        rule(F.size(ids) != F.size(F.array_distinct(ids)), "membership",
             where("regionMemberships"), "has duplicate region membership"),
        rule(F.exists(members, lambda m: ~in_list(m["strength"], V.STRENGTHS)), "membership",
             where("regionMemberships"), "strength is not allowed"),
        rule(F.exists(members, lambda m: (m["strength"] == "primary")
                      & (F.size(m["evidence"]) == 0)), "membership", where("regionMemberships"),
             "primary membership requires evidence"),
        rule(M.has_local_path(pool_json()), "leak", at, "forbidden field or local path"),
    ]
    key = F.col(DATE)
    return union(violations(pool, key, rules),
                 repeated(pool, key, F.col("id"), "unique", "id", "duplicate candidate id: "),
                 repeated(pool, key, F.col("url"), "unique", "url", "duplicate candidate url: "))


REQUIRED_KEYS = ["baseScore", "category", "headline", "id", "publishedAt", "regionMemberships",
                 "source", "sourceReliability", "summary", "topicFingerprint", "topics",
                 "underlyingStoryIdentity", "url"]


def validate_pool_json(rows: DataFrame, json: str = "json") -> DataFrame:
    """Closed key set and leak checks over candidate JSON text."""
    missing = F.transform(M.missing_keys(json, REQUIRED_KEYS),
                          lambda k: F.concat(F.lit("missing field: "), k))
    extra = F.transform(M.extra_keys(json, REQUIRED_KEYS + ["quality", "eligible"]),
                        lambda k: F.concat(F.lit("unsupported field: "), k))
    leaks = F.transform(M.forbidden_keys(json, V.RAW_FORBIDDEN_KEYS),
                        lambda k: F.concat(F.lit("forbidden field: "), k))
    return violations(rows, F.col(DATE), [
        rule(M.has_local_path(json), "leak", F.col("id"), "local path")],
        [each(missing, "keys", F.col("id")), each(extra, "keys", F.col("id")),
         each(leaks, "leak", F.col("id"))])


# --- enrichment choice -------------------------------------------------------------------------

def select_for_enrichment(pool: DataFrame, k: int = V.ENRICH_TARGET) -> DataFrame:
    """Coverage-aware top k per date: region floors, missing topics, then score.

    Only the best 2k + 1 rows of each region, of each topic and overall can be taken (at most k
    are ever taken before them), so that many per date are kept by a rank filter, which Spark
    applies before the shuffle, and the choice is a fold over that bounded list.
    """
    usable = pool.filter(F.coalesce("eligible", F.lit(True))
                         & F.coalesce(F.col("quality.eligible"), F.lit(True)))
    rows = usable.select(DATE, "id", F.col("base_score").cast("double").alias("base"), "topics",
                         C.primary_regions("memberships").alias("primary"))
    tags = F.concat(F.array(F.lit("all")), F.transform("primary", lambda r: F.concat(F.lit("r:"), r)),
                    F.transform("topics", lambda t: F.concat(F.lit("t:"), t)))
    w = Window.partitionBy(DATE, "tag").orderBy(F.col("base").desc(), "id")
    top = (rows.withColumn("tag", F.explode(tags)).withColumn("_r", F.row_number().over(w))
           .filter(F.col("_r") <= 2 * k + 1).drop("_r", "tag").distinct())
    lists = top.groupBy(DATE).agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("base")).alias("k"), "id", "topics", "primary"))).alias("rows"))

    def fold(chosen: Column, fits) -> Column:
        return F.aggregate("rows", chosen, lambda acc, c: F.when(
            (F.size(acc) < k) & ~F.exists(acc, lambda x: x["id"] == c["id"]) & fits(acc, c),
            F.concat(acc, F.array(c))).otherwise(acc))

    kind = "array<struct<k:double,id:string,topics:array<string>,primary:array<string>>>"
    out = lists.withColumn("chosen", F.array().cast(kind))
    for region, floor in V.ENRICH_FLOORS:
        out = out.withColumn("chosen", fold(F.col("chosen"), lambda acc, c, r=region, n=floor: (
            F.array_contains(c["primary"], r)
            & (F.size(F.filter(acc, lambda x: F.array_contains(x["primary"], r))) < n))))
    for topic in V.SUPPORTED_TOPICS:
        out = out.withColumn("chosen", fold(F.col("chosen"), lambda acc, c, t=topic: (
            F.array_contains(c["topics"], t)
            & ~F.exists(acc, lambda x: F.array_contains(x["topics"], t)))))
    out = out.withColumn("chosen", fold(F.col("chosen"), lambda acc, c: F.lit(True)))
    return out.select(DATE, F.posexplode("chosen").alias("pos", "c")).select(
        DATE, F.col("c.id").alias("id"), (F.col("pos") + 1).alias("position"))


# --- enriched pools ----------------------------------------------------------------------------

def editorial_json() -> Column:
    """Canonical JSON of an enriched row: {"editorial": ..., "selector": ...}."""
    e = F.col("editorial")
    body = F.struct(*[e[n].alias(n) for n in (
        "audioURL", "category", "headline", "imageURL", "keyTakeaways", "originalURL", "placeTime",
        "readTime", "source", "summary", "whyItMatters")])
    return F.concat(F.lit('{"editorial":'), F.to_json(body, {"ignoreNullFields": "false"}),
                    F.lit(',"selector":'), pool_json(), F.lit("}"))


def editorial_identity(enriched: DataFrame) -> DataFrame:
    """Both identities of enriched pools: the selector part and the whole."""
    whole = document_identity(enriched.select(DATE, "id", editorial_json().alias("json")), [DATE],
                              "id", "json", "editorial_pool_identity")
    part = pool_identity(enriched).select(DATE, F.col("pool_identity").alias("selector_pool_identity"))
    return whole.join(part, DATE)


def validate_enriched(enriched: DataFrame) -> DataFrame:
    """Enriched pool contract (V11); the selector part also obeys the raw contract."""
    e = F.col("editorial")
    at = F.concat(F.lit("candidates["), F.col("id"), F.lit("].editorial."))

    def where(field):
        return F.concat(at, F.lit(field))

    kt = e["keyTakeaways"]
    rules = [
        *[rule(F.trim(text(e[c])) == "", "nonempty", where(c), "must be nonempty")
          for c in ("category", "source", "headline", "summary", "whyItMatters", "placeTime")],
        rule(F.coalesce(F.size(kt), F.lit(0)) <= 0, "takeaways", where("keyTakeaways"),
             "must be a nonempty array"),
        rule(F.size(kt) > 8, "takeaways", where("keyTakeaways"), "exceeds 8 entries"),
        rule(F.exists(kt, lambda x: F.trim(text(x)) == ""), "takeaways", where("keyTakeaways"),
             "entries must be nonempty"),
        *[rule(~((urls.scheme(e[c]) == "https") & (urls.authority(e[c]) != "")), "url", where(c),
               m) for c, m in (("originalURL", "must be an https article URL"),
                               ("imageURL", "must be an https URL"))],
        rule(e["readTime"].isNull(), "numeric", where("readTime"), "must be an integer"),
        rule(~e["readTime"].between(1, 60), "numeric", where("readTime"), "must be within [1, 60]"),
        rule(e["audioURL"].isNull(), "nonempty", where("audioURL"), "must be a string"),
        rule(e["category"] != F.col("category"), "consistency", where("category"),
             "does not match the selector category"),
        rule((text("source") != "") & (e["source"] != F.col("source")), "consistency",
             where("source"), "does not match the selector source"),
    ]
    leaks = F.transform(M.forbidden_keys(editorial_json(), V.ENRICHED_FORBIDDEN_KEYS),
                        lambda k: F.concat(F.lit("forbidden field: "), k))
    raw = validate_pool(enriched).withColumn("message", F.concat(F.lit("selector: "), "message"))
    return union(violations(enriched, F.col(DATE), rules, [each(leaks, "leak", F.col("id"))]), raw)


def admit_pools(pools: DataFrame, now: Column) -> DataFrame:
    """Add ``refusal`` (NULL = admitted) to pool headers asked for a date.

    Needs requested_date, edition_date, candidate_count, generated_at, schema_version,
    selector_version, errors, and stored and derived identities.
    """
    age = (F.unix_micros(now) - F.unix_micros("generated_at")) / 6e7
    return pools.withColumn("refusal", F.when(
        (F.col("schema_version") != 1) | (F.col("selector_version") != V.POOL_SELECTOR_VERSION),
        F.lit("candidate_pool_version_incompatible"))
        .when(F.col("errors") > 0, F.lit("candidate_pool_schema_invalid"))
        .when(~F.coalesce(F.col("stored_identity") == F.col("derived_identity"), F.lit(False)),
              F.lit("candidate_pool_identity_mismatch"))
        .when(F.col(DATE) != F.col("requested_date"), F.lit("candidate_pool_date_mismatch"))
        .when(F.col("candidate_count") < V.ENRICH_MINIMUM, F.lit("candidate_pool_empty"))
        .when(F.col("candidate_count") > V.ENRICH_TARGET, F.lit("candidate_pool_schema_invalid"))
        .when(F.col("generated_at").isNull(), F.lit("candidate_pool_schema_invalid"))
        .when(age < -V.POOL_FUTURE_SKEW_MINUTES, F.lit("candidate_pool_future_timestamp"))
        .when(age > V.POOL_MAX_AGE_DAYS * 1440, F.lit("candidate_pool_stale")))


def pool_report(identities: DataFrame, summaries: DataFrame, picks: DataFrame,
                audit: DataFrame) -> DataFrame:
    """Run report per mix: identity, counts, phases of the picks, rejected duplicates."""
    phases = picks.groupBy(DATE, "mix_id").agg(F.array_sort(F.collect_list(
        F.struct("id", "phase"))).alias("selection_phases"))
    dups = (audit.filter(F.lower(text("rejection_reason")).contains("duplicate"))
            .groupBy(DATE, "mix_id").agg(F.array_sort(F.collect_list("id")).alias("rejected_duplicates")))
    empty = F.array().cast("array<string>")
    return (summaries.join(identities.select(DATE, "pool_identity"), DATE, "left")
            .join(phases, [DATE, "mix_id"], "left").join(dups, [DATE, "mix_id"], "left")
            .withColumn("rejected_duplicates", F.coalesce("rejected_duplicates", empty)))
