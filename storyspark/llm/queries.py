"""The operators' queries, with production parameters, over their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyspark.llm import (alignment, bpe, chat, decontaminate, gam, licenses, ngram_join, outliers, runs, secrets_crf,
                            simhash, token_counts, url_lists)
from storyspark.llm.common import bounded_batches, documents, words
from storyspark.session import written

COUNTING = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(COUNTING))


def coded_digests(coded: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens`` and digests of decimal ids and decoded bytes."""
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    return coded_digests(bpe.decode(bpe.encode(documents(spark, sf_dir), ranks), ranks))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality_rules(documents(spark, sf_dir)).drop("distance")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with a fetch day, which the table lacks: a number of 0 to 364 from a digest of the id."""
    day = F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 1, 6), 16, 10).cast("long") % 365
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", day.alias("day"))


def list_events(pages: DataFrame) -> DataFrame:
    """Dated list entries, derived from the sites and first folders of ``pages``, by digests of their names.

    A site is listed on one of three lists, taken off again, and half of them are listed once more; every
    folder of a site has an allowing entry for a while.
    """
    site = F.regexp_replace(url_lists.host(F.col("url")), r"^(www|m|blog)\.", "")
    folder = F.regexp_extract(url_lists.path(F.col("url")), r"^/([^/]+)/", 1)
    sites = pages.select(site.alias("rule")).where("rule <> ''").distinct().select("rule", F.lit("block").alias("action"))
    folders = (pages.select(F.concat(url_lists.host(F.col("url")), F.lit("/"), folder, F.lit("/")).alias("rule"))
               .where("rule NOT LIKE '/%' AND rule NOT LIKE '%//'").distinct()
               .select("rule", F.lit("allow").alias("action")))

    def digest(at: int, size: int) -> Column:
        return F.conv(F.substring(F.md5("rule"), at, size), 16, 10).cast("long")

    listed = F.element_at(F.array(F.lit("adult"), F.lit("malware"), F.lit("spam")), (digest(1, 2) % 3 + 1).cast("int"))
    first, second, third = digest(3, 3) % 300, digest(6, 3) % 120 + 10, digest(9, 3) % 60 + 5
    days = [F.struct(first.alias("day"), F.lit(True).alias("added")),
            F.struct((first + second).alias("day"), F.lit(False).alias("added")),
            F.struct(F.when(digest(12, 2) % 2 == 0, first + second + third).alias("day"), F.lit(True).alias("added"))]
    return sites.union(folders).select(
        F.when(F.col("action") == "allow", "folders").otherwise(listed).alias("list"), "rule", "action",
        F.inline(F.array(*days))).where("day IS NOT NULL")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = captures(spark, sf_dir)
    return url_lists.filter_urls(pages, list_events(pages))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out)
    rows = gam.measured(documents(spark, sf_dir))
    return gam.score(rows, gam.learn(rows, labels)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql("SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, '</s>[INST] ok [/INST]' AS text "
                    "UNION ALL SELECT -1L, 1L, 'assistant', '</s>[INST] ok [/INST]'")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").union(own)
    return chat.read_back(chat.format_chats(rows, chat.text_parts(F.col("text"))))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secrets_crf.scan_secrets(docs, secrets_crf.learn(docs))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = [k[0] for k in secrets_crf.KINDS]
    counts = [number(k) for k in base]
    return found.select("doc_id", *counts, F.sha2(listed(F.filter("found", lambda s: s["kind"].isin(base))).cast("binary"),
                                                  256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = public_tokenizers.path(LEFT), public_tokenizers.path(RIGHT)
    aligned = alignment.aligned_digests(documents(spark, sf_dir), left, right)
    return alignment.count_links(aligned, alignment.right_ids(right)).drop("_row")


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; a tenth of the texts, by a hash of the id, becomes periodic from some word on."""
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    seed, w, n = F.floor(digest / 10), F.col("_words"), F.size("_words")
    rows = docs.select("doc_id", "text", digest.alias("_digest"), seed.alias("_seed"),
                       F.when(digest % 10 == 0, words(F.col("text"))).alias("_words"))
    rows = rows.withColumn("_from", F.when(n > 0, F.col("_seed") % n))
    rows = rows.withColumn("_period", F.lit(1) + F.floor((n - F.col("_from")) / (F.lit(3) + F.col("_seed") % 8)))
    start, period = F.col("_from"), F.col("_period")
    looped = F.array_join(F.transform(w, lambda x, i: F.when(i < start, x).otherwise(
        F.get(w, (start + (i - start) % period).cast("int")))), " ")
    return rows.select("doc_id", F.when(F.col("_digest").isNotNull() & start.isNotNull(), looped)
                       .otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Numbers of the most repetitive run of every row of ``find_runs``, and digests of its results."""
    def exponent(run: Column) -> Column:
        return run["length"] / run["period"]

    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-exponent(r)).alias("order"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    with bounded_batches(spark):
        return written(run_digests(runs.find_runs(with_periods(documents(spark, sf_dir)))), "run-digests")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_token_counts, op3_byte_bpe, op4_ngram_join, op5_url_filters, op6_quality_classifier,
    op7_chat_formatting, op8_quality_rules, op9_license_scans, op10_secret_scans, op11_token_alignment,
    op12_periodic_runs, op13_simhash)}

WORDS = r"""list_filter(regexp_split_to_array(
    {text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"""
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _seed_rows(rows: str, key: str) -> str:
    """SQL: every position of ``rows`` with its masked words, one row per mask."""
    masks = " UNION ALL ".join(
        f"SELECT {key}, p, '{m}' || " + " || ' ' || ".join(f"w[p + {k}]" for k, c in enumerate(m) if c == "1")
        + f" AS seed FROM (SELECT {key}, w, unnest(range(1, len(w) - {len(m) - 2})) AS p FROM {rows})"
        for m in decontaminate.MASKS)
    return f"({masks})"


_TOKENS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

_HOST = r"regexp_replace(regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), ':\d*$', '')"
_PATH = "regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1)"


def _digest(at: int, size: int) -> str:
    return f"CAST('0x' || substr(md5(rule), {at}, {size}) AS BIGINT)"


def _escapes(text: str) -> str:
    """SQL: number of backslashes that escaping ``text`` adds."""
    return " + ".join(f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in ("\\", *chat.CONTROLS))


ORACLE: dict[str, str] = {
    "op5_url_filters": f"""
WITH p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path,
  CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6) AS BIGINT) % 365 AS day FROM pages),
r AS (SELECT DISTINCT regexp_replace(host, '^(www|m|blog)\\.', '') AS rule, 'block' AS action FROM p WHERE host <> ''
  UNION ALL SELECT DISTINCT host || '/' || regexp_extract(path, '^/([^/]+)/', 1) || '/', 'allow' FROM p
  WHERE host <> '' AND regexp_extract(path, '^/([^/]+)/', 1) <> ''),
e AS (SELECT rule, action, {_digest(3, 3)} % 300 AS a, {_digest(6, 3)} % 120 + 10 AS b, {_digest(9, 3)} % 60 + 5 AS c,
  {_digest(12, 2)} % 2 = 0 AS again, CASE WHEN action = 'allow' THEN 'folders'
  ELSE ['adult', 'malware', 'spam'][{_digest(1, 2)} % 3 + 1] END AS list FROM r),
v AS (SELECT list, rule, action, a AS f, a + b AS t FROM e
  UNION ALL SELECT list, rule, action, a + b + c, 10000000 FROM e WHERE again),
m AS (SELECT page_id, v.* FROM p JOIN v ON day >= f AND day < t AND (host = rule OR ends_with(host, '.' || rule)
  OR (contains(rule, '/') AND starts_with(host || path, rule))))
SELECT page_id, any_value(day) AS day, count(rule) AS n_active,
  coalesce(array_to_string(list_sort(list_distinct(list(list) FILTER (list IS NOT NULL))), ','), '') AS lists,
  arg_max(rule, (length(rule), action = 'allow', rule)) AS rule,
  coalesce(arg_max(action, (length(rule), action = 'allow', rule)) = 'block', false) AS blocked
FROM p LEFT JOIN m USING (page_id) GROUP BY page_id""",
    "op7_chat_formatting": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(chat.START + chat.END) + 1} + length(role) + length(text) + {_escapes("text")}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
    "op1_decontamination": f"""
WITH d AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
b AS (SELECT item_id, {_TOKENS} AS w FROM benchmark),
hits AS (SELECT x.doc_id, y.item_id, d.w AS w, b.w AS v, x.p - y.p AS shift, least(len(b.w), 20) AS n,
  greatest(0, least(y.p - 1 - CAST(floor((least(len(b.w), 20) - 8) / 2.0) AS BIGINT),
                    len(b.w) - least(len(b.w), 20))) AS s
  FROM {_seed_rows("d", "doc_id")} x JOIN {_seed_rows("(SELECT * FROM b WHERE len(w) > 16)", "item_id")} y USING (seed)
  JOIN d ON d.doc_id = x.doc_id JOIN b ON b.item_id = y.item_id
  UNION ALL SELECT z.doc_id, z.item_id, d.w, b.w, shift, len(b.w), 0
  FROM (SELECT DISTINCT x.doc_id, y.item_id, x.p - y.p AS shift
    FROM (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d) x
    JOIN (SELECT item_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM b WHERE len(w) <= 16) y USING (t)) z
  JOIN d ON d.doc_id = z.doc_id JOIN b ON b.item_id = z.item_id),
checked AS (SELECT doc_id, item_id, n, s + shift AS first_word, len(list_filter(range(s + 1, s + n + 1),
  lambda k: k + shift >= 1 AND w[k + shift] = v[k])) AS n_equal FROM hits)
SELECT doc_id, item_id, arg_min(first_word, -n_equal * 1000000000 + first_word) AS first_word,
  arg_min(n, -n_equal * 1000000000 + first_word) AS n_compared, max(n_equal) AS n_equal
FROM checked WHERE 100 * n_equal >= 80 * n GROUP BY ALL""",
    "op4_ngram_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(text=LOWER)} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g
  FROM d),
t AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM s),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT a, b FROM link UNION SELECT r.a, e.b FROM reach r JOIN link e ON r.b = e.a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles,
  least(doc_id, (SELECT min(b) FROM reach WHERE a = doc_id)) AS component_id,
  (SELECT count(*) FROM link WHERE a = doc_id) AS n_links FROM s""",
}
