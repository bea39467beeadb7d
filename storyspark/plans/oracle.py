"""DuckDB SQL with the meaning of the registered queries, written from the same rule tables.

Patterns are matched against text whose accented letters are replaced by a 'q', because the
regex engine's word boundaries are ASCII there and Unicode here.
"""

from __future__ import annotations

from .. import vocab as V
from ..functions.text import PROSE_WORD, WORD
from .inputs import CANDIDATES_SQL, DATES, ITEMS_SQL
from .queries import TOPIC_KEYWORDS

ORACLE: dict[str, str] = {}
D = "CAST(edition_date AS VARCHAR) AS edition_date"


def q(s) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def fold(e) -> str:
    return f"regexp_replace({e}, '[À-ÖØ-öø-ÿ]', 'q', 'g')"


def rx(e, pattern) -> str:
    return f"regexp_matches({e}, {q(pattern)}, 'i')"


def rxc(e, pattern) -> str:
    return f"regexp_matches({e}, {q(pattern)})"


def first(e, rules, default="NULL") -> str:
    return "CASE " + " ".join(f"WHEN {rx(e, p)} THEN {q(x)}" for p, x in rules) + f" ELSE {default} END"


def labels(e, rules) -> str:
    return ("list_sort(list_distinct(list_filter([" + ", ".join(
        f"CASE WHEN {rx(e, p)} THEN {q(x)} END" for p, x in rules) + "], lambda x: x IS NOT NULL)))")


def bar(e, sep="|") -> str:
    return f"coalesce(array_to_string({e}, {q(sep)}), '')"


def i(cond) -> str:
    return f"CAST(coalesce({cond}, false) AS INTEGER)"


U_SCHEME = "lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
U_NET = "regexp_extract({u}, '^[a-z]+://([^/?#]*)', 1)"
U_PATH = "regexp_extract({u}, '^[a-z]+://[^/?#]*([^?#]*)', 1)"


def scheme(u="url"):
    return U_SCHEME.format(u=u)


def net(u="url"):
    return U_NET.format(u=u)


def path(u="url"):
    return U_PATH.format(u=u)


def sha6(e):
    return f"substring(sha1({e}), 1, 6)"


def real_url(u="url"):
    return (f"({scheme(u)} = 'https' AND {net(u)} <> '' AND rtrim({path(u)}, '/') <> '' AND NOT "
            f"{rx(path(u), V.RANK_VIDEO_PATH)})")


def pool_form(u="url"):
    return (f"CASE WHEN {scheme(u)} = 'https' AND {net(u)} <> '' AND rtrim({path(u)}, '/') <> '' THEN "
            f"{scheme(u)} || '://' || lower({net(u)}) || rtrim({path(u)}, '/') ELSE '' END")


PAGE_CANON = (f"{scheme()} || '://' || lower({net()}) || CASE WHEN rtrim({path()}, '/') = '' THEN '/' ELSE "
              f"rtrim({path()}, '/') END || CASE WHEN url LIKE '%page=2%' THEN '?page=2&ref=x' ELSE '' END")

ORACLE["url_forms"] = f"""SELECT page_id, {PAGE_CANON} AS canonical, {pool_form()} AS pool_form,
  {scheme()} || '://' || lower({net()}) || rtrim({path()}, '/') AS selector_form,
  regexp_replace(lower({net()}), '^www\\.', '') || rtrim({path()}, '/') AS story_key,
  {sha6('url')} AS id, {i(real_url())} AS real_url, {i(f"rtrim({path()}, '/') = ''")} AS homepage FROM pages"""
ORACLE["url_id_collisions"] = f"""SELECT 'all' AS edition_date, {sha6('url')} AS id,
  count(DISTINCT {PAGE_CANON}) AS urls FROM pages GROUP BY 2 HAVING count(DISTINCT {PAGE_CANON}) > 1"""
_UNESC = ("regexp_replace(replace(replace(replace({e}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), "
          "'&amp;?', '&', 'g')")
_CLEAN = "trim(" + _UNESC.format(e="regexp_replace(html, '<[^>]+>', '', 'g')") + ", e' \\n\\t\\r')"
ORACLE["html_snippets"] = f"SELECT page_id, {_CLEAN} AS clean, substring({_CLEAN}, 1, 400) AS snippet FROM pages"
_BODY = "html"
for _tag in ("script", "style", "noscript", "nav", "header", "footer", "aside", "figure", "figcaption", "form"):
    _BODY = f"regexp_replace({_BODY}, '(?is)<{_tag}\\b.*?</{_tag}>', ' ', 'g')"
_BODY = f"regexp_replace({_BODY}, '(?is)<(br|/p|/div|/li|/h[1-6]|/section|/article)\\s*/?>', chr(10), 'g')"
_BODY = _UNESC.format(e=f"regexp_replace({_BODY}, '<[^>]+>', ' ', 'g')")
_BODY = (f"trim(regexp_replace(regexp_replace({_BODY}, '\\n\\s*\\n+', chr(10), 'g'), '[ \\t]+', ' ', 'g'), "
         "e' \\n\\t\\r')")
ORACLE["html_page_text"] = (f"WITH t AS (SELECT page_id, {_BODY} AS text FROM pages) SELECT page_id, text, "
                            f"len(regexp_extract_all(text, {q(WORD)})) AS words FROM t")

_HOURS = "(epoch_us(now) - epoch_us(published_at)) / 3600000000.0"
_REC = f"CASE WHEN published_at IS NULL THEN 0.0 ELSE greatest(0.0, least(1.0, (36.0 - {_HOURS}) / 36.0)) END"
ORACLE["feed_times"] = f"""WITH {ITEMS_SQL} SELECT seq,
  strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published, round({_HOURS}, 6) AS hours_old,
  round({_REC}, 6) AS recency, {i(_HOURS + ' > 48')} AS stale, {i('published_at IS NOT NULL')} AS round_trip
  FROM items"""
_PUB = "trim(regexp_replace(source, '\\s*\\(.*?\\)\\s*$', ''))"
_FAM = "CASE lower(publisher) " + " ".join(
    f"WHEN {q(k)} THEN {q(v)}" for k, v in V.PUBLISHER_FAMILIES.items()) + " ELSE lower(publisher) END"
_RELIABLE = "(" + " OR ".join(f"contains(lower(source), {q(n)})" for n in V.RELIABLE_OUTLETS) + ")"
_BRAND = (f"list_filter(regexp_extract_all(lower(source), '[a-z]{{3,}}'), lambda w: NOT list_contains("
          f"{lst(V.KEYWORD_STOPWORDS)}, w))")
ORACLE["source_names"] = f"""WITH {ITEMS_SQL}, s AS (SELECT source, count(*) AS items, {_PUB} AS publisher
  FROM items GROUP BY source) SELECT source, items, publisher, {_FAM} AS family,
  trim(regexp_replace(lower(source), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
  coalesce(list_filter({_BRAND}, lambda w: length(w) = list_max(list_transform({_BRAND}, lambda x: length(x))))[1], '') AS brand,
  {i(_RELIABLE)} AS reliable FROM s"""


def tokens(e):
    return (f"list_sort(list_distinct(list_transform(list_filter(regexp_extract_all(lower({e}), '[a-z0-9]+'), "
            f"lambda w: length(w) > 2 AND NOT list_contains({lst(V.TITLE_STOPWORDS)}, w)), "
            f"lambda w: CASE WHEN w LIKE '%s' AND length(w) > 4 THEN left(w, length(w) - 1) ELSE w END)))")


def keywords(e):
    return (f"list_distinct(list_filter(regexp_extract_all(lower({e}), '[a-z0-9]{{4,}}'), "
            f"lambda w: NOT list_contains({lst(V.KEYWORD_STOPWORDS)}, w)))")


def headline_key(e):
    return f"trim(regexp_replace(lower({e}), '[^a-z0-9]+', ' ', 'g'))"


ORACLE["title_token_sets"] = f"SELECT doc_id, {bar(tokens('text'))} AS tokens FROM documents"
ORACLE["keyword_sets"] = (f"SELECT doc_id, {bar('list_sort(' + keywords('text') + ')')} AS keywords, "
                          f"md5({headline_key('text')}) AS headline_key_md5 FROM documents")
_WC = f"len(regexp_extract_all(text, {q(WORD)}))"
_MIN = f"CAST(greatest(1, round_even({_WC} / 200.0, 0)) AS INTEGER)"
_TRIM = "trim(text, e' \\n\\t\\r')"
ORACLE["reading_times"] = f"""SELECT doc_id, {_WC} AS words, {_MIN} AS minutes, {_MIN} AS parsed,
  CASE WHEN length({_TRIM}) <= 130 THEN {_TRIM} ELSE rtrim(substring({_TRIM}, 1, 129), e' \\n\\t\\r') || '…' END
  AS short FROM documents"""

_CAPTION = ["CAPTION_LEAD", "CAPTION_CUE", "CAPTION_SCENE", "CAPTION_VERB", "CAPTION_MEDIA"]
_META = ["METADATA_BIO", "METADATA_CAPTION", "STITCHED_QUOTE", "BIO_JOINED"]


def caption(e):
    return "(" + " OR ".join(rx(e, getattr(V, n)) for n in _CAPTION) + ")"


def metadata(e):
    return "(" + " OR ".join([rx(e, getattr(V, n)) for n in _META] + [rxc(e, V.BIO_YEARS_AT_CS)]) + ")"


def count_of(e, ch):
    return f"(length({e}) - length(replace({e}, {q(ch)}, '')))"


def roundup(e):
    return f"({rx(e, V.ROUNDUP_LINE)} OR {count_of(e, ';')} >= 2)"


_TITLES = "Mr|Mrs|Ms|Dr|Prof|Gen|Sen|Rep|Gov|St|Jr|Sr|vs|No|Inc|Ltd|Co|Corp"
_MASKED = (f"regexp_replace(regexp_replace(text, '\\b([A-Za-z]\\.[A-Za-z])\\.(\\s)', '\\1' || chr(57344) || '\\2', 'g'), "
           f"'\\b({_TITLES})\\.(\\s)', '\\1' || chr(57344) || '\\2', 'g')")
_SPLIT = f"string_split(regexp_replace(regexp_replace({_MASKED}, '([.!?])\\s+', '\\1' || chr(57345), 'g'), '\\n+', chr(57345), 'g'), chr(57345))"
_SENTENCES = f"""sent AS (SELECT doc_id, source, pos,
    regexp_replace(trim(regexp_replace(replace(raw, chr(57344), '.'), '\\s+', ' ', 'g')), '\\s+([,.;:!?])', '\\1', 'g') AS s
  FROM (SELECT doc_id, source, unnest({_SPLIT}) AS raw, generate_subscripts({_SPLIT}, 1) AS pos FROM documents)),
 kept AS (SELECT doc_id, s, min(pos) AS pos FROM (SELECT *, {fold('s')} AS f FROM sent)
  WHERE s <> '' AND len(string_split(s, ' ')) BETWEEN 6 AND 60 AND {rxc('s', '[.!?]["' + "')" + '”]?$')}
    AND {rxc('s', '[a-z]')} AND NOT {rxc('s', V.ELLIPSIS_END)}
    AND NOT ({' OR '.join(f'contains(lower(s), {q(b)})' for b in V.BOILERPLATE)})
    AND NOT {rx('f', V.BYLINE)} AND NOT {rx('f', V.AUTHOR_BIO)} AND NOT {rx('f', V.AFFILIATE)}
    AND NOT {rx('f', V.CREDIT_END)} AND NOT {caption('f')} AND NOT {metadata('f')}
    AND length(lower(s)) - length(replace(lower(s), regexp_extract(source, '[a-z]+'), '')) < 2 * 3
  GROUP BY doc_id, s)"""
ORACLE["clean_sentence_sets"] = f"""WITH {_SENTENCES} SELECT d.doc_id, count(k.s) AS sentences,
  md5(coalesce(string_agg(k.s, chr(10) ORDER BY k.pos), '')) AS digest
  FROM documents d LEFT JOIN kept k USING (doc_id) GROUP BY d.doc_id"""
ORACLE["ungrounded_titles"] = f"""WITH {ITEMS_SQL} SELECT seq, {bar(
    f"list_sort(list_filter(list_distinct(regexp_extract_all(title, {q(WORD)})), lambda t: (regexp_matches(t, '[0-9]') OR "
    f"regexp_matches(t, '^[A-Z][a-zA-Z]{{2,}}$')) AND NOT list_contains(list_transform(regexp_extract_all(body, {q(WORD)}), "
    f"lambda x: lower(x)), lower(t))))")} AS tokens FROM items"""
_WORDNUM = ", ".join(f"CASE WHEN {rx('f', chr(92) + 'b' + w + chr(92) + 'b')} THEN {q(n)} END"
                     for w, n in V.ENGLISH_NUMBERS.items())
ORACLE["stated_numbers"] = f"""WITH t AS (SELECT doc_id, text, lower({fold('text')}) AS f FROM documents)
  SELECT doc_id, {bar(f"list_sort(list_distinct(list_concat(regexp_extract_all(text, '[0-9]+'), list_filter([{_WORDNUM}], lambda x: x IS NOT NULL))))")}
  AS numbers FROM t"""
ORACLE["score_contract"] = """WITH t AS (SELECT event_id, round(value * CASE WHEN event_id % 5 = 0 THEN 100.0 ELSE 1.0 END
    - 20.0, 2) AS v FROM events)
  SELECT event_id, CASE WHEN abs(v) <= 1000 THEN regexp_replace(regexp_replace(CAST(CAST(v AS DECIMAL(12,6)) AS VARCHAR),
    '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '') END AS score_text,
    CASE WHEN abs(v) > 1000 THEN 'must be within [-1000, 1000]' END AS problem FROM t"""
ORACLE["json_member_checks"] = """SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'api_key' ELSE '' END AS forbidden,
  CAST(event_id % 50 = 0 AS INTEGER) AS local_path, 'id' AS missing,
  CASE WHEN event_id % 50 = 0 THEN 'Api_Key' ELSE '' END AS extra FROM events"""

_REQ = f"""req AS (SELECT event_id, user_id, ts,
    CAST(DATE '2026-07-20' + CAST(user_id % {DATES} AS INTEGER) AS DATE) AS edition_date,
    list_sort(list_filter([CASE WHEN user_id % 7 <> 1 THEN 'united_states' END,
      CASE WHEN user_id % 2 = 1 THEN 'japan' END, CASE WHEN user_id % 7 = 1 OR user_id % 3 = 0 THEN 'world' END],
      lambda x: x IS NOT NULL)) AS regions,
    list_sort(list_filter([{', '.join(f"CASE WHEN CAST(floor(user_id / {k + 2}) AS INTEGER) % 3 = 0 THEN {q(t)} END" for k, t in enumerate(V.SUPPORTED_TOPICS))}],
      lambda x: x IS NOT NULL)) AS topics FROM events)"""
ORACLE["mix_identities"] = f"""WITH {_REQ} SELECT event_id, {bar('regions', ',')} AS regions, {bar('topics', ',')} AS topics,
  'date=' || CAST(edition_date AS VARCHAR) || '|regions=' || {bar('regions', ',')} || '|topics=' || {bar('topics', ',')}
  || '|selector=3|size=5' AS mix_id, 0 AS unsupported FROM req"""
ORACLE["region_quotas"] = f"""WITH {_REQ}, g AS (SELECT {bar('regions', ',')} AS regions, count(*) AS requests FROM req GROUP BY 1)
  SELECT regions, CASE regions WHEN 'united_states' THEN 5 WHEN 'japan,united_states' THEN 3 WHEN 'united_states,world' THEN 3
      WHEN 'japan,united_states,world' THEN 3 ELSE 0 END AS united_states,
    CASE regions WHEN 'japan' THEN 5 WHEN 'japan,united_states' THEN 2 WHEN 'japan,world' THEN 3
      WHEN 'japan,united_states,world' THEN 1 ELSE 0 END AS japan,
    CASE regions WHEN 'world' THEN 5 WHEN 'united_states,world' THEN 2 WHEN 'japan,world' THEN 2
      WHEN 'japan,united_states,world' THEN 1 ELSE 0 END AS world, requests FROM g"""

# --- ingest ------------------------------------------------------------------------------------

from .inputs import CANON_SQL  # noqa: E402

_INGEST = ITEMS_SQL + f""", canon AS (SELECT *, CASE WHEN link = '' THEN '/' ELSE {CANON_SQL} END AS canonical_url FROM items),
 r1 AS (SELECT *, CASE WHEN link = '' OR title = '' THEN 'no-link'
    WHEN regexp_matches(canonical_url, '^[a-z]+://[^/]*/$') THEN 'homepage'
    WHEN {rx('link', V.INGEST_VIDEO_PATH)} THEN 'video' WHEN {_HOURS} > 36 THEN 'stale' END AS reason FROM canon),
 ing AS (SELECT *, CASE WHEN reason IS NOT NULL THEN reason WHEN row_number() OVER (PARTITION BY edition_date, canonical_url,
    reason IS NULL ORDER BY seq) > 1 THEN 'dup' ELSE 'kept' END AS final FROM r1)"""
ORACLE["ingest_reasons"] = f"WITH {_INGEST} SELECT seq, canonical_url, final AS reason FROM ing"
ORACLE["ingest_counts"] = f"WITH {_INGEST} SELECT {D}, final AS reason, count(*) AS n FROM ing GROUP BY ALL"
ORACLE["ingest_sources"] = f"WITH {CANDIDATES_SQL} SELECT {D}, source, count(*) AS candidates FROM candidates GROUP BY ALL"
ORACLE["cluster_outlets"] = f"""WITH {CANDIDATES_SQL} SELECT {D}, cluster_id, max(cluster_size) AS cluster_size,
  arg_min(title, seq) AS title, array_to_string(list_sort(list_distinct(list(string_split(source, ' ')[1]))), ', ') AS outlets
  FROM candidates WHERE cluster_size > 1 GROUP BY edition_date, cluster_id"""
ORACLE["cluster_sizes"] = f"WITH {CANDIDATES_SQL} SELECT seq, cluster_id, cluster_size, cluster_sources FROM candidates"
ORACLE["first_urls"] = f"""SELECT page_id, lower({net()}) AS host, CAST(row_number() OVER (PARTITION BY lower({net()})
  ORDER BY page_id) = 1 AS INTEGER) AS is_first FROM pages"""
_CP = pool_form("canonical_url")
_DROPS = f""", dr AS (SELECT *, {_CP} AS canon, CASE WHEN trim(title) = '' OR trim(snippet) = '' OR trim(source) = '' THEN 'empty_copy'
    WHEN {_CP} = '' THEN 'unusable_url' WHEN published_at IS NULL THEN 'invalid_timestamp' END AS reason FROM candidates),
 drops AS (SELECT *, CASE WHEN reason IS NOT NULL THEN reason WHEN row_number() OVER (PARTITION BY edition_date, canon,
   reason IS NULL ORDER BY seq) > 1 THEN 'duplicate_canonical' ELSE 'kept' END AS final FROM dr)"""
ORACLE["pool_source_drops"] = f"WITH {CANDIDATES_SQL}{_DROPS} SELECT seq, final AS reason FROM drops"


def _greedy(source: str) -> str:
    """Greedy leader clustering, one row of every date per step."""
    return f""", tk AS (SELECT edition_date, seq, {tokens('title')} AS tokens,
    row_number() OVER (PARTITION BY edition_date ORDER BY seq) AS rn FROM {source}),
 g AS (SELECT edition_date, rn, seq, seq AS leader, 0 AS shared, 0 AS total, [{{'s': seq, 't': tokens}}] AS leaders FROM tk WHERE rn = 1
  UNION ALL
  SELECT edition_date, rn, seq, coalesce(m.s, seq), coalesce(len(list_intersect(m.t, tokens)), 0),
    coalesce(len(list_distinct(list_concat(m.t, tokens))), 0),
    CASE WHEN m IS NULL THEN list_append(leaders, {{'s': seq, 't': tokens}}) ELSE leaders END
  FROM (SELECT t.edition_date, t.rn, t.seq, t.tokens, g.leaders, list_filter(g.leaders, lambda x: len(x.t) + len(t.tokens) > 0 AND
      10 * len(list_intersect(x.t, t.tokens)) >= 3 * len(list_distinct(list_concat(x.t, t.tokens))))[1] AS m
    FROM g JOIN tk t ON t.edition_date = g.edition_date AND t.rn = g.rn + 1)),
 cl AS (SELECT edition_date, seq, leader, shared, total FROM g)"""


ORACLE["similar_titles"] = (f"WITH RECURSIVE {ITEMS_SQL}{_greedy('items')} SELECT {D}, leader AS seed, seq AS member, "
                            "shared, total FROM cl WHERE leader <> seq")
_NUMBERED = """, num AS (SELECT edition_date, seq AS leader, row_number() OVER (PARTITION BY edition_date ORDER BY seq) - 1 AS cluster_id
  FROM cl WHERE leader = seq)"""
ORACLE["title_clusters"] = (f"WITH RECURSIVE {ITEMS_SQL}{_greedy('items')}{_NUMBERED} SELECT CAST(cl.edition_date AS VARCHAR) AS edition_date, "
                            "cl.seq, num.cluster_id FROM cl JOIN num USING (edition_date, leader)")
_CATS = "[" + ", ".join(q(s[1]) for s in V.SOURCES) + "]"
_RELS = "[" + ", ".join(q(V.STATUS_RELIABILITY[s[3]]) for s in V.SOURCES) + "]"
_SRCS = "[" + ", ".join(q(s[0]) for s in V.SOURCES) + "]"
ORACLE["ingest_job"] = f"""WITH RECURSIVE {_INGEST}, kept AS (SELECT * FROM ing WHERE final = 'kept'){_greedy('kept')}{_NUMBERED},
 full_ AS (SELECT k.edition_date, k.seq, {sha6('k.canonical_url')} AS id, {_PUB.replace('source', 'k.source')} AS publisher,
   {_CATS}[list_position({_SRCS}, k.source)] AS category, {_RELS}[list_position({_SRCS}, k.source)] AS source_reliability, n.cluster_id
   FROM kept k JOIN cl USING (edition_date, seq) JOIN num n ON n.edition_date = k.edition_date AND n.leader = cl.leader)
 SELECT CAST(f.edition_date AS VARCHAR) AS edition_date, seq, id, publisher, category, source_reliability, f.cluster_id,
   s.n AS cluster_size, s.p AS cluster_sources FROM full_ f JOIN (SELECT edition_date, cluster_id, count(*) AS n,
   count(DISTINCT publisher) AS p FROM full_ GROUP BY ALL) s USING (edition_date, cluster_id)"""

# --- scores ------------------------------------------------------------------------------------

_SN = "length(trim(snippet))"
_KIND = first("tf", V.EDITORIAL_KINDS, "''")
_SCORE = CANDIDATES_SQL + f""", f0 AS (SELECT *, {fold('title')} AS tf, {fold("title || ' ' || snippet")} AS bf,
    {fold('snippet')} AS sf, {_RELIABLE} AS reliable FROM candidates),
 f1 AS (SELECT *, {_KIND} AS kind, {rx('tf', V.IMPORTANCE)} AS important,
    ({rx('tf', V.LIVE_TITLE)} OR {rx(path(), V.LIVE_PATH)}) AS live,
    CASE WHEN paywalled THEN 5 ELSE 0 END + CASE WHEN reliable THEN 0 ELSE 1 END + CASE WHEN source_reliability = 'low' THEN 1 ELSE 0 END
      + CASE WHEN {_SN} < 60 THEN 3 WHEN {_SN} < 120 THEN 2 WHEN {_SN} < 140 THEN 1 ELSE 0 END AS source_risk,
    CASE category {' '.join(f'WHEN {q(k)} THEN {v}' for k, v in V.LEAD_WEIGHT.items())} ELSE 0 END AS cw,
    {_REC} AS rec, (NOT paywalled AND (reliable OR {_SN} >= 140)) AS complete,
    {real_url()} AS real_url, coalesce({_HOURS} > 48, false) AS stale, id = {sha6('canonical_url')} AS resolvable FROM f0),
 sc AS (SELECT *, 3.0::DOUBLE * least(cluster_size, 4) + CASE WHEN reliable THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END + 2.0::DOUBLE * rec
     + 1.5::DOUBLE * cw - CASE WHEN published_at IS NULL THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END - CASE WHEN live THEN 4.0::DOUBLE ELSE 0.0::DOUBLE END
     - 0.6::DOUBLE * source_risk - CASE WHEN kind <> '' THEN 6.0::DOUBLE ELSE 0.0::DOUBLE END
     + CASE WHEN important THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS base,
     (real_url AND NOT stale AND resolvable AND complete AND kind = '') AS eligible FROM f1)"""
ORACLE["base_scores"] = f"""WITH {_SCORE} SELECT seq, round(base, 6) AS base_score, round(base + 1.5::DOUBLE * cw, 6) AS lead_score,
  source_risk, kind, {i('live')} AS live, {i('important')} AS important, {i('complete')} AS complete, {i('eligible')} AS eligible FROM sc"""
ORACLE["best_of_clusters"] = f"""WITH {_SCORE} SELECT {D}, cluster_id, seq FROM (SELECT *, row_number() OVER (PARTITION BY
  edition_date, cluster_id ORDER BY base DESC, seq) AS rn FROM sc) WHERE rn = 1"""
ORACLE["lead_picks"] = f"""WITH {_SCORE} SELECT {D}, id, seq FROM (SELECT *, row_number() OVER (PARTITION BY edition_date
  ORDER BY base + 1.5::DOUBLE * cw DESC, id, seq) AS rn FROM sc WHERE eligible AND cw > 0 AND (cluster_size >= 2 OR reliable)) WHERE rn = 1"""
_EXCL = (f"CASE WHEN NOT real_url THEN 'invalid_article_url' WHEN stale THEN 'stale' WHEN id <> {sha6(_CP)} THEN "
         "'unresolvable_candidate_id' WHEN NOT complete THEN 'thin_or_paywalled_source' WHEN kind <> '' THEN "
         "'editorial_exclusion:' || kind END")
ORACLE["pool_exclusions"] = f"WITH {_SCORE} SELECT seq, coalesce({_EXCL}, 'kept') AS reason FROM sc"

# --- classification ----------------------------------------------------------------------------

_CTOP = "CASE category " + " ".join(f"WHEN {q(k)} THEN {lst(v)}" for k, v in V.CATEGORY_TOPICS.items()) + " ELSE [] END"
_TOPICS = f"list_sort(list_distinct(list_concat({_CTOP}, {labels('bf', V.TEXT_TOPICS)})))"
_FP = labels("bf", V.FINGERPRINT)
ORACLE["topic_fingerprints"] = f"WITH {_SCORE} SELECT seq, {bar(_FP)} AS fingerprint, {bar(_TOPICS)} AS topics FROM sc"


def _meta(source, extra="", launch_extra=""):
    fam = "CASE " + " ".join(
        f"WHEN {rx('bf', p)}{' AND NOT ' + rx('bf', V.CRISIS) if n == 'science_discovery' else ''} THEN {q(n)}"
        for n, p in V.EVENT_FAMILIES) + " ELSE 'other' END"
    return f""", m1 AS (SELECT *, (NOT {rx('bf', V.LAUNCH_EXCLUDE)} AND NOT {rx('tf', V.ACCESSORY)} AND {rx('tf', V.LAUNCH_VERB)}
     AND {rx('bf', V.CONSUMER_PRODUCT)}{launch_extra}) AS launch FROM {source}),
 m2 AS (SELECT *, {first('bf', [(p, c + '|' + r) for r, c, p in V.COUNTRIES])} AS cr,
   CASE WHEN launch THEN 'consumer_launch' ELSE {fam} END AS event_family FROM m1),
 meta AS (SELECT *, split_part(cr, '|', 1) AS country, split_part(cr, '|', 2) AS region,
   CASE WHEN event_family = 'conflict' THEN 'negative_conflict'
     WHEN event_family = 'disaster' OR ({rx('bf', V.CRISIS)} AND event_family NOT IN ('science_discovery', 'health_breakthrough', 'consumer_launch')) THEN 'negative_crisis'
     WHEN event_family IN ('science_discovery', 'health_breakthrough') THEN 'discovery'
     WHEN event_family = 'consumer_launch' OR {rx('bf', V.FORWARD)} THEN 'forward_looking' ELSE 'neutral' END AS tone FROM m2)"""


_META = _meta("sc", launch_extra=f" AND source_reliability <> 'low' AND coalesce({_HOURS} <= 72, true)")
_DISC = "event_family IN ('science_discovery', 'health_breakthrough')"
ORACLE["story_metadata"] = f"""WITH {_SCORE}{_META} SELECT seq, country, region, event_family, tone, {i('launch')} AS launch,
  {i(_DISC)} AS discovery FROM meta"""
_SID = f""", i1 AS (SELECT *, {first('bf', V.BRANDS)} AS brand, {first('bf', V.PRODUCT_FAMILIES)} AS family,
   {labels('bf', V.PRODUCT_FAMILIES)} AS fams, {first('bf', V.LAUNCH_EVENTS)} AS event FROM meta),
 sid AS (SELECT *, list_filter(fams, lambda f: len(list_filter(fams, lambda g: g <> f AND starts_with(g, f || ' '))) = 0) AS covers,
   {rx('tf', V.ROUNDUP_TITLE)} AS roundup, ((launch OR family IS NOT NULL OR event IS NOT NULL)
   AND event_family IN ('consumer_launch', 'other')) AS product FROM i1)"""
_HAS = "brand IS NOT NULL AND "
ORACLE["story_identities"] = f"""WITH {_SCORE}{_META}{_SID} SELECT seq, brand, CASE WHEN brand IS NOT NULL THEN family END AS family,
  CASE WHEN brand IS NOT NULL THEN array_to_string(covers, '|') END AS covers, CASE WHEN brand IS NOT NULL THEN event END AS event,
  {i(_HAS + 'roundup')} AS roundup, {i(_HAS + 'product')} AS product FROM sid"""


def _evidence(region, e, field):
    return "list_filter([" + ", ".join(f"CASE WHEN {rx(e, p)} THEN {q(n + ':' + field)} END"
                                       for n, p in V.REGION_RULES[region]) + "], lambda x: x IS NOT NULL)"


def _member(region):
    t, s = _evidence(region, "tf", "title"), _evidence(region, "sf", "summary")
    given = "(seq // 10) % 16 = 5" if region == "united_states" else "false"
    only = ("({t} = ['japanese:title'] AND " + rx("tf", V.REGION_COMPANIES) + " AND len({s}) = 0)").format(t=t, s=s) if region == "japan" else "false"
    return (f"SELECT seq, {q(region)} AS region, CASE WHEN {given} THEN 'primary' WHEN {only} THEN 'incidental' WHEN len({t}) > 0 OR len({s}) >= 2 "
            f"THEN 'primary' WHEN len({s}) > 0 THEN 'incidental' ELSE 'none' END AS strength, CASE WHEN {given} THEN {q(region + ':structured')} "
            f"ELSE {bar(f'list_concat({t}, {s})')} END AS evidence FROM sc")


ORACLE["region_memberships"] = f"WITH {_SCORE} " + " UNION ALL ".join(_member(r) for r in V.SUPPORTED_REGIONS)
_TS = "[" + ", ".join("{'k': " + " + ".join(
    f"CASE WHEN {rxc('lower(tf)', chr(92) + 'b' + w + chr(92) + 'b')} THEN -2 ELSE 0 END + CASE WHEN {rxc('lower(sf)', chr(92) + 'b' + w + chr(92) + 'b')} THEN -1 ELSE 0 END"
    for w in ws) + f", 't': {q(t)}}}" for t, ws in TOPIC_KEYWORDS.items()) + "]"
ORACLE["image_topics"] = f"""WITH {_SCORE}, t AS (SELECT seq, list_sort(list_filter({_TS}, lambda x: x.k < 0))[1] AS b FROM sc)
  SELECT seq, b.t AS topic, coalesce(-b.k, 0) AS topic_score FROM t"""

# --- verbatim copies ---------------------------------------------------------------------------

_EDGE = "[。．！？!?\\n 　]+"
_MIN = V.JA_PASTE_MIN
ORACLE["paste_detection"] = f"""WITH RECURSIVE f AS (SELECT conv_id, arg_min(text, turn) AS source FROM conversations
   WHERE turn <= 1 GROUP BY conv_id),
 l AS (SELECT conv_id, turn, text AS line, source, CASE WHEN length(text) >= {_MIN} AND length(source) >= {_MIN} THEN
     list_filter(range(1, length(text) - {_MIN - 2}), lambda i: contains(source, substring(text, i, {_MIN}))) ELSE [] END AS hits
   FROM conversations JOIN f USING (conv_id)),
 w AS (SELECT conv_id, turn, 0 AS n, 1 AS pos, '' AS run FROM l
   UNION ALL SELECT conv_id, turn, n + 1, fit + size, CASE WHEN n = 0 THEN substring(line, fit, size) ELSE run END FROM (
     SELECT *, list_max(list_filter(range({_MIN}, length(line) - fit + 2), lambda k: contains(source, substring(line, fit, k)))) AS size FROM (
       SELECT w.*, l.line, l.source, list_min(list_filter(l.hits, lambda x: x >= w.pos)) AS fit FROM w JOIN l USING (conv_id, turn))
     WHERE fit IS NOT NULL)),
 r AS (SELECT conv_id, turn, max(n) AS n_runs, regexp_replace(arg_max(run, n), '^{_EDGE}|{_EDGE}$', '', 'g') AS run FROM w GROUP BY ALL)
 SELECT conv_id, turn, n_runs, CASE WHEN n_runs >= 2 OR (n_runs = 1 AND length(run) >= {_MIN} AND len(list_filter(
     string_split_regex(source, '[。．！？!?\\n]'), lambda s: length(trim(s)) >= {_MIN} AND contains(trim(s), run)
       AND length(run) / length(trim(s)) >= {V.JA_SENTENCE_COPY_RATIO})) > 0) THEN 1 ELSE 0 END AS pasted
   FROM r JOIN l USING (conv_id, turn)"""

# --- duplicates --------------------------------------------------------------------------------

_SIG = f"""{_SCORE}{_META}{_SID}, fpt AS (SELECT *, {_FP} AS fp FROM sid),
 sig AS (SELECT edition_date, fp, brand, family, covers, event, event_family, roundup, product, min(seq) AS seq FROM (
   SELECT edition_date, seq, fp, brand, CASE WHEN brand IS NOT NULL THEN family END AS family,
     CASE WHEN brand IS NOT NULL THEN covers END AS covers, CASE WHEN brand IS NOT NULL THEN event END AS event,
     CASE WHEN brand IS NOT NULL THEN event_family END AS event_family, CASE WHEN brand IS NOT NULL THEN roundup END AS roundup,
     CASE WHEN brand IS NOT NULL THEN product END AS product FROM fpt) GROUP BY ALL)"""


def _rel(a, b):
    return f"coalesce({a} = {b} OR starts_with({a}, {b} || ' ') OR starts_with({b}, {a} || ' '), false)"


def same_rule(a, b):
    def covers(x, o):
        return (f"({x}.roundup AND {o}.family IS NOT NULL AND len(list_filter({x}.covers, lambda f: {_rel(o + '.family', 'f')})) > 0)")
    return f"""CASE WHEN {a}.brand IS NULL OR {b}.brand IS NULL OR {a}.brand <> {b}.brand OR NOT ({a}.product AND {b}.product) THEN NULL
   WHEN coalesce({a}.event = {b}.event, false) THEN 'same-launch-event' WHEN {_rel(a + '.family', b + '.family')} THEN 'same-product-family'
   WHEN {covers(a, b)} OR {covers(b, a)} THEN 'roundup-covers-family' WHEN {a}.family IS NOT NULL AND {b}.family IS NOT NULL THEN NULL
   WHEN {a}.roundup OR {b}.roundup THEN 'roundup-contains-broad' WHEN {a}.family IS NULL AND {b}.family IS NULL THEN 'brand-product-news-no-line' END"""


_SH = "list_intersect(a.fp, b.fp)"
_UN = "len(list_distinct(list_concat(a.fp, b.fp)))"
_OV = (f"(len(a.fp) > 0 AND len(b.fp) > 0 AND (len(list_intersect({_SH}, {lst(V.FINGERPRINT_ENTITIES)})) >= 2 OR "
       f"(len(list_intersect({_SH}, {lst(V.FINGERPRINT_ENTITIES)})) >= 1 AND len(list_intersect({_SH}, {lst(V.FINGERPRINT_THEMES)})) >= 1 "
       f"AND 2 * len({_SH}) >= {_UN}) OR 10 * len({_SH}) >= 6 * {_UN}))")
ORACLE["duplicate_signatures"] = f"""WITH {_SIG}, p AS (SELECT a.edition_date, a.seq AS src, b.seq AS dst, CASE WHEN {_OV} THEN 'topic-fingerprint'
   ELSE {same_rule('a', 'b')} END AS rule FROM sig a JOIN sig b ON a.edition_date = b.edition_date AND a.seq < b.seq)
 SELECT {D}, src, dst, rule FROM p WHERE rule IS NOT NULL"""
ORACLE["first_duplicates"] = f"""WITH {_SIG}, p AS (SELECT a.edition_date, a.seq AS src, b.seq AS dst FROM sig a JOIN sig b
   ON a.edition_date = b.edition_date AND a.seq < b.seq WHERE {_OV}),
 r AS (SELECT *, row_number() OVER (PARTITION BY edition_date ORDER BY src, dst) AS rn FROM p) SELECT {D}, src, dst FROM r WHERE rn = 1"""

# --- history -----------------------------------------------------------------------------------



def sliced(size):
    """Candidates cut into days of ``size``, each next one some days earlier; ``n`` numbers a day's rows."""
    return (f"(SELECT * REPLACE (CAST(edition_date - CAST({DATES} * (rn // {size}) AS INTEGER) AS DATE) AS edition_date), "
            f"rn % {size} + 1 AS n FROM (SELECT *, row_number() OVER (PARTITION BY edition_date ORDER BY seq) - 1 AS rn FROM candidates))")


_ED = f""", ed AS (SELECT CAST(edition_date - 1 AS DATE) AS edition_date, n AS number, category, source, title AS headline, snippet AS summary,
   url AS originalURL, canonical_url, paywalled, seq, 'https://img.example.com/' || (seq % 7) || '.jpg' AS imageURL FROM {sliced(5)}),
 dts AS (SELECT DISTINCT edition_date AS d FROM candidates), eds AS (SELECT DISTINCT edition_date AS d FROM ed),
 rec AS (SELECT dts.d AS edition_date, eds.d AS prior_date, row_number() OVER (PARTITION BY dts.d ORDER BY eds.d DESC) AS rank
   FROM dts JOIN eds ON eds.d < dts.d)"""
ORACLE["recent_edition_dates"] = (f"WITH {CANDIDATES_SQL}{_ED} SELECT {D}, CAST(prior_date AS VARCHAR) AS prior_date, rank AS edition_rank "
                                  "FROM rec WHERE rank <= 7")
_EDF = f""", edf AS (SELECT *, {fold('headline')} AS tf, {fold("headline || ' ' || summary")} AS bf FROM ed)"""
_HIST = f"""{CANDIDATES_SQL}{_ED}{_EDF}{_meta('edf')}, told AS (SELECT DISTINCT edition_date AS prior_date, country, event_family FROM meta
   WHERE country IS NOT NULL AND event_family <> 'other'),
 hit AS (SELECT r.edition_date, country, event_family, rank, prior_date, row_number() OVER (PARTITION BY r.edition_date, country,
   event_family ORDER BY rank) AS rn FROM rec r JOIN told USING (prior_date) WHERE rank <= 3)"""
ORACLE["history_runs"] = f"""WITH {_HIST} SELECT {D}, country, event_family, count(*) AS run,
  string_agg(CAST(prior_date AS VARCHAR), '|' ORDER BY rank) AS dates FROM hit WHERE rank = rn GROUP BY edition_date, country, event_family"""


def story_key(u):
    return f"regexp_replace(lower({net(u)}), '^www\\.', '') || rtrim({path(u)}, '/')"


_RPT = f"""{_SCORE}{_META}{_SID}, cs AS (SELECT * FROM sid){_ED}{_EDF}""" + (
    _meta("edf").replace("m1 AS", "n1 AS").replace("FROM m1", "FROM n1").replace("m2 AS", "n2 AS").replace("FROM m2", "FROM n2")
    .replace("meta AS", "nmeta AS")) + (
    _SID.replace("i1 AS", "j1 AS").replace("FROM i1", "FROM j1").replace("FROM meta", "FROM nmeta").replace("sid AS", "nsid AS")) + f""",
 hitr AS (SELECT c.seq, r.rank, p.number, r.prior_date, CASE
     WHEN rtrim({path('c.canonical_url')}, '/') <> '' AND {story_key('c.canonical_url')} = {story_key('lower(p.originalURL)')} THEN 'recent-exact-url'
     WHEN {headline_key('c.title')} <> '' AND {headline_key('c.title')} = {headline_key('p.headline')} THEN 'recent-exact-headline'
     WHEN r.rank <= 3 THEN 'recent-' || {same_rule('c', 'p')} END AS rule
   FROM cs c JOIN rec r ON r.edition_date = c.edition_date AND r.rank <= 7 JOIN nsid p ON p.edition_date = r.prior_date),
 best AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY rank, number) AS rn FROM hitr WHERE rule IS NOT NULL)"""
ORACLE["recent_repeats"] = f"""WITH {_RPT} SELECT c.seq, coalesce(b.rule, '') AS rule, coalesce(CAST(b.prior_date AS VARCHAR), '') AS prior_date
  FROM candidates c LEFT JOIN best b ON b.seq = c.seq AND b.rn = 1"""
ORACLE["image_cooldowns"] = f"""WITH {CANDIDATES_SQL}{_ED} SELECT DISTINCT CAST(r.edition_date AS VARCHAR) AS edition_date, imageURL FROM rec r
  JOIN ed ON ed.edition_date = r.prior_date WHERE rank <= 4"""
ORACLE["image_reuse"] = f"""WITH {CANDIDATES_SQL}{_ED}, top AS (SELECT max(edition_date) AS d FROM ed),
  last AS (SELECT DISTINCT edition_date FROM ed, top WHERE edition_date < d ORDER BY edition_date DESC LIMIT 90)
  SELECT CAST(edition_date AS VARCHAR) AS key, 'signal ' || number AS field, 'reuses an imageURL from the last 90 editions: ' || imageURL AS message
  FROM ed, top WHERE edition_date = d AND imageURL IN (SELECT imageURL FROM ed JOIN last USING (edition_date))"""

# --- editions ----------------------------------------------------------------------------------

ORACLE["diversity_report"] = f"""WITH {CANDIDATES_SQL}{_ED}{_EDF}{_meta('edf')}, c1 AS (SELECT edition_date, country, count(*) AS n FROM meta
   WHERE country IS NOT NULL GROUP BY ALL), c2 AS (SELECT edition_date, max(n) AS m FROM c1 GROUP BY ALL),
 a AS (SELECT edition_date, count(DISTINCT category) AS categories, count(DISTINCT region) AS regions,
   count(*) FILTER (tone IN ('negative_conflict', 'negative_crisis')) AS conflict,
   count(*) FILTER (tone IN ('forward_looking', 'discovery')) AS forward FROM meta GROUP BY ALL)
 SELECT {D}, categories, regions, coalesce(m, 0) AS per_country, conflict, forward, {i('categories >= 3')} AS met_categories,
   {i('regions >= 3')} AS met_regions, {i('coalesce(m, 0) <= 1')} AS met_countries, {i('conflict <= 2')} AS met_conflict,
   {i('forward >= 1')} AS met_forward FROM a LEFT JOIN c2 USING (edition_date)"""
_EXID = f", ex AS (SELECT DISTINCT CAST(edition_date + 1 AS DATE) AS d, {sha6('canonical_url')} AS x FROM ed)"
_ISX = "EXISTS (SELECT 1 FROM ex WHERE ex.d = c.edition_date AND ex.x = c.id)"
ORACLE["excluded_candidates"] = f"WITH {CANDIDATES_SQL}{_ED}{_EXID} SELECT {D}, seq, id FROM candidates c WHERE {_ISX}"
ORACLE["kept_candidates"] = f"WITH {CANDIDATES_SQL}{_ED}{_EXID} SELECT {D}, count(*) AS kept FROM candidates c WHERE NOT {_ISX} GROUP BY ALL"
_SEL = f"""{CANDIDATES_SQL}, days AS {sliced(8)},
 sel AS (SELECT edition_date, n AS number, CASE WHEN seq % 9 = 4 THEN 'unseen' ELSE id END AS id FROM days WHERE n <= 5),
 rs AS (SELECT s.edition_date, s.number, s.id, c.seq, c.url, c.paywalled, c.category FROM sel s LEFT JOIN days c
   ON c.edition_date = s.edition_date AND c.id = s.id),
 gr AS (SELECT edition_date, count(*) FILTER (number = 1) AS leads, count(*) FILTER (number <> 1) AS others, count(DISTINCT id) AS ids,
   count(DISTINCT category) AS cats FROM rs GROUP BY ALL)"""
_KEY = "CAST(edition_date AS VARCHAR) AS key"
ORACLE["manual_selection"] = f"""WITH {_SEL}
 SELECT {_KEY}, 'unknown-id' AS rule, id AS field, 'is not among the candidates' AS message FROM rs WHERE seq IS NULL
 UNION ALL SELECT {_KEY}, 'no-article-url', id, 'has no real https article URL' FROM rs WHERE seq IS NOT NULL AND NOT
   ({scheme()} = 'https' AND rtrim({path()}, '/') <> '')
 UNION ALL SELECT {_KEY}, 'warn-paywalled', id, 'paywalled pick' FROM rs WHERE paywalled
 UNION ALL SELECT {_KEY}, 'no-lead', 'lead', 'no lead id set' FROM gr WHERE leads = 0
 UNION ALL SELECT {_KEY}, 'supporting-count', 'supporting', 'must list exactly 4 ids (found ' || others || ')' FROM gr WHERE others <> 4
 UNION ALL SELECT {_KEY}, 'distinct-ids', 'ids', 'need exactly 5 distinct ids; got ' || ids FROM gr WHERE ids <> 5
 UNION ALL SELECT {_KEY}, 'warn-coverage', 'category', 'thin category coverage' FROM gr WHERE cats <= 2"""
ORACLE["review_board"] = f"""WITH {CANDIDATES_SQL}, h AS (SELECT edition_date, cluster_id, arg_min(title, seq) AS head FROM candidates
   WHERE cluster_size > 1 GROUP BY ALL) SELECT CAST(c.edition_date AS VARCHAR) AS edition_date, CASE WHEN cluster_size > 1 THEN 1 ELSE 2 END AS section,
   CASE WHEN cluster_size > 1 THEN head ELSE category END AS k2, CASE WHEN cluster_size > 1 THEN source ELSE '' END AS k3, seq, cluster_size
   FROM candidates c LEFT JOIN h USING (edition_date, cluster_id)"""

# --- pools -------------------------------------------------------------------------------------

_POOLED = CANDIDATES_SQL + _DROPS + ", kept0 AS (SELECT * EXCLUDE (canonical_url, reason, final), canon AS canonical_url FROM drops WHERE final = 'kept')" + (
    _SCORE[len(CANDIDATES_SQL):].replace("FROM candidates)", "FROM kept0)")) + f""",
 pool AS (SELECT *, {_TOPICS} AS topics, {_FP} AS fp, CASE WHEN cluster_size > 1 THEN 'cluster:' || cluster_id ELSE 'url:' ||
   substring(sha256(canonical_url), 1, 24) END AS identity FROM sc WHERE {_EXCL} IS NULL)"""

def _membership_json(region):
    t, s = _evidence(region, "tf", "title"), _evidence(region, "sf", "summary")
    given = "(seq // 10) % 16 = 5" if region == "united_states" else "false"
    only = (f"({t} = ['japanese:title'] AND {rx('tf', V.REGION_COMPANIES)} AND len({s}) = 0)"
            if region == "japan" else "false")
    strength = (f"CASE WHEN {given} THEN 'primary' WHEN {only} THEN 'incidental' WHEN len({t}) > 0 OR len({s}) >= 2 "
                f"THEN 'primary' WHEN len({s}) > 0 THEN 'incidental' ELSE 'none' END")
    return ("'{\"evidence\":' || CAST(to_json(CASE WHEN " + given + " THEN [" + q(region + ":structured")
            + f"] ELSE list_sort(list_concat({t}, {s})) END) AS VARCHAR) || ',\"id\":\"{region}\",\"strength\":\"' || "
            + strength + " || '\"}'")


def _j(name, e):
    return f"""',"{name}":' || CAST(to_json({e}) AS VARCHAR)"""


_SCORE_TEXT = ("regexp_replace(regexp_replace(CAST(CAST(round(base, 6) AS DECIMAL(12,6)) AS VARCHAR), "
               "'(\\.[0-9]*?)0+$', '\\1'), '\\.$', '')")
_JSON = " || ".join([
    f"""'{{"baseScore":' || {_SCORE_TEXT}""", _j("category", "category"), """',"eligible":true'""",
    _j("headline", "title"), _j("id", "id"), _j("publishedAt", "strftime(published_at, '%Y-%m-%dT%H:%M:%SZ')"),
    """',"quality":{"clusterSize":' || cluster_size || ',"clusterSources":' || cluster_sources || """
    """',"eligible":true,"paywalled":' || CAST(paywalled AS VARCHAR) || ',"sourceRisk":' || source_risk || '}'""",
    "',\"regionMemberships\":[' || " + " || ',' || ".join(_membership_json(r) for r in V.SUPPORTED_REGIONS) + " || ']'",
    _j("source", "source"), _j("sourceReliability", "source_reliability"), _j("summary", "trim(snippet)"),
    _j("topicFingerprint", "fp"), _j("topics", "topics"), _j("underlyingStoryIdentity", "identity"),
    _j("url", "canonical_url"), "'}'"])
_FROZEN = f"{_POOLED}, fz AS (SELECT edition_date, id, canonical_url, identity, round(base, 6) AS score, {_JSON} AS json FROM pool)"
ORACLE["frozen_pool"] = (f"WITH {_FROZEN} SELECT {D}, id, md5(json) AS digest, canonical_url AS url, identity, score FROM fz")
ORACLE["pool_identities"] = f"""WITH {_FROZEN} SELECT {D}, count(*) AS rows, CAST(sum(strlen(json)) + count(*) + 1 AS BIGINT) AS bytes,
  sha256('[' || string_agg(json, ',' ORDER BY id, json) || ']') AS pool_identity FROM fz GROUP BY edition_date"""
ORACLE["mix_eligibility"] = f"""WITH {_POOLED}, mem AS ({" UNION ALL ".join(_member(r) for r in ("japan", "world"))}),
 jw AS (SELECT seq, max(CAST(strength = 'primary' AS INTEGER)) AS p FROM mem GROUP BY seq),
 a AS (SELECT *, CASE WHEN seq % 19 = 0 THEN '' ELSE source END AS src,
   (epoch_us(CAST(edition_date AS TIMESTAMP) + INTERVAL 86399 SECOND) - epoch_us(published_at)) / 3600000000.0 AS age FROM pool)
 SELECT a.seq, CASE WHEN source_reliability = 'low' THEN 'low source reliability' WHEN id = '' OR title = '' OR src = '' THEN 'missing required field'
   WHEN age > 72 OR age < -24 THEN 'outside 72-hour freshness window' ELSE 'eligible' END AS reason,
   {i("len(list_filter(" + _CTOP + ", lambda x: x NOT IN ('tech', 'business'))) = 0")} AS tech_business, jw.p AS japan_world FROM a JOIN jw USING (seq)"""
ORACLE["pool_admission"] = """WITH e AS (SELECT event_id, user_id AS u, (epoch_us(TIMESTAMP '2024-01-20 00:00:00') - epoch_us(ts)) / 60000000.0 AS age FROM events)
 SELECT event_id, CASE WHEN u % 13 = 0 THEN 'candidate_pool_version_incompatible' WHEN u % 11 = 0 THEN 'candidate_pool_schema_invalid'
   WHEN u % 17 = 0 THEN 'candidate_pool_identity_mismatch' WHEN u % 10 = 0 THEN 'candidate_pool_date_mismatch' WHEN u % 25 < 15 THEN 'candidate_pool_empty'
   WHEN u % 25 > 20 THEN 'candidate_pool_schema_invalid' WHEN age < -10 THEN 'candidate_pool_future_timestamp'
   WHEN age > 8 * 1440 THEN 'candidate_pool_stale' ELSE 'admitted' END AS refusal FROM e"""

# --- drafts and checks -------------------------------------------------------------------------

ORACLE["source_texts"] = f"""WITH {CANDIDATES_SQL}, art AS (SELECT id, arg_min(body, seq) AS text FROM candidates GROUP BY id),
 gone AS (SELECT DISTINCT id FROM candidates WHERE category = 'HEALTH'), skip AS (SELECT DISTINCT id FROM candidates WHERE category = 'CULTURE'),
 r AS (SELECT c.seq, CASE WHEN c.id IN (SELECT id FROM gone) THEN 'none' WHEN c.id NOT IN (SELECT id FROM skip) AND trim(a.text, e' \\n\\t\\r') <> ''
   THEN 'full_article' WHEN trim(snippet) <> '' THEN 'rss_snippet' ELSE 'none' END AS used, trim(a.text, e' \\n\\t\\r') AS t, trim(snippet) AS s
   FROM candidates c JOIN art a USING (id))
 SELECT seq, used AS source_text_used, CASE used WHEN 'full_article' THEN length(t) WHEN 'rss_snippet' THEN length(s) ELSE 0 END AS chars FROM r"""


def _publish(e, f):
    return [(rxc(f, V.COMPOUND_DANGLE_CS), "dangling compound ending (e.g. 'between the U.S.')"),
            (rxc(f, V.ABBREVIATION_END_CS), "ends at an abbreviation (split fragment)"),
            (rx(f, V.CAPTION_MEDIA), "photo/video credit caption text"),
            (f"({rx(f, V.BIO_JOINED)} OR {rxc(f, V.BIO_YEARS_AT_CS)})", "author-bio text"),
            (rx(f, V.CONNECTIVE_OPEN), "starts with a context-free connective (e.g. 'And,')"),
            (roundup(f), "newsletter/roundup table-of-contents line"),
            (rxc(e, "\\s[,.;:!?]"), "whitespace before punctuation (scrape artifact)")]


_FIELDS = """fields AS (SELECT edition_date, number, field, trim(v) AS v FROM (
   SELECT edition_date, number, 'summary' AS field, summary AS v FROM ed UNION ALL SELECT edition_date, number, 'whyItMatters', summary FROM ed
   UNION ALL SELECT edition_date, number, 'keyTakeaways[0]', headline FROM ed UNION ALL SELECT edition_date, number, 'keyTakeaways[1]', summary FROM ed))"""
_GLUE = f"{headline_key('headline')} <> '' AND {headline_key('summary')} <> {headline_key('headline')} AND starts_with({headline_key('summary')}, {headline_key('headline')} || ' ')"


def prose_gate(editions):
    """Prose rules and the glued headline, both only since the gate exists."""
    return f"""WITH {CANDIDATES_SQL}{editions}, {_FIELDS}, ff AS (SELECT *, {fold('v')} AS f FROM fields WHERE v <> '' AND edition_date >= DATE '2026-07-11') """ + " UNION ALL ".join(
        f"SELECT {_KEY}, 'prose' AS rule, 'signal ' || number || ' ' || field AS field, {q(m)} AS message FROM ff WHERE {c}" for c, m in _publish("v", "f")) + (
        f" UNION ALL SELECT {_KEY}, 'prose', 'signal ' || number || ' summary', 'begins with the headline glued to body text' FROM ed WHERE edition_date >= DATE '2026-07-11' AND {_GLUE}")


ORACLE["prose_gate"] = prose_gate(_ED)
ORACLE["prose_gate_later"] = prose_gate(_ED.replace("ed AS (SELECT CAST(edition_date - 1 AS DATE)", "ed AS (SELECT CAST(DATE '2026-08-20' + CAST(DATE '2026-08-20' - edition_date + 1 AS INTEGER) AS DATE)"))
_TIER = "CASE WHEN number = 2 THEN 9 ELSE number END"
ORACLE["edition_structure"] = f"""WITH {CANDIDATES_SQL}{_ED}, n AS (SELECT edition_date, count(*) AS n FROM ed GROUP BY ALL)
 SELECT {_KEY}, 'importance' AS rule, 'signal ' || number AS field, 'importance not in 1..5' AS message FROM ed WHERE {_TIER} > 5
 UNION ALL SELECT {_KEY}, 'summary', 'signal ' || number, 'has an empty/missing summary' FROM ed WHERE trim(summary) = ''
 UNION ALL SELECT {_KEY}, 'url', 'signal ' || number, 'originalURL not https' FROM ed WHERE NOT {scheme('originalURL')} = 'https'
 UNION ALL SELECT {_KEY}, 'url', 'signal ' || number, 'originalURL is a homepage, not an article' FROM ed WHERE {scheme('originalURL')} = 'https'
   AND rtrim({path('originalURL')}, '/') = ''
 UNION ALL SELECT {_KEY}, 'count', 'signals', 'expected 5 signals, found ' || n FROM n WHERE n <> 5"""
ORACLE["feed_schema"] = f"""WITH {CANDIDATES_SQL}{_ED}, n AS (SELECT edition_date, count(*) AS n FROM ed GROUP BY ALL)
 SELECT {_KEY}, 'takeaways' AS rule, 'signal ' || number AS field, 'keyTakeaways must have exactly 3 items' AS message FROM ed
 UNION ALL SELECT {_KEY}, 'count', 'signals', 'signals must contain exactly 5 items' FROM n WHERE n <> 5"""
_BADF = "number = dayofmonth(edition_date) % 7"
ORACLE["listen_readiness"] = f"""WITH {CANDIDATES_SQL}{_ED}, n AS (SELECT edition_date, count(*) AS n FROM ed GROUP BY ALL)
 SELECT {_KEY}, 'listen-ready' AS rule, 'signal ' || number AS field, 'listen.en.audioURL is not in this edition''s audio folder' AS message FROM ed WHERE {_BADF}
 UNION ALL SELECT {_KEY}, 'listen-ready', 'signals', 'a promoted pointer must have 5 signals, found ' || n FROM n WHERE n <> 5"""
ORACLE["served_edition"] = f"""WITH {CANDIDATES_SQL}{_ED}, ok AS (SELECT edition_date FROM ed GROUP BY edition_date HAVING count(*) = 5 AND
   count(*) FILTER ({_BADF}) = 0) SELECT {D}, number FROM ed WHERE edition_date = (SELECT max(edition_date) FROM ok)"""
ORACLE["request_codes"] = """SELECT event_id, CASE WHEN user_id % 13 = 0 THEN 'unsupported_selector_version' WHEN user_id % 40 = 0 OR user_id % 40 > 31
   THEN 'invalid_request' WHEN user_id % 7 IN (0, 1) THEN 'invalid_region' WHEN user_id % 11 = 0 THEN 'invalid_topic' ELSE 'ok' END AS code FROM events"""
_KT = "list_slice(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, e' \\n\\t\\r')), lambda x: x <> ''), 1, 3)"
ORACLE["translation_checks"] = f"""WITH t AS (SELECT CAST(doc_id AS VARCHAR) AS key, doc_id, trim(string_split(text, chr(10))[1]) AS h, trim(text, e' \\n\\t\\r') AS s,
   CASE WHEN doc_id % 6 = 0 THEN '' ELSE lang END AS w, CASE WHEN doc_id % 10 <> 0 THEN {_KT} END AS k FROM documents)
 SELECT key, 'missing' AS rule, 'headline' AS field FROM t WHERE h = '' UNION ALL SELECT key, 'missing', 'summary' FROM t WHERE s = ''
 UNION ALL SELECT key, 'missing', 'whyItMatters' FROM t WHERE w = '' UNION ALL SELECT key, 'takeaways', 'keyTakeaways' FROM t WHERE k IS NULL
 UNION ALL SELECT key, 'takeaways', 'keyTakeaways' FROM t WHERE k IS NOT NULL AND len(k) = 0
 UNION ALL SELECT key, 'characters', 'copy' FROM t WHERE regexp_matches(h || s || w || coalesce(array_to_string(k, ''), ''), '[!！]')"""

# --- spoken versions ---------------------------------------------------------------------------

_TURNS = """t1 AS (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM role THEN 0 ELSE 1 END AS nw FROM conversations),
 t2 AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS turn_no FROM t1)"""
ORACLE["speaker_turns"] = f"WITH {_TURNS} SELECT conv_id, turn, role, turn_no, row_number() OVER (PARTITION BY conv_id, turn_no ORDER BY turn) AS run FROM t2"
ORACLE["collapsed_turns"] = f"WITH {_TURNS} SELECT conv_id, turn_no, any_value(role) AS role, min(turn) AS first_line, count(*) AS lines FROM t2 GROUP BY conv_id, turn_no"
_TRK = """, caps AS (SELECT conv_id, CAST(DATE '2026-07-19' + CAST(conv_id % 10 AS INTEGER) AS DATE) AS edition_date, CAST(conv_id // 10 + 1 AS INTEGER) AS number,
   bool_and(trim(role) <> '' AND trim(text) <> '' AND length(text) > 0) AS good, sum(length(text) / 16.0) AS spoken FROM conversations GROUP BY conv_id),
 outc AS (SELECT e.edition_date, e.number, CASE WHEN c.conv_id IS NULL THEN 'no_entry' WHEN c.conv_id % 9 <> 0 AND good THEN 'injected' ELSE 'skipped' END AS outcome,
   CASE WHEN c.conv_id % 9 <> 0 AND good THEN 'https://cdn.example.com/audio/' || c.conv_id || '.mp3' END AS audio
   FROM ed e LEFT JOIN caps c ON c.edition_date = e.edition_date AND c.number = e.number)"""
ORACLE["track_outcomes"] = f"WITH {CANDIDATES_SQL}{_ED}{_TRK} SELECT {D}, number, outcome, audio FROM outc"
ORACLE["track_outcome_counts"] = f"WITH {CANDIDATES_SQL}{_ED}{_TRK} SELECT {D}, outcome, count(*) AS n FROM outc GROUP BY ALL"
ORACLE["caption_drifts"] = """WITH s AS (SELECT conv_id, CAST(sum(length(text) / 16.0) AS DOUBLE) AS spoken FROM conversations GROUP BY conv_id)
 SELECT conv_id, round(spoken, 4) AS spoken, CAST((conv_id % 5) / 4.0 AS DOUBLE) AS drift, CAST((conv_id % 5) / 4.0 <= 0.5 AS INTEGER) AS ok FROM s"""

# --- lookup and keyed events -------------------------------------------------------------------

ORACLE["edition_lookup"] = """WITH e AS (SELECT event_id, CAST(ts AS DATE) AS utc_day, CAST(CASE user_id % 3 WHEN 0 THEN ts + INTERVAL 9 HOUR WHEN 1 THEN ts - INTERVAL 5 HOUR
   ELSE ts END AS DATE) AS local_date FROM events), d AS (SELECT DISTINCT utc_day AS d FROM e WHERE dayofmonth(utc_day) <= 20)
 SELECT event_id, CAST(local_date AS VARCHAR) AS local_date, CAST(coalesce(d.d, (SELECT max(d) FROM d)) AS VARCHAR) AS served_date,
   CAST(d.d IS NOT NULL AS INTEGER) AS is_exact FROM e LEFT JOIN d ON d.d = e.local_date"""
ORACLE["quota_decisions"] = """WITH w AS (SELECT *, epoch_us(ts) // 86400000000 AS b FROM events),
 r AS (SELECT *, row_number() OVER (PARTITION BY user_id, b ORDER BY ts, event_id) AS rn FROM w)
 SELECT event_id, CAST(rn <= 3 AS INTEGER) AS allowed, CASE WHEN rn > 3 THEN CAST(greatest(1, ceil(((b + 1) * 86400000000 - epoch_us(ts)) / 1000000.0)) AS INTEGER) END AS retry_after FROM r"""
ORACLE["claim_outcomes"] = """WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
 c AS (SELECT user_id, rn, event_id, ts AS own_ts, event_type AS own_p, 'claimed' AS outcome FROM o WHERE rn = 1
  UNION ALL SELECT o.user_id, o.rn, o.event_id, CASE WHEN o.ts < c.own_ts + INTERVAL 168 HOUR THEN c.own_ts ELSE o.ts END,
   CASE WHEN o.ts < c.own_ts + INTERVAL 168 HOUR THEN c.own_p ELSE o.event_type END,
   CASE WHEN o.ts >= c.own_ts + INTERVAL 168 HOUR THEN 'claimed' WHEN o.event_type = c.own_p THEN 'replay' ELSE 'conflict' END
  FROM c JOIN o ON o.user_id = c.user_id AND o.rn = c.rn + 1) SELECT event_id, outcome FROM c"""
ORACLE["latest_statuses"] = """SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS updated_at
 FROM events WHERE ts >= TIMESTAMP '2025-01-31 00:00:00' - INTERVAL 400 DAY GROUP BY user_id"""
ORACLE["incremental_ingest"] = f"""WITH {ITEMS_SQL}, k AS (SELECT seq, {CANON_SQL} AS canonical_url FROM items WHERE link <> ''
   AND (published_at IS NULL OR published_at >= now - INTERVAL 36 HOUR)) SELECT min(seq) AS seq, canonical_url FROM k GROUP BY canonical_url"""
