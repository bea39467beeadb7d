"""Spoken versions: manifest merge, caption drift, turns and script quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import numbers as N
from ..functions.rules import hits_cs, text
from .violations import each, rule, union, violations

DATE = "edition_date"
TRACK = "struct<audioURL:string,gap:double,captions:array<struct<speaker:string,text:string,duration:double>>>"
TRACKS = f"map<string,{TRACK}>"


# --- manifest merge ----------------------------------------------------------------------------

def track_url(url, key, base_url: str) -> Column:
    """Explicit URL, else the object key (itself, when it is a URL) under the base URL."""
    k = F.trim(text(key))
    joined = F.concat(F.lit(base_url.rstrip("/") + "/"), F.regexp_replace(k, "^/+", ""))
    return F.when(F.trim(text(url)) != "", F.trim(url)).when(k == "", F.lit(None).cast("string")).when(
        k.rlike("^https?://"), k).otherwise(joined)


def _good_captions(caps: Column) -> Column:
    """All or nothing: a track with one malformed caption is not used."""
    return F.coalesce((F.size(caps) > 0) & F.forall(caps, lambda c: (
        (F.trim(text(c["speaker"])) != "") & (F.trim(text(c["text"])) != "")
        & F.coalesce(c["duration"] > 0, F.lit(False)))), F.lit(False))


def listen_blocks(manifest: DataFrame, base_url: str) -> DataFrame:
    """(edition_date, number, format, tracks): usable tracks per story of a flat manifest.

    ``manifest``: edition_date, number, format, lang, audioURL, key, gap, captions.  A story has a
    handful of languages, so its tracks are collected into one map.  Of several usable rows for one
    language the one with the smallest URL counts, then the smallest gap.
    """
    built = manifest.withColumn("_u", track_url("audioURL", "key", base_url))
    ok = F.col("_u").isNotNull() & _good_captions(F.col("captions"))
    gap = F.when(F.coalesce(F.col("gap") >= 0, F.lit(False)), F.col("gap")).otherwise(F.lit(0.0))
    track = F.struct(F.col("_u").alias("audioURL"), gap.alias("gap"),
                     F.col("captions").alias("captions")).cast(TRACK)
    per_lang = built.groupBy(DATE, "number", "lang").agg(
        F.max(F.when(F.trim(text("format")) != "", F.col("format"))).alias("format"),
        F.min(F.when(ok, track)).alias("t"))
    entry = F.when(F.col("lang").isNotNull() & F.col("t").isNotNull(), F.struct("lang", "t"))
    return per_lang.groupBy(DATE, "number").agg(
        F.coalesce(F.max("format"), F.lit("dialogue")).alias("format"),
        F.map_from_entries(F.collect_list(entry)).alias("tracks"))


def inject_tracks(editions: DataFrame, manifest: DataFrame, base_url: str) -> DataFrame:
    """Merge manifest tracks into editions: add what is missing, never overwrite.

    ``editions`` has listen_format and listen (map language -> track, NULL when there is no
    block).  Adds ``outcome``: injected, merged, preserved, skipped or no_entry.
    """
    blocks = listen_blocks(manifest, base_url).withColumnsRenamed(
        {"format": "_format", "tracks": "_tracks"})
    df = editions.join(blocks, [DATE, "number"], "left")
    have = F.col("listen").isNotNull()
    known = F.coalesce(F.map_keys("listen"), F.array().cast("array<string>"))
    df = df.withColumn("_fresh", F.coalesce(
        "_tracks", F.map_from_arrays(F.array(), F.array()).cast(TRACKS)))
    df = df.withColumn("_new", F.map_filter("_fresh", lambda lang, track: ~F.array_contains(known, lang)))
    usable = F.size("_fresh") > 0
    outcome = (F.when(have & (F.size("_new") > 0), F.lit("merged")).when(have, F.lit("preserved"))
               .when(F.col("_tracks").isNull(), F.lit("no_entry"))
               .when(usable, F.lit("injected")).otherwise(F.lit("skipped")))
    df = df.withColumn("outcome", outcome)
    return df.withColumns({
        "listen_format": F.when(have, F.col("listen_format")).when(usable, F.col("_format")),
        "listen": F.when(have, F.map_concat("listen", "_new")).when(usable, F.col("_fresh")),
    }).drop("_format", "_tracks", "_fresh", "_new")


def inject_audio(editions: DataFrame, manifest: DataFrame, base_url: str) -> DataFrame:
    """Set the Japanese clip URL where a Japanese block has none.

    ``editions`` has localized (map language -> struct with audioURL); ``manifest``: edition_date,
    number, lang, key.  Adds ``outcome``: injected, preserved, no_manifest or no_ja.
    """
    ja = manifest.filter(F.col("lang") == "ja").groupBy(DATE, "number").agg(
        F.max(track_url(F.lit(None), "key", base_url)).alias("_url"))
    df = editions.join(ja, [DATE, "number"], "left")
    block = F.element_at("localized", "ja")
    outcome = (F.when(block.isNull(), F.lit("no_ja"))
               .when(F.trim(text(block["audioURL"])) != "", F.lit("preserved"))
               .when(F.col("_url").isNotNull(), F.lit("injected")).otherwise(F.lit("no_manifest")))
    return df.withColumn("outcome", outcome).withColumn("localized", F.when(
        F.col("outcome") == "injected", F.transform_values("localized", lambda k, b: F.when(
            k == "ja", b.withField("audioURL", F.col("_url"))).otherwise(b))).otherwise(
                F.col("localized"))).drop("_url")


def outcome_counts(df: DataFrame) -> DataFrame:
    """Rows per date and outcome of a merge."""
    return df.groupBy(DATE, "outcome").agg(F.count("*").alias("n"))


def caption_drift(tracks: DataFrame, limit: float = V.DRIFT_SECONDS) -> DataFrame:
    """Add ``spoken``, ``drift`` and ``ok``: caption durations against the clip."""
    spoken = F.aggregate("captions", F.lit(0.0), lambda acc, c: acc + c["duration"])
    return tracks.withColumn("spoken", spoken).withColumn(
        "drift", F.abs(F.col("clip_seconds") - F.col("spoken"))).withColumn(
            "ok", F.col("drift") <= limit)


# --- turns -------------------------------------------------------------------------------------

def speaker_turns(lines: DataFrame, key: str = "key", order: str = "line", speaker: str = "speaker",
                  width: int = 10_000) -> DataFrame:
    """Add ``turn_no`` (island of one speaker) and ``run`` (position in it) to dialogue lines.

    Lines are cut into order ranges; only one summary row per range is ordered per dialogue, so a
    very long dialogue is handled by many tasks.  A range that starts inside an island learns the
    island's length so far from the ranges before it.
    """
    cut = lines.withColumn("_bin", F.floor(F.col(order) / width))
    local = Window.partitionBy(key, "_bin").orderBy(order)
    prev = F.lag(speaker).over(local)
    marked = cut.withColumn("_new", F.when(prev.isNull() | (prev != F.col(speaker)), 1).otherwise(0))
    marked = marked.withColumn("_isle", F.sum("_new").over(local))
    tail = marked.groupBy(key, "_bin").agg(
        F.min_by(speaker, order).alias("_first"), F.max_by(speaker, order).alias("_last"),
        F.sum("_new").alias("_n"), F.count("*").alias("_rows"))
    last = (marked.groupBy(key, "_bin", "_isle").agg(F.count("*").alias("_len"))
            .groupBy(key, "_bin").agg(F.max_by("_len", "_isle").alias("_tail")))
    bins = Window.partitionBy(key).orderBy("_bin")
    chained = (tail.join(last, [key, "_bin"])
               .withColumn("_joined", (F.lag("_last").over(bins) == F.col("_first")).cast("int"))
               .withColumn("_joined", F.coalesce("_joined", F.lit(0))))
    before = bins.rowsBetween(Window.unboundedPreceding, -1)
    # An island carried into a range keeps growing only through ranges that are one island.
    broken = F.when((F.col("_n") > 1) | (F.col("_joined") == 0), F.col("_bin"))
    chained = chained.withColumn("_base", F.coalesce(
        F.sum(F.col("_n") - F.col("_joined")).over(before), F.lit(0)) - F.col("_joined"))
    chained = chained.withColumn("_stop", F.max(broken).over(before))
    runs = F.sum(F.when(F.col("_n") > 1, F.col("_tail")).otherwise(F.col("_rows"))).over(before)
    chained = chained.withColumn("_all", F.coalesce(runs, F.lit(0)))
    stop_all = chained.select(key, F.col("_bin").alias("_stop"), F.col("_all").alias("_a0"))
    offsets = (chained.join(stop_all, [key, "_stop"], "left").withColumn(
        "_carry", F.when(F.col("_joined") == 1, F.col("_all") - F.coalesce("_a0", F.lit(0)))
        .otherwise(F.lit(0))).select(key, "_bin", "_base", "_carry"))
    inside = Window.partitionBy(key, "_bin", "_isle").orderBy(order)
    return (marked.withColumn("_pos", F.row_number().over(inside)).join(offsets, [key, "_bin"])
            .withColumns({
                "turn_no": (F.col("_base") + F.col("_isle")).cast("long"),
                "run": (F.col("_pos") + F.when(F.col("_isle") == 1, F.col("_carry")).otherwise(0))
                .cast("long")})
            .drop("_bin", "_new", "_isle", "_pos", "_base", "_carry"))


def collapsed_turns(lines: DataFrame, key: str = "key", order: str = "line",
                    speaker: str = "speaker") -> DataFrame:
    """One row per turn: speaker, first line and number of lines."""
    return speaker_turns(lines, key, order, speaker).groupBy(key, "turn_no").agg(
        F.any_value(speaker).alias(speaker), F.min(order).alias("first_line"),
        F.count("*").alias("lines"))


# --- script quality ----------------------------------------------------------------------------

def _is_question(c) -> Column:
    return hits_cs(c, V.JA_QUESTION_CS)


def _latin_tokens(c) -> Column:
    return F.regexp_extract_all(text(c), F.lit(r"[A-Za-z][A-Za-z0-9.&'\-]{2,}"), F.lit(0))


def _content_rules(limit: int) -> tuple[list[Column], list[Column]]:
    """Line rules both script forms share: language, length, phrases and grounding."""
    at = F.concat(F.lit("line "), F.col("line").cast("string"))
    ungrounded = F.filter(N.digit_runs("text"), lambda d: ~F.array_contains("src_numbers", d))
    names = F.filter(_latin_tokens("text"), lambda t: ~F.contains(F.col("src_lower"), F.lower(t)))
    phrases = F.filter(F.array(*[F.lit(p) for p in V.JA_FORBIDDEN]),
                       lambda p: F.contains(F.col("text"), p))
    rules = [
        rule(F.col("pasted"), "paste", at, "article text pasted into the script"),
        rule(~hits_cs("text", V.JA_CHARS_CS), "language", at, "no Japanese characters"),
        rule(F.length("text") > limit, "length", at, F.concat(
            F.lit("too long ("), F.length("text").cast("string"), F.lit(f" chars > {limit})"))),
    ]
    arrays = [
        each(F.transform(phrases, lambda p: F.concat(F.lit("forbidden phrase "), p)), "phrase", at),
        each(F.transform(ungrounded, lambda d: F.concat(F.lit("ungrounded number "), d)), "number", at),
        each(F.transform(names, lambda t: F.concat(F.lit("ungrounded name "), t)), "name", at)]
    return rules, arrays


def grounded_lines(lines: DataFrame, stories: DataFrame) -> DataFrame:
    """Lines joined to their story: adds src_lower, src_numbers and pasted.

    ``stories``: key, source (all story fields as one text), translation (the Japanese copy).
    """
    src = stories.select("key", F.lower(N.ascii_digits("source")).alias("src_lower"),
                         N.source_numbers("source").alias("src_numbers"),
                         text("translation").alias("_ja"))
    joined = lines.join(src, "key", "left").withColumn("_runs", N.paste_runs("text", "_ja"))
    return joined.withColumn("pasted", N.is_paste(F.col("_runs"), "text", "_ja")).drop("_runs", "_ja")


def validate_dialogue(lines: DataFrame, stories: DataFrame) -> DataFrame:
    """Two-person script rules (V13): key, line, speaker, text."""
    df = speaker_turns(grounded_lines(lines, stories))
    at = F.concat(F.lit("line "), F.col("line").cast("string"))
    rules, arrays = _content_rules(V.JA_MAX_LINE_CHARS)
    statement = (F.col("speaker") == "listener") & ~_is_question("text")
    short = F.length("text") <= V.JA_AIZUCHI_MAX
    tells = ((F.length("text") > V.JA_LISTENER_STATEMENT_MAX) | (F.size(N.digit_runs("text")) > 0)
             | (F.size(_latin_tokens("text")) >= 2))
    rules += [
        rule(statement & short, "shape", at, "bare aizuchi listener line"),
        rule(statement & ~short & tells, "shape", at,
             "listener states article facts / summarizes instead of asking"),
        rule(F.col("run") >= 3, "shape", at, "same speaker three times in a row")]
    said = F.length("text") - F.length(F.replace("text", F.lit(V.JA_REPEAT_ANNOUNCE), F.lit("")))
    per = df.groupBy("key").agg(
        F.count_if((F.col("run") == 1) & (F.col("speaker") == "listener")).alias("listener"),
        F.count_if((F.col("run") == 1) & (F.col("speaker") == "explainer")).alias("explainer"),
        F.count_if((F.col("speaker") == "listener") & _is_question("text")).alias("questions"),
        (F.sum(said) / len(V.JA_REPEAT_ANNOUNCE)).cast("int").alias("announce"))
    groups = violations(per, F.col("key"), [
        rule(F.col("listener") < V.JA_MIN_LISTENER_TURNS, "shape", "listener",
             F.concat(F.lit("only "), F.col("listener").cast("string"), F.lit(" listener turn(s)"))),
        rule(F.col("explainer") < 2, "shape", "explainer",
             F.concat(F.lit("only "), F.col("explainer").cast("string"), F.lit(" explainer turn(s)"))),
        rule(F.col("questions") < V.JA_MIN_QUESTIONS, "shape", "questions",
             F.concat(F.lit("listener asks only "), F.col("questions").cast("string"),
                      F.lit(" question(s)"))),
        rule(F.col("announce") >= 2, "phrase", "announce", F.concat(
            F.lit(V.JA_REPEAT_ANNOUNCE), F.lit(" repeated")))])
    return union(violations(df, F.col("key"), rules, arrays), groups)


def validate_narration(lines: DataFrame, stories: DataFrame) -> DataFrame:
    """Single-narrator script rules."""
    df = grounded_lines(lines, stories)
    at = F.concat(F.lit("line "), F.col("line").cast("string"))
    rules, arrays = _content_rules(V.JA_SOLO_MAX_CHARS)
    rules.append(rule(text("speaker") != "narrator", "shape", at,
                      "solo narration allows only 'narrator'"))
    per = df.groupBy("key").agg(F.count("*").alias("n"),
                                F.count_if(_is_question("text")).alias("questions"))
    groups = violations(per, F.col("key"), [
        rule(~F.col("n").between(6, 10), "shape", "sentences", F.concat(
            F.col("n").cast("string"), F.lit(" sentences — solo narration needs 6–10"))),
        rule(F.col("questions") > 1, "shape", "questions", "a single host must not fake a Q&A")])
    return union(violations(df, F.col("key"), rules, arrays), groups)
