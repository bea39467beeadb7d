"""Quality rules by robust multivariate outliers (operator 8), in DataFrame functions only.

A few base statistics fail a document outright. The rest is judged by minimum-covariance-determinant
estimates per language and source: from a start by medians and median deviations, concentration steps
keep the share ``KEPT`` of a group's documents with the smallest distances and re-estimate centre and
scatter from sums; a document is rejected when the Mahalanobis distance of its transformed statistics
exceeds ``CUT``. A group's estimates are mixed with those of all documents by ``PRIOR`` rows, and
scatters get the smallest deviations ``FLOORS``, so small and degenerate groups need no other way.
Every step is a partially combined aggregate per group and a join of its few numbers.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has no words and fails the base
rules; a null language or source is a group of its own; repeated rows count and are judged alike;
other columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyspark.llm.common import let, words
from storyspark.session import written

#: Share of a group's rows that the estimates rest on, and the number of concentration steps.
KEPT, STEPS = 0.75, 3
#: Chi-square factor that makes a scatter of the inner KEPT of five normal dimensions consistent.
CONSISTENT = 1.41
#: Squared Mahalanobis distance above which a document is rejected.
CUT = 80.0
#: Rows' worth of the estimates over all documents in every group's estimates.
PRIOR = 30.0
#: Words' worth of ordinary text added to every ratio, which steadies short texts.
STEADY = 20.0
#: Smallest standard deviation of each transformed statistic.
FLOORS = {"length": 0.06, "symbols": 0.06, "capitals": 0.04, "lines": 0.08, "repeats": 0.08}
FEATURES = list(FLOORS)
WINDOW = 5
_D = range(len(FEATURES))


def repeated_words(found: Column) -> Column:
    """Words inside five-word windows that occur twice or more in the array of words."""
    def covered(starts: Column) -> Column:
        spans = F.transform(starts, lambda s, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))))
        return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x)

    def starts(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
        return let(ordered, lambda o: F.array_sort(F.transform(
            F.filter(o, lambda e, k: (F.coalesce(F.get(o, k - 1)["h"] == e["h"], F.lit(False)))
                     | F.coalesce(F.get(o, k + 1)["h"] == e["h"], F.lit(False))),
            lambda e: e["k"])))

    def count(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
            let(starts(windows), covered))

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    return F.when(F.size(found) <= WINDOW, F.lit(0).cast("long")).otherwise(
        let(let(F.transform(found, lambda w: F.xxhash64(w)), windows), count))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """Base statistics of every row and whether they fail; one scan, no shuffle."""
    text = F.coalesce(text_col, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    split = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
        words(text).alias("found"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"[A-ZÀ-ÖØ-Þ]")).cast("long").alias("n_capitals"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(lines, F.size).cast("long").alias("n_lines"))
    counted = split.select(
        "doc_id", "lang", "source", F.size("found").cast("long").alias("n_words"),
        F.char_length(F.array_join("found", "")).cast("long").alias("word_chars"), "n_symbols", "n_capitals",
        "n_dup_lines", "n_lines", repeated_words(F.col("found")).alias("n_repeat_words"))
    return counted.withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def transformed() -> dict[str, Column]:
    """The vector that distances are taken of: ratios steadied for short texts, roots against skew."""
    n = F.col("n_words") + STEADY
    return {"length": F.log((F.col("word_chars") + 5 * STEADY) / n),
            "symbols": F.sqrt(F.col("n_symbols") / n),
            "capitals": F.sqrt(F.col("n_capitals") / (F.col("word_chars") + 5 * STEADY)),
            "lines": F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 2)),
            "repeats": F.sqrt(F.col("n_repeat_words") / n)}


def _sums() -> list[Column]:
    return ([F.count("*").cast("double").alias("n"), *(F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES))]
            + [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}{j}") for i in _D for j in range(i + 1)])


def _estimates(inner: DataFrame, groups: DataFrame) -> DataFrame:
    """Centre and inverse Cholesky factor of the scatter per group, from rows ``inner``."""
    key = ["lang", "source"]
    own = written(inner.groupBy(*key).agg(*_sums()), "sums")
    every = own.agg(*[F.sum(c).alias(f"a{c}") for c in own.columns if c not in key])
    # One row of all documents' sums joins every group.
    both = groups.select(*key).join(own, _same(groups, own, key), "left").select(
        *[groups[k] for k in key], *[own[c] for c in own.columns if c not in key]).crossJoin(F.broadcast(every))
    share = PRIOR / F.greatest(F.col("an"), F.lit(1.0))
    mixed = both.select(*key, *[(F.coalesce(c, F.lit(0.0)) + share * F.coalesce(f"a{c}", F.lit(0.0))).alias(c)
                                for c in own.columns if c not in key])
    mixed = mixed.withColumn("n", F.greatest("n", F.lit(1e-9)))
    mixed = mixed.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in _D})
    floor = list(FLOORS.values())
    mixed = mixed.withColumns({
        f"c{i}{j}": CONSISTENT * (F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
        + (floor[i] ** 2 if i == j else 0.0) for i in _D for j in range(i + 1)})
    for i in _D:
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            mixed = mixed.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-8))) if i == j
                                     else rest / F.col(f"l{j}{j}"))
    for i in _D:
        for j in range(i, -1, -1):
            value = F.lit(1.0) if i == j else -sum(
                (F.col(f"l{i}{k}") * F.col(f"v{k}{j}") for k in range(j + 1, i)), F.col(f"l{i}{j}") * F.col(f"v{j}{j}"))
            mixed = mixed.withColumn(f"v{i}{j}", value / F.col(f"l{i}{i}"))
    return written(mixed.select(*key, *[f"m{i}" for i in _D],
                                *[f"v{i}{j}" for i in _D for j in range(i + 1)]), "estimates")


def _same(a: DataFrame, b: DataFrame, key: list[str]) -> Column:
    return a[key[0]].eqNullSafe(b[key[0]]) & a[key[1]].eqNullSafe(b[key[1]])


def _with(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with their group's numbers."""
    key = ["lang", "source"]
    return rows.join(table, _same(rows, table, key)).drop(table["lang"]).drop(table["source"])


def _distance() -> Column:
    apart = [F.col(f) - F.col(f"m{i}") for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in _D:
        y = F.lit(0.0)
        for j in range(i + 1):
            y = y + F.col(f"v{i}{j}") * apart[j]
        total = total + y * y
    return total


def _inner(rows: DataFrame) -> DataFrame:
    """The share ``KEPT`` of every group's rows with the smallest ``distance``."""
    edge = written(rows.groupBy("lang", "source").agg(
        F.percentile_approx("distance", F.lit(KEPT), F.lit(1000)).alias("edge")), "edges")
    return _with(rows, edge).where("distance <= edge")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", cut: float = CUT) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``distance`` (squared) and ``kept`` per row."""
    base = written(statistics(docs, id_col, text_col, lang_col, source_col), "statistics")
    rows = base.where("NOT base_failed").select("lang", "source", *[c.alias(f) for f, c in transformed().items()])
    groups = written(rows.select("lang", "source").distinct(), "groups")
    middle = written(rows.groupBy("lang", "source").agg(
        *[F.percentile_approx(f, F.lit(0.5), F.lit(1000)).alias(f"m{i}") for i, f in enumerate(FEATURES)]), "medians")
    centred = _with(rows, middle)
    spread = written(centred.groupBy("lang", "source").agg(
        *[F.percentile_approx(F.abs(F.col(f) - F.col(f"m{i}")), F.lit(0.5), F.lit(1000)).alias(f"d{i}")
          for i, f in enumerate(FEATURES)]), "deviations")
    first = F.lit(0.0)
    for i, (f, floor) in enumerate(FLOORS.items()):
        first = first + F.pow((F.col(f) - F.col(f"m{i}")) / F.greatest(1.4826 * F.col(f"d{i}"), F.lit(floor)), F.lit(2))
    inner = _inner(_with(centred, spread).select(*rows.columns, first.alias("distance")))
    table = _estimates(inner, groups)
    for _ in range(STEPS):
        table = _estimates(_inner(_with(rows, table).select(*rows.columns, _distance().alias("distance"))), groups)
    judged = base.join(table, _same(base, table, ["lang", "source"]), "left").drop(table["lang"]).drop(table["source"])
    judged = judged.withColumns(transformed()).withColumn("distance", _distance())
    return judged.select(
        F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(False))).alias("kept"),
        F.when(~F.col("base_failed"), F.col("distance")).alias("distance"))
