"""Duplicate stories (J4, V19): blocked equi-joins over story signatures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify as C, urls
from ..functions.rules import text
from ..session import written

DATE = "edition_date"
#: Fingerprints of a group that meet all others in the first round of ``first_duplicate_pair``.
HEADS = 64
_ORDER = ["underlying-identity", "canonical-url", "topic-fingerprint", *C.SAME_STORY_RULES]


def signatures(df: DataFrame, keys=(DATE,)) -> DataFrame:
    """Stories that look alike to every duplicate rule, folded: (keys, fp, sid, seq, copies).

    ``seq`` is the first of them.  Copies of one story become one row however many there are.
    """
    return df.groupBy(*keys, "fp", "sid").agg(F.min("seq").alias("seq"),
                                              F.count("*").alias("copies"))


def duplicate_pairs(df: DataFrame, keys=(DATE,), fingerprints: bool = True,
                    pool_rules: bool = False) -> DataFrame:
    """(keys, src, dst, rule) with src before dst: pairs any duplicate rule matches.

    Input needs seq and sid, fp for ``fingerprints``, identity and url for ``pool_rules``.
    Candidates meet through a shared brand, fingerprint token, identity or URL only, and each
    pair is produced at the first token its sides share.
    """
    keys = list(keys)
    parts = []

    def meet(rows: DataFrame, block: str, rule, extra=None):
        a = rows.select(*keys, F.col("seq").alias("src"), F.col(block).alias("_k"),
                        F.struct("*").alias("a"))
        b = rows.select(*keys, F.col("seq").alias("dst"), F.col(block).alias("_k"),
                        F.struct("*").alias("b"))
        joined = a.join(b, [*keys, "_k"]).filter(F.col("src") < F.col("dst"))
        if extra is not None:
            joined = joined.filter(extra(F.col("_k"), F.col("a"), F.col("b")))
        named = joined.withColumn("rule", rule(F.col("a"), F.col("b")))
        parts.append(named.filter(F.col("rule").isNotNull()).select(*keys, "src", "dst", "rule"))

    if pool_rules:
        meet(df.select(*keys, "seq", "identity").filter(text("identity") != ""), "identity",
             lambda a, b: F.lit("underlying-identity"))
        meet(df.select(*keys, "seq", urls.selector_url("url").alias("u")).filter("u <> ''"), "u",
             lambda a, b: F.lit("canonical-url"))
    if fingerprints:
        meet(df.select(*keys, "seq", "fp", F.explode("fp").alias("token")), "token",
             lambda a, b: F.when(C.fingerprint_overlap(a["fp"], b["fp"]),
                                 F.lit("topic-fingerprint")),
             lambda k, a, b: F.get(F.array_intersect(a["fp"], b["fp"]), F.lit(0)) == k)
    product = df.filter(F.coalesce(F.col("sid.is_product_story"), F.lit(False)))
    meet(product.select(*keys, "seq", "sid", F.col("sid.brand").alias("brand")), "brand",
         lambda a, b: F.when(C.is_same_story(a["sid"], b["sid"]),
                             C.same_story_rule(a["sid"], b["sid"])))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    rank = F.array_position(F.array(*[F.lit(r) for r in _ORDER]), F.col("rule"))
    return every.groupBy(*keys, "src", "dst").agg(F.min_by("rule", rank).alias("rule"))


def first_duplicate_pair(df: DataFrame, keys=(DATE,)) -> DataFrame:
    """The first overlapping fingerprint pair per group, in (src, dst) order.

    Equal fingerprints become one row with their first two places.  The first ``HEADS`` of a group meet all
    of the group; only a group without a pair among these goes on with the next ones, four times as many.
    """
    keys, heads, found = list(keys), HEADS, []
    places = df.filter((F.size("fp") > 0) & F.col("seq").isNotNull()).dropna(subset=keys).select(
        *keys, "fp", "seq").distinct()
    nth = F.row_number().over(Window.partitionBy(*keys, "fp").orderBy("seq"))
    rows = written(places.withColumn("_n", nth).filter("_n <= 2").groupBy(*keys, "fp").agg(
        F.min("seq").alias("m"), F.max(F.when(F.col("_n") == 2, F.col("seq"))).alias("n")), "fingerprints")
    while True:
        # Rows of the same place stay together, so a pair left for later never comes before a found one.
        place = F.rank().over(Window.partitionBy(*keys).orderBy("m"))
        first = written(rows.withColumn("_r", place).filter(F.col("_r") <= heads).drop("_r"), "heads")
        a, b = F.col("a"), F.col("b")
        dst = (F.when(a["fp"] == b["fp"], a["n"]).when(a["m"] < b["m"], b["m"])
               .otherwise(F.least(a["n"], b["n"])))
        met = (first.select(*keys, F.struct("m", "fp", "n").alias("a"))
               .join(rows.select(*keys, F.struct("m", "fp", "n").alias("b")), keys)
               .filter((F.struct(a["m"], a["fp"]) <= F.struct(b["m"], b["fp"])) & dst.isNotNull()
                       & C.fingerprint_overlap(a["fp"], b["fp"])))
        found.append(written(met.groupBy(*keys).agg(F.min(F.struct(a["m"].alias("src"), dst.alias("dst"))).alias(
            "p")), "pairs"))
        last = first.groupBy(*keys).agg(F.max("m").alias("_last"))
        rows = written(rows.join(found[-1].select(*keys), keys, "left_anti").join(last, keys).filter(
            F.col("m") > F.col("_last")).drop("_last"), "fingerprints")
        if rows.isEmpty():
            break
        heads *= 4
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    return every.select(*keys, F.col("p.src").alias("src"), F.col("p.dst").alias("dst"))
