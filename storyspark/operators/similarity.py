"""Title similarity and greedy clustering (J1, A1), and leaders of an edge table.

Rows with the same token set behave alike, so they are folded into one row first.  Each date is then
settled in blocks of its first rows: one task reads a block in order and compares a row with the
leaders before it only, through an inverted index, so a block needs no pairs and ends in one pass
however long its chains are.  The block's leaders then take their similar later rows out by a
prefix-filtered token join, before the next block is cut from what is left.
"""

from __future__ import annotations

import json
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import text as T
from ..session import written

DATE = "edition_date"
HOT_SHARE = 64                 # a token in more than 1/64 of the rows is ordered last
BLOCK_ROWS = 20_000            # distinct token sets of a date that one task settles
EDGES = 200_000                # edges of a group (about) that one task settles
RANGE_ROWS = 10_000


def _hot_tokens(sets: DataFrame) -> dict:
    """Counts of tokens found in over 1/64 of all rows: at most 64 x the mean title length."""
    n = sets.count()
    rows = (sets.select(F.explode("tokens").alias("t")).groupBy("t").count()
            .filter((F.col("count") > max(50, n // HOT_SHARE))).collect())
    return {r["t"]: r["count"] for r in rows}


def _with_prefix(sets: DataFrame, hot: dict) -> DataFrame:
    """Add ``prefix``: the tokens one of which any similar pair must share.

    Tokens are ordered rare first (hot ones last, longer before shorter); two sets of similarity
    t or more share a token in the first n - ceil(t n) + 1 of each.
    """
    n = F.size("tokens")
    known = F.from_json(F.lit(json.dumps(hot)), "map<string,bigint>")
    ordered = F.transform(F.array_sort(F.transform("tokens", lambda t: F.struct(
        F.coalesce(F.element_at(known, t), F.lit(0)).alias("h"), (-F.length(t)).alias("l"),
        t.alias("t")))), lambda s: s["t"])
    keep = n - F.ceil(n * V.JACCARD_NUM / V.JACCARD_DEN).cast("int") + 1
    return sets.withColumn("prefix", F.slice(ordered, F.lit(1), keep))


def _similar(inter: Column, union: Column) -> Column:
    return V.JACCARD_DEN * inter >= V.JACCARD_NUM * union


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Similar (src < dst) pairs of two sets tables of a date, exactly once each."""
    a = left.select(DATE, F.col("seq").alias("src"), F.col("tokens").alias("ta"),
                    F.col("prefix").alias("pa"), F.explode("prefix").alias("t"))
    b = right.select(DATE, F.col("seq").alias("dst"), F.col("tokens").alias("tb"),
                     F.col("prefix").alias("pb"), F.explode("prefix").alias("t"))
    na, nb = F.size("ta"), F.size("tb")
    inter = F.size(F.array_intersect("ta", "tb"))
    # Each pair is kept only at the first prefix token its sides share, so no distinct is needed.
    first_shared = F.get(F.array_intersect("pa", "pb"), F.lit(0)) == F.col("t")
    return (a.join(b, [DATE, "t"])
            .filter((F.col("src") < F.col("dst"))
                    & (V.JACCARD_DEN * F.least(na, nb) >= V.JACCARD_NUM * F.greatest(na, nb))
                    & first_shared & _similar(inter, na + nb - inter))
            .select(DATE, "src", "dst", inter.alias("shared"),
                    (na + nb - inter).alias("total")))


def _settle_edges(keys: list[str]):
    """Decide the nodes of a range from its incoming edges, as far as its own nodes allow.

    Rows come sorted by group, range, ``dst`` and ``src``.  A ``src`` that is in no edge as ``dst``
    (``head``) is a leader, one of the same range is known from before, any other is open.  A node
    next to a leader is covered; one whose earlier neighbours are all covered is a leader.
    """
    names = [*keys, "_bin"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        group = node = None
        leads = open_ = False

        def decided():
            """The status of ``node``, remembered; None where it stays open."""
            known[node] = False if leads else None if open_ else True
            return known[node]

        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(k).to_pylist() for k in [*names, "dst", "src", "head"]]
            for *place, dst, src, head in zip(*columns):
                if dst != node or place != group:
                    if node is not None and decided() is not None:
                        out.append((*group[:-1], node, known[node]))
                    if place != group:
                        known = {}
                    group, node, leads, open_ = place, dst, False, False
                status = True if head else known.get(src)
                leads |= status is True
                open_ |= status is None
            yield _rows(out, batch, keys)
        if node is not None and decided() is not None:
            yield _rows([(*group[:-1], node, known[node])], batch, keys)

    return run


def _rows(out: list[tuple], like: pa.RecordBatch, keys: list[str]) -> pa.RecordBatch:
    kinds = [*(like.schema.field(k).type for k in keys), pa.int64(), pa.bool_()]
    columns = list(zip(*out)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)],
                                      [*keys, "node", "leader"])


def leader_rounds(edges: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Lexicographically first maximal independent set of an edge table (src before dst).

    Returns (covered, edges): the nodes that are not leaders, and the given edges written out.
    Nodes without edges never enter.  Each group is cut into ranges of ``dst`` with about ``EDGES``
    edges; a task settles a range in order, at any depth, and only nodes that wait for another
    range go on to the next round, where the ranges are wider.
    """
    edges = written(edges, "edges")
    live, covered = edges.select(*keys, F.col("src").cast("long"), F.col("dst").cast("long")), None
    kinds = ", ".join(f"`{k}` {edges.schema[k].dataType.simpleString()}" for k in keys)
    # The earliest open node of every group is settled in each round, so this ends.
    while not live.isEmpty():
        span = live.groupBy(*keys).agg(F.min("dst").alias("_lo"), F.max("dst").alias("_hi"),
                                       F.ceil(F.count("*") / EDGES).alias("_n"))
        width = F.ceil((F.col("_hi") - F.col("_lo") + 1) / F.col("_n"))
        entered = live.select(*keys, F.col("dst").alias("src"), F.lit(False).alias("head")).distinct()
        cut = (live.join(entered, [*keys, "src"], "left").join(span, keys)
               .select(*keys, F.floor((F.col("dst") - F.col("_lo")) / width).alias("_bin"), "dst", "src",
                       F.coalesce("head", F.lit(True)).alias("head")))
        order = [*keys, "_bin", "dst", "src"]
        found = written(cut.repartition(*keys, "_bin").sortWithinPartitions(*order).mapInArrow(
            _settle_edges(keys), f"{kinds}, node long, leader boolean"), "settled")
        # Leaders cover neighbours in other ranges as well; heads cover theirs inside the task.
        named = found.where("leader").select(*keys, F.col("node").alias("src"))
        reached = live.join(named, [*keys, "src"], "left_semi").select(*keys, F.col("dst").alias("node"))
        out = written(found.where("NOT leader").select(*keys, "node").union(reached).distinct(), "covered")
        covered = out if covered is None else covered.unionByName(out)
        over = out.unionByName(found.where("leader").select(*keys, "node"))
        live = written(live.join(over.withColumnRenamed("node", "dst"), [*keys, "dst"], "left_anti")
                       .join(out.withColumnRenamed("node", "src"), [*keys, "src"], "left_anti"), "live")
    if covered is None:
        covered = edges.select(*keys, F.col("dst").alias("node")).limit(0)
    return covered, edges


def _matches(edges: DataFrame) -> DataFrame:
    """Smallest leader per covered row, from edges whose src are leaders."""
    best = edges.groupBy(DATE, "dst").agg(F.min("src").alias("src"))
    return edges.join(best, [DATE, "dst", "src"]).select(
        DATE, F.col("dst").alias("seq"), F.col("src").alias("leader"), "shared", "total")


class _Leaders:
    """Leaders of a date so far, by token."""

    def __init__(self):
        self.found: list[int] = []
        self.sizes = array("q")
        self.of: dict = defaultdict(lambda: array("q"))

    def place(self, seq: int, tokens: list[str]) -> tuple[int, int, int]:
        """(leader, shared tokens, tokens of both) of a row; it leads itself where no leader is similar."""
        held = [np.frombuffer(self.of[t], np.int64) for t in tokens if t in self.of]
        if held:
            at, shared = np.unique(np.concatenate(held), return_counts=True)
            total = len(tokens) + np.frombuffer(self.sizes, np.int64)[at] - shared
            like = np.flatnonzero(V.JACCARD_DEN * shared >= V.JACCARD_NUM * total)
            if len(like):
                first = like[0]
                return self.found[at[first]], int(shared[first]), int(total[first])
        del held
        for t in tokens:
            self.of[t].append(len(self.found))
        self.found.append(seq)
        self.sizes.append(len(tokens))
        return seq, len(tokens), len(tokens)


def _settle_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The leader of every row of the dates' blocks; rows come sorted by date and ``seq``."""
    date, leaders = None, _Leaders()
    for batch in batches:
        out = []
        for day, seq, tokens in zip(*(batch.column(k).to_pylist() for k in (DATE, "seq", "tokens"))):
            if day != date:
                date, leaders = day, _Leaders()
            out.append(leaders.place(seq, tokens))
        columns = list(zip(*out)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [batch.column(DATE), batch.column("seq"), *(pa.array(list(c), t) for c, t in zip(
                columns, (pa.int64(), pa.int32(), pa.int32())))], [DATE, "seq", "leader", "shared", "total"])


def _leader_sets(sets: DataFrame) -> DataFrame:
    """(date, seq, leader, shared, total) for every set; a leader is its own.

    Rows are numbered once and keep the number of their block.  A round takes as many blocks of a
    date as hold ``BLOCK_ROWS`` rows that are left, so rounds follow the rows that no earlier leader
    takes out, not the length of chains.
    """
    numbered = number_rows(sets.withColumn("seq", F.col("seq").cast("long")), [DATE], "seq", "_number")
    rest = written(_with_prefix(numbered, _hot_tokens(sets))
                   .withColumn("_block", F.expr(f"_number div {BLOCK_ROWS}")).drop("_number"), "sets")
    kind, placed = sets.schema[DATE].dataType.simpleString(), None
    while placed is None or not rest.isEmpty():
        by_block = Window.partitionBy(DATE).orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
        taken = (rest.groupBy(DATE, "_block").agg(F.count("*").alias("_rows"))
                 .withColumn("_sum", F.sum("_rows").over(by_block))
                 .where((F.col("_sum") <= BLOCK_ROWS) | (F.col("_sum") == F.col("_rows")))
                 .groupBy(DATE).agg(F.max("_block").alias("_last")))
        cut = rest.join(taken, DATE)
        block = cut.where("_block <= _last").drop("_last")
        found = written(block.select(DATE, "seq", "tokens").repartition(DATE).sortWithinPartitions(DATE, "seq")
                        .mapInArrow(_settle_blocks, f"{DATE} {kind}, seq long, leader long, shared int, total int"),
                        "settled")
        placed = found if placed is None else placed.unionByName(found)
        later = cut.where("_block > _last").drop("_last")
        leaders = block.join(found.where("seq = leader").select(DATE, "seq"), [DATE, "seq"], "left_semi")
        matched = written(_matches(_pairs(leaders, later)), "matched")
        placed = placed.unionByName(matched)
        rest = written(later.join(matched.select(DATE, "seq"), [DATE, "seq"], "left_anti"), "sets")
    return placed


def title_leaders(df: DataFrame, title: str = "title") -> DataFrame:
    """(edition_date, seq, leader, shared, total): the seed every row is clustered with.

    In order of ``seq`` an unassigned row seeds a cluster; later unassigned rows whose title
    token sets have Jaccard >= 0.30 to the seed join it.  A seed is its own leader.
    """
    tokens = written(df.select(DATE, "seq", T.title_tokens(title).alias("tokens")), "tokens")
    some = tokens.filter(F.size("tokens") > 0)
    sets = written(some.groupBy(DATE, "tokens").agg(F.min("seq").alias("seq")), "distinct")
    members = _leader_sets(sets)
    placed = sets.join(members, [DATE, "seq"]).select(DATE, "tokens", "leader", "shared", "total")
    # Rows with equal token sets share their representative's seed; empty sets match nothing.
    rows = some.join(placed, [DATE, "tokens"]).select(DATE, "seq", "leader", "shared", "total")
    empty = tokens.filter(F.size("tokens") == 0).select(
        DATE, "seq", F.col("seq").alias("leader"), F.lit(0).alias("shared"),
        F.lit(0).alias("total"))
    return rows.unionByName(empty)


def similar_titles(df: DataFrame, title: str = "title") -> DataFrame:
    """The similarity join the clustering needs: (seed, later row) pairs with their Jaccard."""
    return title_leaders(df, title).filter(F.col("seq") != F.col("leader")).select(
        DATE, F.col("leader").alias("seed"), F.col("seq").alias("member"), "shared", "total",
        (F.col("shared").cast("double") / F.col("total")).alias("jaccard"))


def cluster_titles(df: DataFrame, title: str = "title") -> DataFrame:
    """Add ``cluster_id``: the seed's position among the date's seeds (A1).

    The position is a running count over seeds only.  It is computed from per-range counts, so a
    date with very many seeds is numbered by many tasks.
    """
    placed = written(title_leaders(df, title), "placed")
    seeds = placed.filter(F.col("seq") == F.col("leader")).select(DATE, "seq")
    numbered = number_rows(seeds, [DATE], "seq", "cluster_id")
    return (df.join(placed.select(DATE, "seq", "leader"), [DATE, "seq"])
            .join(numbered.select(DATE, F.col("seq").alias("leader"), "cluster_id"),
                  [DATE, "leader"]).drop("leader"))


def number_rows(df: DataFrame, keys: list[str], order: str, out: str) -> DataFrame:
    """Dense 0-based numbering of unique ``order`` values per key, without one task per key.

    Rows are cut into order ranges of about ten thousand rows, as wide as each key's values need; a
    row's number is the size of the key's earlier ranges plus its place inside its own range.
    """
    span = df.groupBy(*keys).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"),
                                 F.count("*").alias("_c"))
    width = F.ceil((F.col("_hi") - F.col("_lo") + 1) / F.ceil(F.col("_c") / RANGE_ROWS))
    cut = df.join(span, keys).withColumn(
        "_bin", F.floor((F.col(order) - F.col("_lo")) / width)).drop("_lo", "_hi", "_c")
    sizes = cut.groupBy(*keys, "_bin").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offset = sizes.withColumn("_o", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, "_bin").orderBy(order)
    return (cut.withColumn("_r", F.row_number().over(inside) - 1).join(offset, [*keys, "_bin"])
            .withColumn(out, (F.col("_o") + F.col("_r")).cast("long")).drop("_bin", "_o", "_r"))
