"""Benchmark decontamination by spaced seeds (operator 1), in DataFrame functions only.

A mask of ones and zeros says which of the words behind a position count; a substitution under a
zero does not hide the match. Every position of benchmark and training texts gets one hash per mask;
hits are verified by comparing the words of a window around the seed on the hit's diagonal, of which
``SHARE`` percent must agree. Documents are cut into overlapping chunks, so a long text is not carried
along with its positions. The narrow (chunk, position, hash) rows meet the seeds, which are broadcast
while they are counted small and joined by shuffle beyond that; then only chunks with a hit are read
again and verified.

Items of at most ``SHORT`` words have lighter masks, which find every window the verification accepts; the
masks of longer items find all but a few of the placements of substitutions (``tests/llm``), 0.99 or more
at every length and count.

Defined cases: words are runs of letters and digits of the lower-cased text; null or empty texts have
none; an item of fewer than five words counts by the run of all its words, one without words never
matches; ties go to the first place in the document; rows that repeat an id are one
document; a null id is reported as null; other columns of the inputs are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyspark.llm.common import can_broadcast
from storyspark.session import written

MASKS = ("11101011", "110010111", "1011001101")
#: Masks of items of 6 to ``SHORT`` words, and of 5.
LIGHT, LIGHTEST, SHORT = ("1111", "11011", "110101"), ("111", "1101", "1011"), 16
#: Words compared around a seed, and the percentage of them that must agree.
WINDOW, SHARE = 20, 80
#: Positions of a chunk of a document, and words it sees on both sides (no window or mask reaches further).
CHUNK, CONTEXT = 256, WINDOW + max(map(len, MASKS))


def tokens(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(found, lambda w: w != ""), lambda w: F.xxhash64(w))


def masks_of(n: int) -> tuple[str, ...]:
    """Masks of an item of ``n`` words."""
    return MASKS if n > SHORT else LIGHT if n > 5 else LIGHTEST if n == 5 else ("1" * n,)


def _positions(rows: DataFrame, masks: list[str], *carried: str) -> DataFrame:
    """``carried``, ``at`` and ``seed`` of every position that a row of words owns, one per mask that fits.

    The words of a position lie side by side in shifted slices, so hashes are plain functions of
    columns and no row carries its words on.
    """
    width = F.col("high") - F.col("low") + 1
    used = sorted({k for m in masks for k, c in enumerate(m) if c == "1"})
    beside = F.arrays_zip(F.sequence("low", "high").alias("at"), *[
        F.slice("h", F.col("low") + 1 + k, width).alias(f"w{k}") for k in used])
    seeds = F.array(*[F.when(F.col(f"w{len(m) - 1}").isNotNull(), F.xxhash64(F.lit(int(m, 2)), *[
        F.col(f"w{k}") for k, c in enumerate(m) if c == "1"])) for m in masks])
    return (rows.where("low <= high").select(*carried, F.inline(beside))
            .select(*carried, "at", F.explode(seeds).alias("seed")).where("seed IS NOT NULL"))


def _whole(items: DataFrame) -> DataFrame:
    return items.select("item_id", F.col("item").alias("h"), F.lit(0).alias("low"), (F.size("item") - 1).alias("high"))


def _chunks(rows: DataFrame) -> DataFrame:
    """Words ``h`` in chunks that own ``CHUNK`` positions (``low`` to ``high``) and see the words around them.

    A long text is thus never carried along with each of its positions.
    """
    n = F.size("h")
    starts = F.sequence(F.lit(0), n - 1, F.lit(CHUNK))
    cut = F.transform(starts, lambda s: F.struct(
        F.greatest(s - CONTEXT, F.lit(0)).alias("origin"),
        (s - F.greatest(s - CONTEXT, F.lit(0))).alias("low"),
        (F.least(s + CHUNK, n) - 1 - F.greatest(s - CONTEXT, F.lit(0))).alias("high"),
        F.slice("h", F.greatest(s - CONTEXT, F.lit(0)) + 1,
                s - F.greatest(s - CONTEXT, F.lit(0)) + F.lit(CHUNK + CONTEXT)).alias("h")))
    return rows.where(n > 0).select("doc_id", F.inline(cut))


def _window() -> tuple[Column, Column]:
    """Start (in the item) and length of the window around a seed."""
    length = F.least(F.size("item"), F.lit(WINDOW))
    start = F.greatest(F.lit(0), F.least(F.col("item_at") - F.floor((length - len(MASKS[0])) / 2).cast("int"),
                                         F.size("item") - length))
    return start, length


def _agreeing() -> Column:
    """Words of the window that are equal on the diagonal."""
    shift = F.col("at") - F.col("item_at")
    places = F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)
    return F.size(F.filter(places, lambda k: F.when(k + shift >= 0, F.get("h", k + shift) == F.get("item", k))))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id``, ``item_id``, ``first_word``, ``n_compared``, ``n_equal``: documents that hold an
    item, with the best window (most equal words, then the first in the document)."""
    items = written(benchmark.select(F.col(item_col).alias("item_id"), tokens(F.col(item_text_col)).alias("item"))
                    .distinct(), "items")
    # Masks by length: at most SHORT lengths, and one for all that are longer.
    sizes = items.where(F.size("item") > 0).select(F.least(F.size("item"), F.lit(SHORT + 1)).alias("n"))
    used: dict[tuple[str, ...], list[int]] = {}
    for n in sorted(r.n for r in sizes.distinct().collect()):
        used.setdefault(masks_of(n), []).append(n)
    if not used:
        used = {MASKS: [SHORT + 1]}
    own = _whole(items).withColumn("_n", F.least(F.size("h"), F.lit(SHORT + 1)))
    seeds = reduce(DataFrame.union, [_positions(own.where(F.col("_n").isin(lengths)), list(masks), "item_id").select(
        "seed", "item_id", F.col("at").alias("item_at")) for masks, lengths in used.items()])
    masks = [m for group in used for m in group]
    seeds = written(seeds, "seeds")
    chunks = _chunks(docs.select(F.col(id_col).alias("doc_id"), tokens(F.col(text_col)).alias("h")))
    table = F.broadcast(seeds) if can_broadcast(seeds.count(), 64) else seeds
    hits = written(_positions(chunks, masks, "doc_id", "origin").join(table, "seed")
                   .select("doc_id", "origin", "item_id", "at", "item_at").distinct(), "hits")
    hit = hits.select(F.col("doc_id").alias("_id")).distinct()
    if can_broadcast(hit.count(), 64):
        hit = F.broadcast(hit)
    kept = docs.join(hit, docs[id_col].eqNullSafe(hit["_id"]), "left_semi")
    kept = _chunks(kept.select(F.col(id_col).alias("_id"), tokens(F.col(text_col)).alias("h")).withColumnRenamed("_id", "doc_id"))
    # Only chunks with a hit are verified, and each meets its own hits.
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("origin").alias("_origin"), "h")
    hits = hits.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("origin") == F.col("_origin")))
    size = items.agg(F.count("*").alias("n"), F.sum(F.size("item")).alias("words")).first()
    if can_broadcast(size.n, 64) and can_broadcast(size.words or 0, 8):
        items = F.broadcast(items)
    hits = hits.join(items, "item_id")
    start, length = _window()
    checked = (hits.select("doc_id", "item_id", "origin", "h", "item", "at", "item_at", start.alias("start"), length.alias("length"))
               .select("doc_id", "item_id", "length", (
                  F.col("origin") + F.col("at") - F.col("item_at") + F.col("start")).alias("first_word"),
                       _agreeing().alias("n_equal"))
               .where(F.col("n_equal") * 100 >= F.col("length") * SHARE))
    best = F.max(F.struct("n_equal", (-F.col("first_word")).alias("first"), "length")).alias("best")
    return checked.groupBy("doc_id", "item_id").agg(best).select(
        F.col("doc_id").alias(id_col), F.col("item_id").alias(item_col),
        (-F.col("best.first")).cast("long").alias("first_word"),
        F.col("best.length").cast("long").alias("n_compared"), F.col("best.n_equal").cast("long").alias("n_equal"))
