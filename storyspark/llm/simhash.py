"""SimHash near duplicates with pigeonring filtering (operator 13).

A text is the 64-bit SimHash of its word shingles. Equal fingerprints are folded to one row first. The
bits are cut into ``segments`` that form a ring. If two fingerprints differ in at most ``distance`` bits,
some segment starts a chain whose first ``l`` segments differ in at most ``l * distance / segments``
bits together, for every ``l``. With more segments than ``distance`` the chain starts with an equal
segment, and its second one, within its budget, has an equal part. So fingerprints meet on (start, first
segment, an equal part of the second one); the rest of the chain prunes the pairs of a cell before the
whole distance, which is the chain's last budget, admits a link. A cell of more than ``BLOCK`` rows is
cut into pairs of blocks, so no task holds a group, and a cell returns spanning edges, not its pairs.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a null or empty text, or one of
white space, has the fingerprint zero and links like any other; a text with fewer words than a shingle
is one shingle; repeated rows and repeated shingles count each time; a row with a null id takes part but
names no component (its component is null if it links to no row with an id); other columns of the input
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyspark.llm.common import bounded_batches, can_broadcast
from storyspark.llm.components import components
from storyspark.session import written

BITS = 64
#: Seed of XXH64, the one that Spark's own ``xxhash64`` has.
SEED = 42
#: Rows of a block; a cell holds two blocks at most.
BLOCK = 1_024
#: Rows of cells, and pairs of rows, that a task looks at together, about.
CELL_ROWS, PAIRS = 16_000, 1_000_000
#: Shingle hashes whose bits are spread out at once.
SPREAD = 1 << 16


def shingle_hashes(text: bytes | None, size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words (joined by spaces), repeats included."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    width, digest = min(size, len(words)), xxhash.xxh64_intdigest
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    cuts = zip(starts, starts[width:])
    return np.array([digest(joined[a:b - 1], SEED) for a, b in cuts], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half of ``hashes``, as a signed number."""
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), SPREAD):
        octets = hashes[lo:lo + SPREAD].astype("<u8").view(np.uint8).reshape(-1, BITS // 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``print``: the SimHash of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(t, size)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["id", "print"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, print long")


class Ring:
    """Widths, budgets and join keys of ``segments`` in a ring of ``BITS`` bits."""

    def __init__(self, distance: int, segments: int):
        if not 0 <= distance < segments or BITS % segments:
            raise ValueError("segments must divide 64 and be more than distance")
        self.distance, self.segments, self.width = distance, segments, BITS // segments
        self.budgets = [chain * distance // segments for chain in range(1, segments + 1)]
        self.parts = self.budgets[min(1, segments - 1)] + 1
        cuts = [k * self.width // self.parts for k in range(self.parts + 1)]
        self.slices = list(zip(cuts[:-1], cuts[1:]))

    def keys(self, value: Column) -> Column:
        """Structs ``start``, ``key``: one for every segment and part of the segment after it."""
        def bits(at: int, width: int) -> Column:
            shifted = F.shiftrightunsigned(value, at)
            return shifted.bitwiseAND(F.lit((1 << width) - 1).cast("long")) if at + width < BITS else shifted

        out = []
        for start in range(self.segments):
            after = (start + 1) % self.segments * self.width
            for part, (lo, hi) in enumerate(self.slices):
                # Cells that share a hash by chance only hold pairs that the chain then prunes.
                key = F.xxhash64(F.lit(start), F.lit(part), bits(start * self.width, self.width), bits(after + lo, hi - lo))
                out.append(F.struct(F.lit(start).alias("start"), key.alias("key")))
        return F.array(*out)

    def viable(self, start: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the pairs whose chain at ``start`` keeps every budget, the last of which is ``distance``."""
        differ = a ^ b
        turn = (start * self.width).astype(np.uint64)
        ring = (differ >> turn) | (differ << ((np.uint64(BITS) - turn) & np.uint64(BITS - 1)))
        left = np.arange(len(ring))
        for chain, budget in enumerate(self.budgets, 1):
            mask = np.uint64((1 << chain * self.width) - 1)
            keep = np.bitwise_count(ring & mask) <= budget
            ring, left = ring[keep], left[keep]
        return left


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole cells, about ``CELL_ROWS`` rows each, with a cell number per row."""
    def numbered(table: pa.Table) -> np.ndarray:
        change = np.zeros(len(table), bool)
        for name in ("key", "x", "y"):
            values = table.column(name).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.cumsum(change)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) < CELL_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cell = numbered(table)
        last = int(np.searchsorted(cell, cell[-1]))
        if last:
            yield table.slice(0, last), cell[:last]
            held = table.slice(last).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, numbered(table)


def _hook(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest reachable place per place, after the links ``left``-``right`` are added to ``root``."""
    while True:
        a, b = root[left], root[right]
        apart = a != b
        if not apart.any():
            return root
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _spanning(ring: Ring):
    """Edges ``a``, ``b`` that connect what links inside the cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cell in _whole_cells(batches):
            prints = table.column("print").to_numpy()
            value, start = prints.view(np.uint64), table.column("start").to_numpy()
            # In a cell of two blocks, a pair inside one block belongs to that block's own cell.
            block = np.where(table.column("x").to_numpy() != table.column("y").to_numpy(),
                             table.column("block").to_numpy(), -1 - np.arange(len(cell)))
            after = np.cumsum(np.bincount(cell))[cell] - 1 - np.arange(len(cell))
            totals = np.cumsum(after)
            root, lo = np.arange(len(cell)), 0
            while lo < len(cell):
                done = int(totals[lo - 1]) if lo else 0
                hi = max(int(np.searchsorted(totals, done + PAIRS, side="right")), lo + 1)
                left = np.repeat(np.arange(lo, hi), after[lo:hi])
                right = left + 1 + np.arange(len(left)) - np.repeat(totals[lo:hi] - after[lo:hi] - done, after[lo:hi])
                apart = block[left] != block[right]
                left, right = left[apart], right[apart]
                kept = ring.viable(start[left], value[left], value[right])
                root = _hook(root, left[kept], right[kept])
                lo = hi
            joined = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(prints[joined]), pa.array(prints[root[joined]])], ["a", "b"])

    return run


def links(prints: DataFrame, distance: int = 3, segments: int = 4, block: int = BLOCK) -> DataFrame:
    """Edges ``a``, ``b`` between distinct values of ``print``: all pairs of at most ``distance`` differing
    bits are connected by them (copies of a value are one)."""
    ring = Ring(distance, segments)
    rows = written(prints.select("print").distinct()
                   .select("print", F.inline(ring.keys(F.col("print")))), "ring-keys")
    met = written(rows.groupBy("key").count().where("count > 1")
                  .select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "ring-cells")
    cells = (rows.join(met, "key").withColumn("block", F.pmod(F.xxhash64("print"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                     "block", "start", "print"))
    order = ["key", "x", "y"]
    return cells.repartition(*order).sortWithinPartitions(*order).mapInArrow(_spanning(ring), "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = 3, segments: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``id_col``, ``print`` (signed), ``component_id``: the smallest id reachable over links of at most
    ``distance`` differing bits, for every row of ``docs``."""
    with bounded_batches(docs.sparkSession):
        found = written(fingerprints(docs, size, id_col, text_col), "prints")
    classes = written(found.groupBy("print").agg(F.min("id").alias("least"), F.count("*").alias("rows")), "print-classes")
    labels = components(written(links(classes, distance, segments, block), "print-links"))
    # A class of one row without a link is its own component: it needs no join.
    shared = written(classes.join(labels.withColumnRenamed("id", "print"), "print", "left")
                     .where("rows > 1 OR label IS NOT NULL")
                     .withColumn("label", F.coalesce("label", "print")), "print-groups")
    least = shared.groupBy("label").agg(F.min("least").alias("component_id"))
    groups = written(shared.join(least, "label").select("print", "component_id", F.lit(True).alias("grouped")),
                     "print-components")
    if can_broadcast(groups.count(), 32):
        groups = F.broadcast(groups)
    return found.join(groups, "print", "left").select(
        F.col("id").alias(id_col), "print",
        F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
