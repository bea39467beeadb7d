"""N-gram Jaccard self-join of whole texts (operator 4).

A document is its set of distinct word shingles, held as 64-bit hashes. Copies of one set are folded
to a class first. Classes meet on prefix n-grams, rarest first: rarity comes from a count of all
shingles in a fixed number of buckets, so the order is one for all documents and its table has a
proven size, and n-grams of hot passages always come last. Of n-grams that the very same classes hold in
their prefixes only the first one is kept, as no pair can meet first on another, and a class stays at an n-gram only
if the next larger or smaller class there can be alike by its length. Length and positional
filters, and a suffix filter on counts by hash range, prune the candidates; a pair is looked at only in the cell of
its first common prefix n-gram. There its sketches are compared, counts by as many hash ranges as a set's
size asks for, and what is left is verified once on the whole sets: only these travel. Cells of frequent n-grams
are cut into pairs of blocks, so no task holds a group; a cell returns sums and one spanning edge per
member, never its pairs.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a null or empty text and one
of white space has no shingles, links with nothing and is its own component; a text with fewer words
than a shingle is one shingle; repeated rows are copies and link to each other; a row with a null id
takes part but never names a component (its component is null if it links to no row with an id);
other columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyspark.llm.common import bounded_batches, can_broadcast, offsets, runs
from storyspark.llm.components import components
from storyspark.session import written

#: Buckets (a power of two) of the shingle count: its table is 8 bytes times 2 ** SKETCH_BITS.
SKETCH_BITS = 18
#: Members of a block; a cell holds two blocks at most.
BLOCK = 400
#: Hash ranges of the suffix filter.
RANGES = 16
#: Hash ranges of a sketch: a power of two of at least a quarter of the set's size, within these bounds.
SKETCH_RANGES = (16, 1 << 14)
#: Bytes of an Arrow batch, about: sets of long texts are large rows.
BATCH_BYTES = 4 << 20
#: Words whose hash a worker remembers before it starts afresh.
REMEMBERED = 500_000
#: Rows of cells and pairs of rows that are filtered at once, about; pairs of a cell checked one by one.
CELL_ROWS, PAIRS, FEW = 1_000, 100_000, 64


#: A cell's members with the partners that come after them.
PARTNERS = "token long, x int, y int, cls long, partners array<long>"


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, size: int, known: _Words) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of ``text``."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    width = min(size, len(codes))
    total = np.full(len(codes) - width + 1, width, np.uint64)
    for k in range(width):
        total = _mixed(total + codes[k:len(codes) - width + 1 + k])
    return np.unique(total)


def many_shingles(texts: list[bytes | None], size: int, known: _Words) -> list[np.ndarray]:
    """``shingles`` of every text, worked out for all of them at once."""
    words = [(t or b"").lower().split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.fromiter((known[w] for row in words for w in row), np.uint64, int(counts.sum()))
    starts = offsets(counts)[:-1]
    total = np.full(max(len(codes) - size + 1, 0), size, np.uint64)
    for k in range(size):
        total = _mixed(total + codes[k:k + len(total)])
    text = np.repeat(np.arange(len(words)), counts)[:len(total)]
    whole = np.arange(len(total)) + size <= (starts + counts)[text]
    total, text = total[whole], text[whole]
    order = np.lexsort((total, text))
    total, text = total[order], text[order]
    fresh = np.ones(len(total), bool)
    fresh[1:] = (total[1:] != total[:-1]) | (text[1:] != text[:-1])
    total, text = total[fresh], text[fresh]
    rows = np.split(total, np.searchsorted(text, np.arange(1, len(words)))) if words else []
    for k in np.flatnonzero((counts > 0) & (counts < size)).tolist():
        rows[k] = shingles(texts[k], size, known)
    return rows


def _long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _mark(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    import xxhash

    digest = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64)
    return int(digest[0]), int(digest[1])


def _lists(values: list[np.ndarray], kind: type) -> pa.ListArray:
    bounds = offsets(np.fromiter(map(len, values), np.int64, len(values))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.astype(kind, copy=False)))


def _sets(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document (its id, set size and mark), and per task one row of bucket counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = _Words(), np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["id", "n", "m1", "m2", "buckets", "counts"]
        none = pa.nulls
        for batch in batches:
            rows = many_shingles(batch.column(1).to_pylist(), size, known)
            counts += np.bincount((np.concatenate(rows) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64),
                                  minlength=len(counts))
            marks = [_mark(r) for r in rows]
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(r) for r in rows], pa.int64()),
                 pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()),
                 none(n, pa.list_(pa.int32())), none(n, pa.list_(pa.int64()))], names)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [none(1, pa.int64()), none(1, pa.int64()), none(1, pa.int64()), none(1, pa.int64()),
             _lists([at], np.int32), _lists([counts[at]], np.int64)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, n long, m1 long, m2 long, buckets array<int>, counts array<long>")


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Counts by hash range, 255 at most; more ranges for larger sets."""
    least, most = SKETCH_RANGES
    bits = (min(max(len(hashes) // 4, least), most) - 1).bit_length()
    found = np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(found, 255).astype(np.uint8)


def folded(counts: np.ndarray, length: int) -> np.ndarray:
    """A sketch with ``length`` ranges: neighbours are summed up."""
    return counts.reshape(length, -1).sum(axis=1, dtype=np.int32)


def _prefixes(docs: DataFrame, size: int, percent: int, counts: np.ndarray, id_col: str,
              text_col: str) -> DataFrame:
    """``id``, ``m1``, ``m2``, ``tokens`` (the prefix, rarest first), ``ranges`` (sizes by hash range), ``sketch``."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = _Words(), shared.value
        for batch in batches:
            marks, tokens, ranges, sketches = [], [], [], []
            for row in many_shingles(batch.column(1).to_pylist(), size, known):
                n = len(row)
                length = n - (percent * n + 99) // 100 + 1 if n else 0
                rarity = table[(row >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                marks.append(_mark(row))
                tokens.append(_long(row[np.lexsort((row, rarity))[:length]]))
                ranges.append(np.bincount((row >> np.uint64(60)).astype(np.int64), minlength=RANGES))
                sketches.append(sketch(row).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([m[0] for m in marks], pa.int64()),
                 pa.array([m[1] for m in marks], pa.int64()), _lists(tokens, np.int64),
                 _lists(ranges, np.int32), pa.array(sketches, pa.binary())],
                ["id", "m1", "m2", "tokens", "ranges", "sketch"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, m1 long, m2 long, tokens array<long>, ranges array<int>, sketch binary")


def _whole(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``m1``, ``m2``, ``hashes``: the whole sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            rows = many_shingles(batch.column(0).to_pylist(), size, known)
            marks = [_mark(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()),
                 _lists([_long(r) for r in rows], np.int64)], ["m1", "m2", "hashes"])

    return docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, "m1 long, m2 long, hashes array<long>")


def _incidence(rows: list[np.ndarray]) -> np.ndarray:
    """Members by distinct values, 1 where a member has the value."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    distinct, codes = np.unique(np.concatenate(rows), return_inverse=True)
    out = np.zeros((len(rows), len(distinct)), np.float32)
    out[np.repeat(np.arange(len(rows)), sizes), codes] = 1
    return out


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole cells, about ``CELL_ROWS`` rows each, from batches sorted by cell."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) < CELL_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        edges = np.flatnonzero(_changes(table))
        if edges[-1]:
            yield table.slice(0, int(edges[-1]))
            held = table.slice(int(edges[-1])).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _changes(table: pa.Table) -> np.ndarray:
    """True on the first row of every cell."""
    first = np.zeros(len(table), bool)
    first[0] = True
    for name in ("token", "x", "y"):
        values = table.column(name).to_numpy()
        first[1:] |= values[1:] != values[:-1]
    return first


def _first_meetings(cell: np.ndarray, earlier: list[list[int]], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of rows share none of the tokens that come before the cell's token in their prefixes."""
    keep = np.ones(len(left), bool)
    bounds = np.searchsorted(cell[left], np.arange(cell[-1] + 2))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if a == b:
            continue
        rows = np.unique(np.concatenate([left[a:b], right[a:b]]))
        before = [earlier[r] for r in rows.tolist()]
        if not any(before):
            continue
        i, j = np.searchsorted(rows, left[a:b]), np.searchsorted(rows, right[a:b])
        if b - a <= FEW:
            sets = [set(t) for t in before]
            keep[a:b] = [sets[m].isdisjoint(sets[n]) for m, n in zip(i.tolist(), j.tolist())]
        else:
            met = _incidence([np.array(t, np.int64) for t in before])
            keep[a:b] = (met @ met.T)[i, j] == 0
    return keep


def _candidates(percent: int):
    """A cell's members that have a candidate partner there, with the partners that come after them.

    The pairs of many small cells (or of one large one) are filtered at once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches):
            cell = np.cumsum(_changes(table)) - 1
            order = np.lexsort((table.column("cls").to_numpy(), cell))
            table = table.take(pa.array(order)).combine_chunks()
            ends = np.cumsum(np.bincount(cell))
            after = ends[cell] - 1 - np.arange(len(cell))
            n, at, cls = (table.column(c).to_numpy() for c in ("n", "at", "cls"))
            block = np.where(table.column("x").to_numpy() != table.column("y").to_numpy(),
                             table.column("block").to_numpy(), -1 - np.arange(len(cell)))
            sizes = np.cumsum(after)
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for lo, hi in _spans(sizes):
                left = np.repeat(np.arange(lo, hi), after[lo:hi])
                right = left + 1 + np.arange(len(left)) - np.repeat(
                    sizes[lo:hi] - after[lo:hi] - (sizes[lo - 1] if lo else 0), after[lo:hi])
                need = -(-percent * (n[left] + n[right]) // (100 + percent))
                fits = 100 * np.minimum(n[left], n[right]) >= percent * np.maximum(n[left], n[right])
                fits &= np.minimum((n - at)[left], (n - at)[right]) >= need
                # In a cell of two blocks, a pair inside one block belongs to that block's own cell.
                fits &= (block[left] != block[right]) & (cls[left] != cls[right])
                left, right, need = left[fits], right[fits], need[fits]
                if not len(left):
                    continue
                ranges = table.column("ranges").chunk(0).flatten().to_numpy().reshape(-1, RANGES).astype(np.int32)
                keep = np.abs(ranges[left] - ranges[right]).sum(axis=1) <= n[left] + n[right] - 2 * need
                left, right = left[keep], right[keep]
                if not len(left):
                    continue
                used = np.unique(np.concatenate([left, right]))
                lists = table.column("before").take(pa.array(used)).to_pylist()
                i, j = np.searchsorted(used, left), np.searchsorted(used, right)
                local = np.unique(cell[used], return_inverse=True)[1]
                keep = _first_meetings(local, lists, i, j)
                found.append((left[keep], right[keep]))
            # A span may end inside a cell: a member's row is made of the pairs of all spans.
            left, right = (np.concatenate(side) for side in zip(*found))
            if not len(left):
                continue
            member = np.unique(np.concatenate([left, right]))
            bounds = offsets(np.bincount(np.searchsorted(member, left), minlength=len(member))).astype(np.int32)
            rows = pa.array(member)
            yield pa.RecordBatch.from_arrays(
                [*(table.column(c).take(rows).combine_chunks() for c in ("token", "x", "y", "cls")),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(cls[right]))],
                ["token", "x", "y", "cls", "partners"])

    return run


def _spans(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``PAIRS`` pairs each, from running totals; every row is in one."""
    lo = 0
    while lo < len(sizes):
        done = sizes[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(sizes, done + PAIRS, side="right")), lo + 1)
        yield lo, hi
        lo = hi


def _partners(cell: pa.Table) -> dict[int, list[int]]:
    """Partners by member, of the cell's rows that list any."""
    listed = cell.filter(cell.column("partners").is_valid())
    partners: dict[int, list[int]] = {}
    for member, found in zip(listed.column("cls").to_pylist(), listed.column("partners").to_pylist()):
        partners.setdefault(member, []).extend(found)
    return partners


def _screened(percent: int):
    """A cell's members and partners without the pairs whose sketches differ by more than alike sets can.

    A difference of counts, also of 255 at most or summed over ranges, is never more than the sets differ by.
    A cell's rows hold either a member's partners or its sketch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ["token", "x", "y"]):
            partners = _partners(cell)
            given = cell.filter(cell.column("sketch").is_valid())
            ids = given.column("cls").to_pylist()
            sizes = dict(zip(ids, given.column("n").to_pylist()))
            counts = {k: np.frombuffer(v, np.uint8) for k, v in zip(ids, given.column("sketch").to_pylist())}
            short: dict[tuple[int, int], np.ndarray] = {}
            kept: dict[int, list[int]] = {}
            for member, found in partners.items():
                if not found:
                    continue
                # Sizes of candidates differ little, so their sketches by one folding at most.
                length = min(len(counts[k]) for k in (member, *found))
                for k in (member, *found):
                    if (k, length) not in short:
                        short[k, length] = folded(counts[k], length)
                both = sizes[member] + np.array([sizes[k] for k in found], np.int64)
                apart = np.abs(np.stack([short[k, length] for k in found]) - short[member, length]).sum(axis=1)
                fits = apart <= both - 2 * -(-percent * both // (100 + percent))
                for k in [k for k, fit in zip(found, fits.tolist()) if fit]:
                    kept.setdefault(member, []).append(k)
                    kept.setdefault(k, [])
            if kept:
                n = len(kept)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([cell.column(c)[0].as_py()] * n, kind)
                       for c, kind in (("token", pa.int64()), ("x", pa.int32()), ("y", pa.int32()))),
                     pa.array(list(kept), pa.int64()), pa.array(list(kept.values()), pa.list_(pa.int64()))],
                    ["token", "x", "y", "cls", "partners"])

    return run


def _verify(percent: int):
    """Sums of a cell's links by member, and each member's smallest linked member.

    A cell's rows hold either a member's partners or its set.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ["token", "x", "y"]):
            partners = _partners(cell)
            cell = cell.filter(cell.column("hashes").is_valid())
            ids, first = np.unique(cell.column("cls").to_numpy(), return_index=True)
            cell = cell.take(pa.array(first)).combine_chunks()
            sets = cell.column("hashes").chunk(0)
            bounds = sets.offsets.to_numpy()
            # Small codes take the place of the hashes, so a cell is held once.
            codes = np.unique(sets.values.to_numpy()[bounds[0]:bounds[-1]], return_inverse=True)[1].astype(np.int32)
            bounds = bounds - bounds[0]
            sizes, copies = np.diff(bounds), cell.column("copies").to_numpy().copy()
            del sets, cell
            has = np.zeros(int(codes.max()) + 1 if len(codes) else 1, bool)
            links, classes = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            root = np.arange(len(ids))
            for i, member in enumerate(ids.tolist()):
                if not partners.get(member):
                    continue
                own = codes[bounds[i]:bounds[i + 1]]
                has[own] = True
                others = np.searchsorted(ids, np.array(partners[member]))
                both = np.array([np.count_nonzero(has[codes[bounds[j]:bounds[j + 1]]]) for j in others])
                has[own] = False
                others = others[100 * both >= percent * (sizes[i] + sizes[others] - both)]
                links[i] += copies[others].sum()
                links[others] += copies[i]
                classes[i] += len(others)
                classes[others] += 1
                for j in others.tolist():
                    a, b = i, j
                    while root[a] != a:
                        root[a] = a = root[root[a]]
                    while root[b] != b:
                        root[b] = b = root[root[b]]
                    root[max(a, b)] = min(a, b)
            for k in range(len(root)):
                root[k] = root[root[k]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(ids[root]), pa.array(links), pa.array(classes)],
                ["cls", "root", "links", "classes"])

    return run


def _cells(candidates: DataFrame) -> DataFrame:
    """Keys of the cells and the classes wanted there, broadcast by hint if counted small."""
    cells = candidates.select("token", "x", "y", "cls")
    return F.broadcast(cells) if can_broadcast(cells.count(), 32) else cells


def jaccard_join(docs: DataFrame, size: int = 3, percent: int = 90, id_col: str = "doc_id",
                 text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``n_links`` (other documents linked directly).

    Two documents link when ``100 * intersection >= percent * union`` of their shingle sets.
    """
    # Every step with Python workers is written inside the block.
    with bounded_batches(docs.sparkSession, BATCH_BYTES):
        return _join(docs, size, percent, id_col, text_col, block)


def _join(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str, block: int) -> DataFrame:
    rows = written(_sets(docs, size, id_col, text_col), "sets")
    found = rows.where("n IS NOT NULL").select("id", "n", "m1", "m2")
    counted = (rows.where("buckets IS NOT NULL").select(F.inline(F.arrays_zip("buckets", "counts")))
               .groupBy("buckets").agg(F.sum("counts").alias("counts")).toArrow())
    table = np.zeros(1 << SKETCH_BITS, np.int64)
    table[counted.column("buckets").to_numpy()] = counted.column("counts").to_numpy()

    classes = written(found.where("n > 0").groupBy("m1", "m2", "n")
                      .agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
                      .withColumn("cls", F.monotonically_increasing_id()), "classes")
    named = classes.select("m1", "m2", "cls", "n", "rep")
    if can_broadcast(classes.count(), 48):
        named = F.broadcast(named)
    prefixes = written(_prefixes(docs, size, percent, table, id_col, text_col)
                       .join(named, ["m1", "m2"]).where("id <=> rep")
                       .select("cls", "n", "ranges", "sketch", "tokens"), "prefixes")
    places = prefixes.select("cls", "n", F.posexplode("tokens").alias("at", "token"))
    held = F.xxhash64("cls")
    # Number, ends and two sums name the classes of a token; a repeated row counts in all of its tokens.
    owners = [F.count("*").alias("rows"), F.min("cls").alias("low"), F.max("cls").alias("high"),
              F.sum(held.bitwiseAND(F.lit(0xFFFFFFFF))).alias("one"), F.sum(F.shiftrightunsigned(held, 32)).alias("two")]
    shared = written(places.groupBy("token").agg(*owners, F.min("at").alias("at")).where("low < high"), "shared")
    # The order of tokens is one for all, so of the same owners' tokens the least place is the first everywhere.
    kept = written(shared.groupBy("rows", "low", "high", "one", "two").agg(F.min_by("token", "at").alias("token"))
                   .select("token", F.ceil(F.col("rows") / block).cast("int").alias("blocks")), "kept")
    # Of classes in order of size the neighbours are the likest; rows of cells that are cut into blocks all stay.
    near = Window.partitionBy("token", F.when(F.col("blocks") > 1, F.col("cls"))).orderBy("n")
    met = (places.join(kept.hint("merge"), "token")
           .withColumns({"less": F.lag("n").over(near), "more": F.lead("n").over(near)})
           .where((F.col("blocks") > 1) | (100 * F.col("less") >= percent * F.col("n"))
                  | (100 * F.col("n") >= percent * F.col("more"))))
    members = (met.groupBy("cls").agg(F.array_sort(F.collect_set(F.struct("at", "token", "blocks"))).alias("found"))
               .join(prefixes.select("cls", "n", "ranges", "sketch").dropDuplicates(["cls"]), "cls"))
    # A row carries the kept part of its own prefix before the token, to know first meetings.
    members = written(members.select("cls", "n", "ranges", "sketch", "found", F.col("found.token").alias("tokens")),
                      "members")
    cells = (members.select("cls", "n", "ranges", "tokens", F.posexplode("found").alias("place", "own"))
             .select("cls", "n", "ranges", "own.*", F.slice("tokens", F.lit(1), F.col("place")).alias("before"))
             .withColumn("block", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("token", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                     "block", "cls", "n", "at", "ranges", "before"))
    key = ["token", "x", "y"]
    candidates = written(
        cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(
            _candidates(percent), PARTNERS), "candidates")
    none = F.lit(None)
    # Sketches and sets meet the cells they are wanted in, by the cells' keys alone; partners reach the cell on their own.
    cells = _cells(candidates)
    sketches = members.select("cls", "n", "sketch").join(cells, "cls").select(
        *key, "cls", "n", none.cast("array<long>").alias("partners"), "sketch")
    listed = candidates.select(*key, "cls", none.cast("long").alias("n"), "partners", none.cast("binary").alias("sketch"))
    candidates = written(
        sketches.union(listed).repartition(*key).sortWithinPartitions(*key).mapInArrow(
            _screened(percent), PARTNERS), "screened")

    wanted = written(candidates.select("cls").distinct().join(classes, "cls"), "wanted")
    ids = wanted.select(F.col("rep").alias(id_col)).distinct()
    number = wanted.count()
    if can_broadcast(number, 16):
        ids = F.broadcast(ids)
    texts = docs.select(F.col(id_col).cast("long").alias(id_col), text_col)
    texts = texts.join(ids, texts[id_col].eqNullSafe(ids[id_col]), "left_semi")
    if can_broadcast(number, 64):
        wanted = F.broadcast(wanted)
    sets = (_whole(texts, size, id_col, text_col).join(wanted, ["m1", "m2"]).join(_cells(candidates), "cls")
            .select(*key, "cls", "copies", none.cast("array<long>").alias("partners"), "hashes"))
    listed = candidates.select(*key, "cls", none.cast("long").alias("copies"), "partners",
                               none.cast("array<long>").alias("hashes"))
    verified = written(
        sets.union(listed).repartition(*key).sortWithinPartitions(*key).mapInArrow(
            _verify(percent), "cls long, root long, links long, classes long"), "verified")
    labels = components(verified.where("classes > 0").select(F.col("cls").alias("a"), F.col("root").alias("b")))
    linked = verified.groupBy("cls").agg(F.sum("links").alias("links"))
    named = written(classes.join(linked, "cls", "left")
                    .join(labels.withColumnRenamed("id", "cls"), "cls", "left")
                    .withColumn("label", F.coalesce("label", "cls")), "named")
    least = written(named.groupBy("label").agg(F.min("rep").alias("component_id")), "least")
    by_class = written(named.join(least, "label").select(
        "m1", "m2", "component_id",
        (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links")), "by-class")
    full = found.where("n > 0").join(by_class, ["m1", "m2"]).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "n_links")
    empty = found.where("n = 0").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"))
    return full.unionByName(empty)
