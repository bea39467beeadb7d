"""Alignment of two tokenizers' tokens by diagonal run skipping (operator 11).

Both tokenizers cut the same bytes. The arrays of byte ends are walked with an index shift: from a pair
of equal ends, exponential probing compares ever longer slices of the two arrays at the current shift
and jumps over the whole one-to-one stretch. Where ends differ, the group is resolved locally, token by
token, up to the next common end, and the shift becomes what it is there. Every pair of tokens of one
group is a link.

The number of documents that hold a pair of ids linked is counted over all documents. A document's
pairs then meet their counts: pairs of a frequency that only ``HEAVY`` pairs can have are broadcast
(the counts add up to the number of rows, which bounds how many can be that frequent), the others meet
by shuffle, so no frequent pair reaches a shuffle.

Defined cases: a null or empty text, and one whose tokens on either side do not spell a space and the
text, has no tokens and no links; strings of special tokens inside a text are plain text; repeated rows
count as documents of their own; a null id stays null; other columns of the input are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from storyspark.llm.common import PRE_TOKEN, SPACE, bounded_batches, gather, offsets
from storyspark.session import written

#: Pairs whose counts are broadcast at most (24 bytes each).
HEAVY = 1 << 18
#: Links of a group that are listed one by one; larger groups are counted by distinct ids.
LISTED = 4_096
#: Pre-tokens whose ids a worker remembers before it starts afresh.
REMEMBERED = 400_000


class _Remembered(dict):
    """Numbers of words in order of appearance, and the ids of every word in one flat array."""

    def __init__(self, ask):
        super().__init__()
        self.ask, self.fresh = ask, []
        self.flat, self.ends = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        number = self[word] = len(self)
        return number

    def encode(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, given as words, and how many each text has."""
        if len(self) > REMEMBERED or len(self.flat) > 8 * REMEMBERED:
            self.clear()
            self.flat, self.ends = self.flat[:0], self.ends[:1]
        per_text = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.int64, int(per_text.sum()))
        if self.fresh:
            found, self.fresh = self.ask(self.fresh), []
            ends = self.ends[-1] + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
            fresh = np.fromiter(chain.from_iterable(found), np.int64, int(ends[-1] - self.ends[-1]))
            self.flat, self.ends = np.concatenate([self.flat, fresh]), np.concatenate([self.ends, ends])
        starts = self.ends[codes]
        sizes = self.ends[codes + 1] - starts
        return gather(self.flat, starts, sizes), np.diff(offsets(sizes)[offsets(per_text)])


class ByteLevel:
    """A byte-level ``tokenizers`` file; its tokens of a text begin with those of a space before it."""

    def __init__(self, data: bytes):
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode("utf-8"))
        self.tokenizer.encode_special_tokens = True
        # Bytes that print stand for themselves, the others for the characters from 256 on, in order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        value = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
        vocabulary = self.tokenizer.get_vocab()
        self.tokens = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, number in vocabulary.items():
            if all(c in value for c in token):
                self.tokens[number] = bytes(value[c] for c in token)

        rules = json.loads(data).get("pre_tokenizer") or {}
        self.splits = rules.get("use_regex", True) and not rules.get("add_prefix_space", False) and \
            rules.get("type") == "ByteLevel" and self.tokenizer.normalizer is None
        self.find = regex.compile(PRE_TOKEN).findall
        # The same pattern over ASCII, where the letters and digits are these.
        self.find_ascii = re.compile(PRE_TOKEN.replace(rf"[{SPACE}]", r"[\t-\r ]").replace(f"^{SPACE}", r"^\t-\r ")
                                     .replace(r" ?\p{L}", " ?[A-Za-z]").replace(r" ?\p{N}", " ?[0-9]")
                                     .replace(r"\p{L}\p{N}", "A-Za-z0-9")).findall
        self.known = _Remembered(lambda words: [
            e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has. A pre-token's ids are asked for once and remembered."""
        if not self.splits:
            return self.known.encode([[" " + t] for t in texts])
        return self.known.encode([(self.find_ascii if t.isascii() else self.find)(" " + t) for t in texts])


class Pieces:
    """A sentencepiece model, which adds the space itself."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.tokens = []
        for number in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(number)
            self.tokens.append(bytes([int(piece[3:-1], 16)]) if self.pieces.is_byte(number)
                               else piece.replace("▁", " ").encode())
        # Where no piece goes on over a space, a word's pieces depend on nothing around it.
        self.splits = not any(b" " in t.lstrip(b" ") for t in self.tokens) and self.pieces.encode("a b") == \
            self.pieces.encode("a") + self.pieces.encode("b")
        self.known = _Remembered(lambda words: self.pieces.encode(words, num_threads=1))

    def _words(self, text: str) -> list[str]:
        """Parts of a text that are encoded on their own: its words if single spaces part them."""
        if not self.splits or not text.isascii() or "  " in text or text[:1] == " " or text[-1:] == " ":
            return [text]
        return text.split(" ")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.known.encode([self._words(t) for t in texts])


def tokenizer(name: str, data: bytes) -> ByteLevel | Pieces:
    return Pieces(data) if name.endswith(".model") else ByteLevel(data)


def skip_diagonals(a: list[int], b: list[int]) -> list[tuple[int, int, int, int, bool]]:
    """Stretches ``(i, i2, j, j2, one_to_one)`` of two rising lists of ends with the same last end.

    A stretch that is not one to one is a single group.
    """
    out, i, j, n = [], 0, 0, len(a)
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            same, step = 1, 1
            # Most stretches are short, so one pair of ends is looked at before slices are.
            if i + 1 < n and a[i + 1] == b[j + 1]:
                same = 2
                while i + same < n and a[i + same:i + same + step] == b[j + same:j + same + step]:
                    same, step = min(same + step, n - i), 2 * step
                while step > 1 and i + same < n:
                    step //= 2
                    if a[i + same:i + same + step] == b[j + same:j + same + step]:
                        same += step
            out += (i, i + same, j, j + same, 1)
            i += same
            j += same
        else:
            at, to = i, j
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i += 1
            j += 1
            out += (at, i, to, j, 0)
    found = iter(out)
    return list(zip(found, found, found, found, found))


def group_ends(found: list[tuple[int, int, int, int, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups of the stretches end, in tokens of either side."""
    i, i2, j, j2, one = np.array(found, np.int64).reshape(-1, 5).T
    number = np.where(one > 0, i2 - i, 1)
    back = np.repeat(np.cumsum(number), number) - 1 - np.arange(number.sum())  # groups of the stretch still to come
    return np.repeat(i2, number) - back, np.repeat(j2, number) - back


def linked_pairs(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, row: np.ndarray,
                 width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, pair) of linked tokens, as rows and ``a * width + b``, and how often each is linked.

    ``row`` is the text that a group belongs to.
    """
    n, m = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
    small = n * m <= LISTED
    ids_a = gather(a, (a_ends - n)[small], n[small])
    left = np.repeat(ids_a, np.repeat(m[small], n[small]))
    links = (n * m)[small]
    place = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links, links)
    right = b[np.repeat((b_ends - m)[small], links) + place % np.repeat(m[small], links)]
    # A row and a pair in one number sort faster than two keys.
    span = width * (int(a.max(initial=0)) + 1)
    keys, times = np.unique(np.repeat(row[small], links) * span + (left * width + right), return_counts=True)
    if not small.all():
        more, often = [keys], [times]
        for k in np.flatnonzero(~small).tolist():
            x, once = np.unique(a[a_ends[k] - n[k]:a_ends[k]], return_counts=True)
            y, much = np.unique(b[b_ends[k] - m[k]:b_ends[k]], return_counts=True)
            more.append(row[k] * span + (x[:, None] * width + y).ravel())
            often.append((once[:, None] * much).ravel())
        keys, place = np.unique(np.concatenate(more), return_inverse=True)
        times = np.zeros(len(keys), np.int64)
        np.add.at(times, place, np.concatenate(often))
    return keys // span, keys % span, times


class _Side:
    """One tokenizer in a worker: bytes and names of its tokens."""

    def __init__(self, name: str, data: bytes, last: str):
        self.tool = tokenizer(name, data)
        self.sizes = np.array([len(t) for t in self.tool.tokens], np.int64)
        self.starts = offsets(self.sizes)[:-1]
        self.bytes = np.frombuffer(b"".join(self.tool.tokens), np.uint8)
        self.number = len(self.tool.tokens)
        # Names as they stand inside a group, and at the end of this side of it.
        self.names = [f"{k}," for k in range(self.number)] + [f"{k}{last}" for k in range(self.number)]

    def spelled(self, ids: np.ndarray, counts: np.ndarray, wholes: list[bytes]) -> np.ndarray:
        """Which texts the bytes of their ids spell."""
        ends = offsets(self.sizes[ids])[offsets(counts)]
        data = gather(self.bytes, self.starts[ids], self.sizes[ids]).tobytes()
        return np.array([data[x:y] == w for x, y, w in zip(ends[:-1].tolist(), ends[1:].tolist(), wholes)], bool)


def _aligned(one: _Side, two: _Side, texts: list[str]):
    """Numbers of tokens, groups and links, groups, and linked pairs, of every text of a batch.

    The texts are laid end to end: the last ends of a text are equal on both sides, so no group crosses.
    """
    sides = [(side, *side.tool.encode(texts)) for side in (one, two)]
    wholes = [b" " + t.encode() for t in texts]
    good = np.array([bool(t) for t in texts], bool)
    for side, ids, counts in sides:
        good &= side.spelled(ids, counts, wholes)
    (a, n_a), (b, n_b) = ((ids[np.repeat(good, counts)], np.where(good, counts, 0)) for _, ids, counts in sides)
    found = skip_diagonals(np.cumsum(one.sizes[a]).tolist(), np.cumsum(two.sizes[b]).tolist())
    a_ends, b_ends = group_ends(found)
    row = np.searchsorted(np.cumsum(n_a), a_ends)
    groups = np.bincount(row, minlength=len(texts))
    # The groups' tokens in order: those of a, then those of b.
    names = np.zeros(len(a) + len(b), np.int64)
    n, m = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
    names[np.arange(len(a)) + np.repeat(b_ends - m, n)] = a
    names[np.arange(len(b)) + np.repeat(a_ends, m)] = b + 2 * one.number
    names[a_ends + b_ends - m - 1] += one.number
    names[a_ends + b_ends - 1] += two.number
    table, names = one.names + two.names, names.tolist()
    cuts = offsets(n_a + n_b).tolist()
    shown = ["".join([table[k] for k in names[x:y]])[:-1] for x, y in zip(cuts[:-1], cuts[1:])]
    of, pairs, times = linked_pairs(a, b, a_ends, b_ends, row, two.number)
    links = np.bincount(of, times, len(texts)).astype(np.int64)
    return n_a, n_b, groups, links, shown, offsets(np.bincount(of, minlength=len(texts))), pairs, times


def align(docs: DataFrame, left_path: str, right_path: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (text), and ``pairs`` with ``times``:
    the distinct linked pairs (``a * width + b``; ``width`` is the number of right ids) and how often each is linked."""
    files = []
    for path in (left_path, right_path):
        with open(path, "rb") as file:
            files.append((path.rsplit("/", 1)[-1], file.read()))
    shared = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = (_Side(*f, last) for f, last in zip(shared.value, "|;"))
        for batch in batches:
            *numbers, shown, bounds, pairs, times = _aligned(one, two, [t or "" for t in batch.column(1).to_pylist()])
            bounds = pa.array(bounds.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, numbers), pa.array(shown, pa.string()),
                 *(pa.ListArray.from_arrays(bounds, pa.array(v)) for v in (pairs, times))],
                [id_col, "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(
        run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
             "groups string, pairs array<long>, times array<long>")


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair``, ``n_docs`` (rows that hold it linked), ``best`` (no pair of its left id has more)."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs"))
    # A left id has one row per right id at most.
    most = F.max("n_docs").over(Window.partitionBy(F.expr(f"pair div {width}")))
    return counts.select("pair", "n_docs", (F.col("n_docs") == most).alias("best"))


def count_links(aligned: DataFrame, width: int, heavy: int = HEAVY) -> DataFrame:
    """A written ``aligned`` without its pairs, with ``n_best`` (links whose pair is the best of its left id)
    and ``count_sum`` (the pairs' counts, summed over links). ``_row`` names its rows."""
    counts = written(pair_counts(aligned, width), "pair-counts")
    total = counts.agg(F.sum("n_docs")).first()[0] or 0
    frequent = F.col("n_docs") >= -(-total // heavy)  # at most `heavy` pairs
    links = aligned.select("_row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
    often = F.broadcast(counts.where(frequent))
    rest = links.join(F.broadcast(counts.where(frequent).select("pair")), "pair", "left_anti")
    met = links.join(often, "pair").unionByName(rest.join(counts.where(~frequent), "pair"))
    sums = met.groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"),
                                   F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"))
    none = F.lit(0).cast("long")
    return (aligned.drop("pairs", "times").join(sums, "_row", "left")
            .withColumn("n_best", F.coalesce("n_best", none)).withColumn("count_sum", F.coalesce("count_sum", none)))


def aligned_digests(docs: DataFrame, left_path: str, right_path: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """A written ``align`` with ``groups_sha256`` in place of the groups, and ``_row``; batches bounded in bytes."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    with bounded_batches(docs.sparkSession, 4 << 20):
        return written(align(docs, left_path, right_path, id_col, text_col)
                       .withColumn("groups_sha256", digest).drop("groups")
                       .withColumn("_row", F.monotonically_increasing_id()), "aligned")


def right_ids(path: str) -> int:
    """The number of ids of a tokenizer file: the ``width`` of a pair when it is the right one."""
    with open(path, "rb") as file:
        return len(tokenizer(path, file.read()).tokens)
