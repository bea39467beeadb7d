"""Secret scans by a linear-chain conditional random field (operator 10).

A text is cut into tokens: runs of value characters and runs of other visible characters. Each token
has a few categorical features (shape, length, key word, its neighbours' kinds, and how assignment-like
the file is), and a field with the tags outside, begin and inside scores them. Weights are learned by
maximum likelihood on a bounded sample of windows whose tags come from the base patterns, and Viterbi
decodes whole texts. Tokens that are outside on every best path, by a bound over all neighbouring tags,
cut a text into short stretches that are decoded side by side; this loses nothing. The base patterns'
spans always stay and the field adds spans of its own that touch none of them.

Everything happens where a text is read; nothing is shuffled. A batch is worked through in slices of
about ``SLICE`` bytes (a longer text is a slice of its own), so memory follows the longest text.

Defined cases: a null or empty text has no spans and is returned as it is; without any text to learn
from the field adds nothing; repeated rows give repeated results; a null id stays null; other columns
of the input are carried by ``redact`` and ignored by ``scan_secrets``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyspark.llm.common import small_batches
from storyspark.session import written

# FIXED: base patterns, the group that holds the secret and the least characters of that group.
KINDS = (("assign", rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
         ("access", rb"AKIA[A-Z0-9]+", 0, 16), ("hex", rb"[0-9a-f]+", 0, 32))
#: The field's own kind, listed after the base kinds, and the least characters of its spans.
OWN, OWN_LENGTH = "field", 12
#: What a secret becomes in redacted texts.
REDACTED = "[secret]"
#: Documents sampled by id hash, windows kept with and without a secret, bytes around a window's middle.
TRAIN_DOCUMENTS, TRAIN_WINDOWS, AROUND = 40_000, 1_500, 160
STEPS, RATE, DECAY = 80, 0.15, 1e-3
SLICE = 1 << 20
O, B, I = 0, 1, 2

# FIXED: words that name secrets; eight bytes at most.
WORDS = ("password", "passwd", "pwd", "secret", "token", "api", "key", "apikey", "api_key", "auth", "bearer", "access",
         "private", "client")
_CODES = np.sort(np.array([int.from_bytes(w.encode().ljust(8, b"\0"), "little") for w in WORDS], np.uint64))
_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_VALUE = _DIGIT | _UPPER | _LOWER | (_BYTES >= 128) | np.isin(_BYTES, list(b"+/_-"))
_CLASS = np.where((_BYTES <= 32), 0, np.where(_VALUE, 1, 2)).astype(np.uint8)
_SHAPE = np.select([_DIGIT, _UPPER, _LOWER, _BYTES >= 128, _VALUE], [1, 2, 3, 4, 5], 0).astype(np.uint8)
_FOLD = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
_HEX = _DIGIT | ((_BYTES >= 97) & (_BYTES <= 102))
#: Number of values of each feature, see ``features``.
SIZES = (9, 32, 5, 2, 2, 4, 4, 4, 4, 2, 2, 2, 4)


def base_spans(text: bytes) -> list[tuple[int, int, int, int]]:
    """``(start, kind, end, secret start)`` in bytes, by start and then kind."""
    found = []
    for kind, (_, pattern, group, least) in enumerate(_COMPILED):
        found += [(m.start(), kind, m.end(), m.start(group)) for m in pattern.finditer(text)
                  if m.end(group) - m.start(group) >= least]
    return sorted(found)


def _compiled():
    for name, pattern, group, least in KINDS:
        # A run that must have n characters is searched as such; runs are maximal either way.
        if group == 0:
            pattern = pattern[:-1] + b"{%d,}" % (least - (4 if name == "access" else 0))
        yield name, re.compile(pattern, re.I if group else 0), group, least


_COMPILED = tuple(_compiled())


class Tokens:
    """Tokens of texts that are joined by line breaks."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        kinds = _CLASS[self.data]
        edge = np.flatnonzero(np.diff(kinds, prepend=np.uint8(0)))
        starts = edge[kinds[edge] > 0]
        ends = np.append(edge, len(kinds))[np.searchsorted(edge, starts) + 1]
        self.starts, self.ends, self.visible = starts, ends, kinds[starts]
        self.text_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[:len(texts)]
        self.text_of = np.searchsorted(self.text_starts, starts, side="right") - 1

    def __len__(self) -> int:
        return len(self.starts)

    def _counts(self, flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
        return total[self.ends] - total[self.starts]

    def _near(self, values: np.ndarray, step: int) -> np.ndarray:
        """Values ``step`` tokens further, 0 outside the text."""
        out = np.zeros_like(values)
        if step < 0:
            out[-step:] = np.where(self.text_of[-step:] == self.text_of[:step], values[:step], 0)
        else:
            out[:-step] = np.where(self.text_of[step:] == self.text_of[:-step], values[step:], 0)
        return out

    def features(self, n_texts: int, file_kind: np.ndarray | None = None) -> np.ndarray:
        """One row of category numbers per token, below ``SIZES``."""
        size = self.ends - self.starts
        shape = _SHAPE[self.data]
        has = [self._counts(shape == k) > 0 for k in (1, 2, 3, 4, 5)]
        change = np.diff(shape, prepend=np.uint8(0)) != 0
        changes = np.maximum(self._counts(change) - change[self.starts], 0)
        hexes = (self._counts(_HEX[self.data]) == size) & has[0] & (size >= 16)
        code = np.zeros(len(size), np.uint64)
        last = len(self.data) - 1
        for k in range(8):
            byte = _FOLD[self.data[np.minimum(self.starts + k, last)]].astype(np.uint64)
            code |= np.where(size > k, byte << np.uint64(8 * k), np.uint64(0))
        named = (np.isin(code, _CODES) & (size <= 8)).astype(np.int64)
        first = self.data[self.starts]
        access = (size >= 12) & (code & np.uint64(0xFFFFFFFF) == np.uint64(int.from_bytes(b"akia", "little"))) & (first == 65)
        sets = np.isin(self.data, list(b"=:"))
        punctuation = np.where(self.visible == 1, 1, np.where(self._counts(sets) > 0, 2, 3))
        if file_kind is None:
            share = np.bincount(self.text_of, self._counts(sets) > 0, n_texts) / np.maximum(
                np.bincount(self.text_of, minlength=n_texts), 1)
            file_kind = np.searchsorted([0.001, 0.02, 0.1], share)
        self.file_kind = file_kind
        length = np.searchsorted([3, 5, 8, 12, 16, 24, 32, 48], size, side="right")
        bits = sum(h.astype(np.int64) << k for k, h in enumerate(has))
        return np.stack([
            length, bits, np.searchsorted([1, 2, 4, 8], changes, side="right"), hexes, named,
            np.where(self.visible == 1, 0, punctuation),
            self._near(punctuation, -1), self._near(punctuation, -2), self._near(punctuation, 1),
            self._near(named, -1) , self._near(named, -2) | self._near(named, -3), access, file_kind[self.text_of],
        ], axis=1).astype(np.int64)


class Field:
    """Weights by feature value and tag, and between tags."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 3), np.float32)
        for k, base in enumerate(_BASES):
            out += self.weights[base + features[:, k]]
        return out

    def viterbi(self, scores: np.ndarray, text_of: np.ndarray) -> np.ndarray:
        """The best tags; texts start and end next to a silent outside tag."""
        moves = self.moves
        tags = np.zeros(len(scores), np.int8)
        open_ = np.zeros(len(scores), bool)
        for k in (B, I):
            # The most that tag k can win over outside, whatever stands on both sides.
            most = (moves[:, k] - moves[:, O]).max() + (moves[k] - moves[O]).max()
            open_ |= scores[:, k] + most >= scores[:, O]
        at = np.flatnonzero(open_)
        if not len(at):
            return tags
        cut = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(text_of[at], prepend=-1) != 0))
        first, length = at[cut], np.diff(np.append(cut, len(at)))
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        best = scores[first] + moves[O]
        back = np.zeros((len(scores), 3), np.int8)
        running = len(first)
        for t in range(1, int(length[0])):
            running = int(np.searchsorted(-length, -t, side="left"))
            step = best[:running, :, None] + moves
            back[first[:running] + t] = step.argmax(1)
            best[:running] = step.max(1) + scores[first[:running] + t]
        tag = (best + moves[:, O]).argmax(1)
        for t in range(int(length[0]) - 1, -1, -1):
            running = int(np.searchsorted(-length, -t, side="left"))
            place = first[:running] + t
            tags[place] = tag[:running]
            tag[:running] = back[place, tag[:running]]
        return tags


_BASES = np.concatenate([[0], np.cumsum(SIZES)])[:-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit(windows: list[tuple[bytes, int, list[tuple[int, int]]]]) -> Field | None:
    """Maximum likelihood on ``(text, file kind, secret spans in bytes)``; None without windows."""
    if not windows:
        return None
    tokens = Tokens([w[0] for w in windows])
    if not len(tokens):
        return None
    features = tokens.features(len(windows), np.array([w[1] for w in windows]))
    tags = np.zeros(len(tokens), np.int64)
    for k, (_, _, spans) in enumerate(windows):
        for start, end in spans:
            lo, hi = np.searchsorted(tokens.starts, tokens.text_starts[k] + np.array([start, end]))
            tags[lo:hi] = I
            tags[lo:lo + 1] = B if hi > lo else tags[lo:lo + 1]
    n = np.bincount(tokens.text_of, minlength=len(windows))
    width, place = int(n.max()), np.arange(len(tokens)) - np.concatenate([[0], np.cumsum(n)])[tokens.text_of]
    real = np.zeros((len(windows), width), bool)
    real[tokens.text_of, place] = True
    gold = np.zeros((len(windows), width), np.int64)
    gold[tokens.text_of, place] = tags
    weights, moves = np.zeros((sum(SIZES), 3)), np.zeros((3, 3))
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in (weights, moves)]
    index = features + _BASES
    inside = real[:, 1:]
    for step in range(1, STEPS + 1):
        scores = np.zeros((len(windows), width, 3))
        scores[tokens.text_of, place] = weights[index].sum(1)
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0] + moves[O]
        for t in range(1, width):
            now = scores[:, t] + _log_sum(ahead[:, t - 1, :, None] + moves, 1)
            ahead[:, t] = np.where(real[:, t, None], now, ahead[:, t - 1])
        behind[:, -1] = moves[:, O]
        for t in range(width - 2, -1, -1):
            now = _log_sum(moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(real[:, t + 1, None], now, behind[:, t + 1])
        total = _log_sum(ahead[:, -1] + moves[:, O], 1)
        odds = np.exp(ahead + behind - total[:, None, None])[tokens.text_of, place]
        both = np.exp(ahead[:, :-1, :, None] + moves + (scores + behind)[:, 1:, None, :] - total[:, None, None, None])
        seen = np.zeros((3, 3))
        np.add.at(seen, (gold[:, :-1][inside], gold[:, 1:][inside]), 1)
        miss = np.eye(3)[tags] - odds
        slope = np.stack([np.bincount(index.ravel(), np.repeat(miss[:, k], index.shape[1]), sum(SIZES)) for k in range(3)], 1)
        slopes = [slope / len(windows) - DECAY * weights,
                  (seen - both[inside].sum(0)) / len(windows) - DECAY * moves]
        for w, g, (m, v) in zip((weights, moves), slopes, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Field(weights.astype(np.float32), moves.astype(np.float32))


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    first, held = 0, 0
    for k, text in enumerate(texts):
        if held and held + len(text) > SLICE:
            yield first, k
            first, held = k, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


def find(texts: list[bytes], field: Field | None) -> Iterator[list[tuple[int, int, int, int]]]:
    """``(start, kind, end, secret start)`` in bytes for every text; the field's kind is ``len(KINDS)``."""
    for first, end in _slices(texts):
        part = texts[first:end]
        spans = [base_spans(t) for t in part]
        tokens = Tokens(part) if field else None
        if field and len(tokens):
            tags = field.viterbi(field.emissions(tokens.features(len(part))), tokens.text_of)
            at = np.flatnonzero(tags)
            opens = (tags[at] == B) | (np.diff(at, prepend=-2) != 1) | (np.diff(tokens.text_of[at], prepend=-1) != 0)
            cut = np.flatnonzero(opens)
            for a, b in zip(at[cut].tolist(), at[np.append(cut[1:], len(at)) - 1].tolist() if len(at) else []):
                k = int(tokens.text_of[a])
                start, stop = int(tokens.starts[a] - tokens.text_starts[k]), int(tokens.ends[b] - tokens.text_starts[k])
                if len(part[k][start:stop].decode(errors="replace")) >= OWN_LENGTH and not any(
                        s[0] < stop and start < s[2] for s in spans[k]):
                    spans[k].append((start, len(KINDS), stop, start))
        yield from (sorted(s) for s in spans)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field | None:
    """The field, from windows of at most about ``TRAIN_DOCUMENTS`` documents sampled by id hash."""
    small_batches(docs.sparkSession)
    share = min(1.0, TRAIN_DOCUMENTS / max(docs.count(), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for order, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans = base_spans(text)
                tokens = Tokens([text])
                if not len(tokens):
                    continue
                tokens.features(1)
                middle = spans[0][3] if spans else int(tokens.starts[order % len(tokens)])
                lo = int(tokens.starts[np.searchsorted(tokens.starts, middle - AROUND)])
                last = max(int(np.searchsorted(tokens.ends, middle + AROUND, side="right")) - 1, 0)
                hi = max(int(tokens.ends[last]), spans[0][2] if spans else 0)
                near = [(max(s[3], lo) - lo, min(s[2], hi) - lo) for s in spans if s[3] < hi and s[2] > lo]
                out.append((order, bool(near), text[lo:hi], int(tokens.file_kind[0]), [list(s) for s in near]))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.bool_(), pa.binary(), pa.int64(),
                                                         pa.list_(pa.list_(pa.int64()))])],
                ["h", "secret", "text", "file_kind", "spans"])

    rows = docs.select(F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).cast("binary").alias("text"))
    windows = rows.where((F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20))) & F.col("text").isNotNull()).mapInArrow(
        run, "h long, secret boolean, text binary, file_kind long, spans array<array<long>>")
    windows = written(windows, "secret-windows")
    # Windows of equal hash (repeated ids) are ordered by their text.
    found = [r for secret in (True, False) for r in windows.where(F.col("secret") == secret)
             .orderBy("h", "text").limit(TRAIN_WINDOWS).collect()]
    if not any(r.secret for r in found):
        return None
    return fit([(bytes(r.text), r.file_kind, [tuple(s) for s in r.spans]) for r in found])


def _names() -> list[str]:
    return [k[0] for k in KINDS] + [OWN]


def _points(text: bytes, spans: list) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in code points."""
    out, done, points = [], 0, 0
    places = {}
    for place in sorted({p for s in spans for p in (s[0], s[2])}):
        points += len(text[done:place].decode(errors="replace"))
        places[place], done = points, place
    for start, kind, end, _ in spans:
        out.append((kind, places[start], places[end]))
    return sorted(out, key=lambda s: (s[1], s[0]))


def scan_secrets(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col`` and ``found``: (kind, start, end) of every span, by start and then kind, in code points."""
    small_batches(docs.sparkSession)
    shared, names = docs.sparkSession.sparkContext.broadcast(field), _names()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            rows = [[{"kind": names[k], "start": a, "end": b} for k, a, b in _points(t, s)]
                    for t, s in zip(texts, find(texts, shared.value))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, span)], [id_col, "found"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, found array<struct<kind string, start long, end long>>")


def redact(docs: DataFrame, field: Field | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with the secret of every span replaced; key words and quotes around it stay."""
    small_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(field), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(at).to_pylist()
            texts = [(t or "").encode() for t in given]
            out = []
            for old, text, spans in zip(given, texts, find(texts, shared.value)):
                if not spans:
                    out.append(old)
                    continue
                kept, done = [], 0
                for start, end in sorted((s[3], s[2]) for s in spans):
                    if start >= done:
                        kept += [text[done:start], REDACTED.encode()]
                    done = max(done, end)
                out.append((b"".join(kept) + text[done:]).decode())
            columns = list(batch.columns)
            columns[at] = pa.array(out, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
