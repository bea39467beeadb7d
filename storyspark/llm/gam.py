"""Quality classifier: a generalised additive model with pairwise interactions (operator 6).

Text statistics are generated code in one scan. The model is learned on a bounded sample of labelled
rows (``TRAIN_ROWS``): features are cut into quantile bins, and cyclic boosting visits the features in
turn, each time adding a small tree's leaf values to that feature's lookup table; then the pairs with
the largest gain on the residuals are boosted the same way on coarse two-way tables. A score adds up
one table entry per feature and pair for a whole batch at once.

Defined cases: a null or empty text has zero statistics and a score like any other; rows without a
label, with a null label or id are not learned from; without any labelled row the score is 0.5;
repeated rows are scored alike; other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyspark.llm.common import let, words
from storyspark.session import written

#: Labelled rows learned from at most, taken in hash order of their ids.
TRAIN_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, SMOOTH = 150, 60, 0.1, 4, 5.0


def statistics(text: Column) -> dict[str, Column]:
    """Named features, in terms of a struct made by ``measure``."""
    m = text
    n, chars, lines = m["n"] + 5.0, m["chars"] + 20.0, m["lines"] + 1.0
    return {
        "length": F.log1p(m["n"].cast("double")), "word_length": m["word_chars"] / n,
        "capitals": m["capitals"] / chars, "symbols": m["symbols"] / n, "exclaims": m["exclaims"] / n,
        "digits": m["digits"] / chars, "stops": m["stops"] / n, "bars": m["bars"] / n,
        "distinct": m["distinct"] / n, "same_as_before": m["same"] / n, "line_length": m["n"] / lines,
        "copied_lines": m["copied"] / lines, "non_letters": m["others"] / chars, "links": m["links"] / n,
    }


def measure(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    def of_words(found: Column) -> Column:
        return F.struct(
            F.size(found).alias("n"), F.char_length(F.array_join(found, "")).alias("word_chars"),
            F.size(F.array_distinct(found)).alias("distinct"),
            F.size(F.filter(found, lambda w, k: F.coalesce(F.get(found, k - 1) == w, F.lit(False)))).alias("same"),
            F.char_length(text).alias("chars"), count(r"[A-ZÀ-ÖØ-Þ]").alias("capitals"),
            count(r"[#*$%&<>]").alias("symbols"), count("!").alias("exclaims"), count("[0-9]").alias("digits"),
            count(r"[.?]").alias("stops"), count(r"\|").alias("bars"), count(r"[^\p{L}\s]").alias("others"),
            count(r"https?://|@").alias("links"), F.size(lines).alias("lines"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("copied"))

    return let(words(text), of_words)


@dataclass
class Model:
    names: list[str]
    cuts: list[np.ndarray]
    start: float
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[k], x[:, k], side="right")]
        coarse = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(self.coarse)] if self.pairs else []
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SMOOTH)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values by bin of the best tree of ``LEAVES`` leaves over ordered bins."""
    edges = [0, len(g)]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(edges) <= LEAVES:
        best = (1e-9, None)
        for a, b in zip(edges[:-1], edges[1:]):
            at = np.arange(a + 1, b)
            if len(at):
                gains = (_gain(cg[at] - cg[a], ch[at] - ch[a]) + _gain(cg[b] - cg[at], ch[b] - ch[at])
                         - _gain(cg[b] - cg[a], ch[b] - ch[a]))
                k = int(np.argmax(gains))
                best = max(best, (float(gains[k]), int(at[k])), key=lambda t: t[0])
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(edges[:-1], edges[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + SMOOTH)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best gain of one cut on each axis of a two-way table, and the four leaves' values."""
    cg, ch = (np.pad(t.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for t in (g, h))
    best, leaves = -1.0, np.zeros_like(g)
    for a in range(1, g.shape[0]):
        for b in range(1, g.shape[1]):
            parts = [(slice(0, a), slice(0, b)), (slice(0, a), slice(b, None)),
                     (slice(a, None), slice(0, b)), (slice(a, None), slice(b, None))]
            sums = [(c[a, b], c[a, -1] - c[a, b], c[-1, b] - c[a, b], c[-1, -1] - c[a, -1] - c[-1, b] + c[a, b])
                    for c in (cg, ch)]
            gain = sum(_gain(x, y) for x, y in zip(*sums))
            if gain > best:
                best, leaves = gain, np.zeros_like(g)
                for part, x, y in zip(parts, *sums):
                    leaves[part] = x / (y + SMOOTH)
    return best, leaves


def fit(names: list[str], x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of main effects, then of the ``PAIRS`` strongest pairs."""
    if not len(y):
        return Model(names, [np.zeros(0)] * len(names), 0.0, [np.zeros(1)] * len(names), [], [], [])
    rate = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(rate / (1 - rate)))
    cuts = [_cuts(x[:, k], BINS) for k in range(len(names))]
    bins = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(y), start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, b in enumerate(bins):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b, g, len(tables[k])), np.bincount(b, h, len(tables[k])))
            tables[k] += step
            total += step[b]
    coarse = [_cuts(x[:, k], PAIR_BINS) for k in range(len(names))]
    cells = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(coarse)]
    sizes = [len(c) + 1 for c in coarse]

    def table(i: int, j: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(cells[i] * sizes[j] + cells[j], values, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = slopes()
    gains = sorted(((_quadrants(table(i, j, g), table(i, j, h))[0], i, j) for i in range(len(names))
                    for j in range(i) if min(sizes[i], sizes[j]) > 1), reverse=True)
    pairs = [(i, j) for _, i, j in gains[:PAIRS]]
    pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(pairs):
            g, h = slopes()
            step = RATE * _quadrants(table(i, j, g), table(i, j, h))[1]
            pair_tables[k] += step
            total += step[cells[i], cells[j]]
    return Model(names, cuts, start, tables, coarse, pairs, pair_tables)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the features of every row, written: texts are read once."""
    rows = docs.select(F.col(id_col).alias("doc_id"), measure(F.col(text_col)).alias("m"))
    return written(rows.select("doc_id", *[c.cast("double").alias(f) for f, c in statistics(F.col("m")).items()]),
                   "features")


def learn(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          limit: int = TRAIN_ROWS) -> Model:
    """A model from ``limit`` labelled rows at most."""
    names = [c for c in rows.columns if c != "doc_id"]
    wanted = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label_col)).alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    # The bounded sample is broadcast; of repeated ids each row is learned from, in a fixed order.
    sample = (rows.join(F.broadcast(wanted), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", *names)
              .limit(limit).select("y", *names).toArrow())
    x = np.column_stack([sample.column(f).to_numpy() for f in names]) if len(sample) else np.zeros((0, len(names)))
    return fit(names, x, sample.column("y").to_numpy().astype(float))


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of every row of features."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, batch.num_columns)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], ["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", *model.names).mapInArrow(run, f"doc_id {kind}, score double")
