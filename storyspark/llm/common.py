"""Helpers shared by the operators: inputs, fixed patterns, Arrow batch size, ragged arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows per Arrow batch sent to Python workers: texts can be long, so a batch stays a few MB.
ARROW_ROWS = 400
# A side of a join is broadcast by hint only when it was counted and is below this size.
BROADCAST_BYTES = 32 << 20

# FIXED: white space of the pre-token pattern (the Unicode White_Space property).
SPACE = r"\t-\r \x85\xA0  -     　"
# FIXED: the pre-token pattern of the byte-level vocabularies; possessive only for speed.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++| ?\p{N}++"
             rf"| ?[^{SPACE}\p{{L}}\p{{N}}]++|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``ARROW_ROWS``: it is read when a job starts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


@contextmanager
def bounded_batches(spark: SparkSession, size: int = 16 << 20) -> Iterator[None]:
    """Jobs of the block send Arrow batches of at most ``ARROW_ROWS`` rows and about ``size`` bytes.

    A text beyond ``size`` is a batch of its own. The caller's settings come back afterwards, so only
    jobs that run inside the block (a written table) are bounded.
    """
    prefix = "spark.sql.execution.arrow."
    wanted = {prefix + "maxRecordsPerBatch": ARROW_ROWS, prefix + "maxBytesPerBatch": size}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; none for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[ \t-\r]+"))


def pre_tokens(text: Column) -> Column:
    """Matches of the pre-token pattern, in order."""
    return F.regexp_extract_all(text, F.lit(PRE_TOKEN), F.lit(0))


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[s : s + n]`` over the pairs of ``starts`` and ``lengths``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


def offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


def can_broadcast(rows: int, row_bytes: int) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def runs(batches, keys: list[str]):
    """Consecutive rows with equal ``keys`` as tables, from batches that are sorted by them.

    Only one run is held at a time, so callers bound the size of a run.
    """
    import pyarrow as pa

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for values in columns:
            change |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        for start, end in zip(cuts[:-1], cuts[1:]):
            held.append(batch.slice(start, end - start))
            if end < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in ``ids`` (a stored table): broadcast by hint if counted small."""
    ids = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    if can_broadcast(ids.count(), 16):
        ids = F.broadcast(ids)
    return docs.join(ids, id_col, "left_anti")
