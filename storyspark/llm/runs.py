"""Periodic runs of words in whole texts (operator 12).

Phase one of Baier's suffix sorter groups the suffixes of a word sequence by their longest Lyndon
prefix: groups are taken from the highest down, and each hands its prefix to the nearest suffix before
its members that is still in a lower group. The lengths of the prefixes are the Lyndon array; grouping
once by an order of the words and once by its reverse gives the two arrays that between them hold a
Lyndon root of every run. A root is extended to both sides as far as words one period apart agree,
which yields the run. Words that occur once in a text can lie in no run, so they cut the sequence
before it is grouped.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends, at least
``repeats * q`` and ``shortest`` words long. Collapsing keeps the first ``q`` words of every run and drops
the words that come after them in any run.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``, compared as they are; a null or empty text, or one of
white space, has no runs and collapses to the empty text; repeated rows give repeated results; a null id
stays null; other columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUNS = "runs array<struct<start:long,length:long,period:long>>"


def lyndon_lengths(codes: list[int], kinds: int) -> list[int]:
    """Length of the longest Lyndon word that starts at each place; ``codes`` are below ``kinds``."""
    n = len(codes)
    members: list[list[int]] = [[] for _ in range(kinds)]
    for place, code in enumerate(codes):
        members[code].append(place)
    group, size = list(codes), [1] * kinds
    below, above = list(range(-1, kinds - 1)), list(range(1, kinds + 1))
    # Places that are still in a group to come, as a linked list.
    before, behind = list(range(-1, n - 1)), list(range(1, n + 1))
    found = [0] * n
    top = kinds - 1
    while top >= 0:
        length = size[top]
        takers: list[list[int]] = []  # (place, how many members hand their prefix to it)
        last = -1
        for place in members[top]:
            if group[place] != top:
                continue
            found[place] = length
            left, right = before[place], behind[place]
            if right < n:
                before[right] = left
            if left < 0:
                continue
            behind[left] = right
            if left == last:
                takers[-1][1] += 1
            else:
                takers.append([left, 1])
                last = left
        if len(takers) > 1:
            # Takers of one group with the same number of copies stay together; more copies are higher.
            takers.sort(key=lambda t: (group[t[0]], t[1], t[0]))
        old = times = made = -1
        for place, copies in takers:
            home = group[place]
            if home != old or copies != times:
                under = made if home == old else home
                old, times, made = home, copies, len(members)
                over = above[under]
                members.append([])
                size.append(size[home] + copies * length)
                below.append(under)
                above.append(over)
                above[under] = made
                below[over] = made  # there is one above, as the highest group takes nothing
            members[made].append(place)
            group[place] = made
        top = below[top]
    return found


def _agree(codes: np.ndarray, a: int, b: int) -> int:
    """How many words from ``a`` and from ``b`` on are equal; blocks double in size."""
    done, step = 0, 8
    while True:
        one, two = codes[a + done:a + done + step], codes[b + done:b + done + step]
        width = min(len(one), len(two))
        differ = np.flatnonzero(one[:width] != two[:width])
        if len(differ):
            return done + int(differ[0])
        done += width
        if width < step:
            return done
        step *= 2


def _stretch_runs(codes: np.ndarray, shortest: int, repeats: int) -> list[tuple[int, int, int]]:
    kinds, dense = np.unique(codes, return_inverse=True)
    n, forward, number = len(dense), dense.tolist(), len(kinds)
    back = dense[::-1]
    places = np.arange(n)
    found: set[tuple[int, int, int]] = set()
    for order in (forward, [number - 1 - c for c in forward]):
        period = np.array(lyndon_lengths(order, number))
        # A root lies at most one period behind the start of its run, so this many equal words follow.
        equal = np.maximum(shortest - 2 * period, (repeats - 2) * period)
        fits = (places + period + equal <= n) & (repeats * period <= n)
        at, step, equal = places[fits], period[fits], equal[fits]
        for k in range(2):
            same = (equal <= k) | (dense[np.minimum(at + k, n - 1)] == dense[np.minimum(at + k + step, n - 1)])
            at, step, equal = at[same], step[same], equal[same]
        known: dict[int, tuple[int, int]] = {}
        for a, q in zip(at.tolist(), step.tolist()):
            start, end = known.get(q, (0, 0))
            if start <= a and a + q <= end:
                continue
            right = _agree(dense, a, a + q)
            # Reversed, the words before place p begin at n - p.
            left = _agree(back, n - a, n - a - q)
            start, end = a - left, a + q + right
            if end - start >= max(shortest, repeats * q):
                known[q] = start, end
                found.add((start, end - start, q))
    return sorted(found)


def periodic_runs(codes: np.ndarray, shortest: int = 6, repeats: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, by start and period; ``codes`` name the words from 0 on."""
    if repeats < 2:
        raise ValueError("a run repeats its period at least twice")
    least = max(shortest, repeats)
    once = np.flatnonzero(np.bincount(codes)[codes] == 1) if len(codes) else codes
    starts = np.concatenate([[0], once + 1])
    ends = np.concatenate([once, [len(codes)]])
    long_enough = ends - starts >= least
    return [(start + int(lo), length, q) for lo, hi in zip(starts[long_enough], ends[long_enough])
            for start, length, q in _stretch_runs(codes[lo:hi], shortest, repeats)]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by spaces, without those that come after the first period of a run."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edges[start + q] += 1
        edges[start + length] -= 1
    return b" ".join(w for w, covered in zip(words, np.cumsum(edges).tolist()) if not covered)


def find_runs(docs: DataFrame, shortest: int = 6, repeats: int = 4, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``id_col``, ``runs`` (structs ``start``, ``length``, ``period``), ``collapsed`` text, per row of ``docs``."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = [], []
            for text in batch.column(1).to_pylist():
                words = (text or b"").split()
                known: dict[bytes, int] = {}
                codes = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
                runs = periodic_runs(codes, shortest, repeats)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(collapsed(words, runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, kind), pa.array(texts, pa.binary())], [id_col, "runs", "collapsed"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("text"))
    return (rows.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {RUNS}, collapsed binary")
            .withColumn("collapsed", F.col("collapsed").cast("string")))

