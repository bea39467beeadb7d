"""Keyed event operators for batch and streaming tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, StringType, StructField, StructType

from .. import vocab as V
from ..functions import urls
from ..session import written


def _window_start(ts: str, seconds: int):
    return F.timestamp_seconds((F.floor(F.unix_micros(ts) / (seconds * 1_000_000)) * seconds)
                               .cast("long"))


def quota(events: DataFrame, key: str, ts: str, order: str, limit: int, seconds: int,
          delay: str | None = None) -> DataFrame:
    """Add ``window_start``, ``allowed`` and ``retry_after`` under a fixed-window quota.

    The first ``limit`` events of a key and window are allowed.  Batch: only the limit-th event of
    each key and window is looked for, a rank filter that Spark applies before the shuffle, and
    every event is then compared with it; a hot key is never sorted as a whole.  Streaming: rows wait
    for the watermark (``delay`` behind, a window by default) and are counted in event order.
    """
    e = events.withColumn("window_start", _window_start(ts, seconds))
    if events.isStreaming:
        return _quota_stream(e, key, ts, order, limit, seconds, delay or f"{seconds} seconds")
    w = Window.partitionBy(key, "window_start").orderBy(ts, order)
    last = (e.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= limit)
            .filter(F.col("_r") == limit)
            .select(key, "window_start", F.struct(F.col(ts), F.col(order)).alias("_last")))
    joined = e.join(last, [key, "window_start"], "left")
    allowed = F.coalesce(F.struct(F.col(ts), F.col(order)) <= F.col("_last"), F.lit(True))
    left = F.ceil((F.unix_micros("window_start") + seconds * 1_000_000 - F.unix_micros(ts)) / 1e6)
    return joined.withColumn("allowed", allowed).withColumn(
        "retry_after", F.when(~F.col("allowed"), F.greatest(F.lit(1), left.cast("int")))).drop("_last")


def _pack(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(data)).read_all().to_pandas()


def _in_event_order(order: list[str], decide, expires):
    """State function that holds a key's rows until the watermark has passed them.

    ``decide(key, rows, memory)`` gets each row once, in the order of event time and ``order``, however the
    rows came in, and returns the finished rows and what it wants to remember (a tuple of text, or
    None).  ``expires(key, memory)`` is the event time in microseconds after which the memory is of no
    use; the state of a key is dropped then.  So the state holds the rows of one watermark delay and
    one memory per live key.
    """
    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, memory = state.get if state.exists else (None, None)
        memory = tuple(memory) if memory is not None else None
        parts = [_unpack(held)] if held is not None else []
        parts += [f for f in frames if len(f)]
        rows = pd.concat(parts, ignore_index=True) if parts else None
        mark = state.getCurrentWatermarkMs()
        wait = None
        if rows is not None:
            # A row at or before the watermark has no earlier one still to come: those are late.
            ready = rows["_t"] <= mark * 1000
            if ready.any():
                done, memory = decide(key, rows[ready].sort_values(["_t", *order]), memory)
                yield done
            rows = rows[~ready] if not ready.all() else None
            if rows is not None:
                wait = int(rows["_t"].min())
        if memory is not None and expires(key, memory) <= mark * 1000:
            memory = None
        if rows is None and memory is None:
            if state.exists:
                state.remove()
            return
        until = wait if wait is not None else expires(key, memory)
        state.update((_pack(rows) if rows is not None else None, list(memory) if memory is not None else None))
        state.setTimeoutTimestamp(max(until // 1000 + 1, mark + 1))

    return step


_STATE = StructType([StructField("held", BinaryType()), StructField("memory", ArrayType(StringType()))])


def _timed(events: DataFrame, ts: str, delay: str) -> DataFrame:
    return events.withWatermark(ts, delay).withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp"))).where("_t IS NOT NULL")


def _quota_stream(e: DataFrame, key: str, ts: str, order: str, limit: int, seconds: int, delay: str) -> DataFrame:
    """Streaming form: rows wait for the watermark, then take the next numbers of their window."""
    out = StructType([*e.schema.fields, StructField("allowed", BooleanType()),
                      StructField("retry_after", IntegerType())])
    span = seconds * 1_000_000

    def decide(_, rows: pd.DataFrame, memory):
        n, start = int(memory[0]) if memory else 0, int(rows["_t"].iloc[0]) // span * span
        rank = n + 1 + np.arange(len(rows))
        left = -(-(start + span - rows["_t"].to_numpy()) // 1_000_000)
        wait = pd.Series(np.maximum(left, 1), index=rows.index).astype("Int32")
        rows = rows.drop(columns="_t").assign(allowed=rank <= limit, retry_after=wait.mask(rank <= limit))
        return rows, (str(n + len(rows)), str(start + span))

    return (_timed(e, ts, delay).groupBy(key, "window_start").applyInPandasWithState(
        _in_event_order([order], decide, lambda _, memory: int(memory[1])), out, _STATE, "append",
        GroupStateTimeout.EventTimeTimeout))


#: Ranges that the time limit of a claim is cut into.
CLAIM_RANGES = 16


def first_claim(events: DataFrame, key: str, payload: str, ts: str, order: str,
                ttl_hours: int = V.CLAIM_TTL_HOURS, delay: str = "1 hour") -> DataFrame:
    """Add ``outcome``: claimed, replay (same payload) or conflict, per key with a time limit.

    The first event of a key owns it for the time limit; the next one after that owns it anew.
    Batch: every event time points to the first one at least a time limit later; the owners are what the
    first event of the key reaches, found by doubling the pointers.  Streaming: rows wait for the
    watermark (``delay`` behind), and the owner is forgotten after its time.  A null key is a key;
    an event without time has no outcome (in a stream it is left out).
    """
    hashed = events.withColumn("_p", F.sha2(F.col(payload).cast("string"), 256))
    if events.isStreaming:
        return _claim_stream(hashed, key, ts, order, ttl_hours, delay)
    ttl = ttl_hours * 3_600_000_000
    width = max(ttl // CLAIM_RANGES, 1)
    # A struct is never null, so null keys meet in joins.
    e = hashed.withColumn("_k", F.struct(key)).withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp"))).withColumn(
        "_b", F.expr(f"floor(_t / {width})"))
    times = written(e.where("_t IS NOT NULL").groupBy("_k", "_t").agg(
        F.min(F.struct(F.col(order).alias("o"), F.col("_p").alias("p"))).alias("own")), "claim-times")
    reached = written(_reached(times.select("_k", "_t"), ttl, width), "claim-owners")
    owners = times.join(reached, ["_k", "_t"]).select(
        "_k", F.col("_t").alias("_own"), "own", F.explode(F.sequence(
            F.expr(f"floor(_t / {width})"), F.expr(f"floor((_t + {ttl} - 1) / {width})"))).alias("_b"))
    # Owners of a key are at least a time limit apart, so an event meets one at most.
    inside = (F.col("_t") >= F.col("_own")) & (F.col("_t") < F.col("_own") + ttl)
    joined = e.join(owners.withColumnsRenamed({"_k": "_ok", "_b": "_ob"}),
                    (F.col("_k") == F.col("_ok")) & (F.col("_b") == F.col("_ob")) & inside, "left")
    first = (F.col("_t") == F.col("_own")) & F.col(order).eqNullSafe(F.col("own.o"))
    outcome = (F.when(F.col("_own").isNull(), F.lit(None).cast("string")).when(first, "claimed")
               .when(F.col("_p").eqNullSafe(F.col("own.p")), "replay").otherwise("conflict"))
    return joined.select(*[F.col(f"`{c}`") for c in events.columns], outcome.alias("outcome"))


def _successors(times: DataFrame, ttl: int, width: int) -> DataFrame:
    """``_k``, ``_t``, ``to``: the first time of the key at or after ``_t + ttl``.

    Times and the points they look from are merged in order inside ranges of ``width``; a point that
    finds nothing in its range takes the first time of the next range that has one.
    """
    seen = times.select("_k", F.col("_t").alias("at"), F.lit(None).cast("long").alias("of"))
    asks = times.select("_k", (F.col("_t") + ttl).alias("at"), F.col("_t").alias("of"))
    merged = seen.union(asks).withColumn("_b", F.expr(f"floor(at / {width})"))
    own = F.when(F.col("of").isNull(), F.col("at"))
    # Latest first, so the smallest time so far is the next one; at a tie times come before points.
    near = Window.partitionBy("_k", "_b").orderBy(F.desc("at"), F.col("of").isNotNull())
    later = Window.partitionBy("_k").orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = merged.groupBy("_k", "_b").agg(F.min(own).alias("first")).withColumn("next", F.min("first").over(later))
    return (merged.withColumn("here", F.min(own).over(near.rowsBetween(Window.unboundedPreceding, 0)))
            .where("of IS NOT NULL").join(ranges, ["_k", "_b"])
            .select("_k", F.col("of").alias("_t"), F.coalesce("here", "next").alias("to")).where("to IS NOT NULL"))


def _reached(times: DataFrame, ttl: int, width: int) -> DataFrame:
    """The times that the first one of every key reaches over successors.

    A round adds what the known ones reach by the pointers and doubles the pointers, so a key with n
    owners takes about log2(n) rounds.
    """
    jump = written(_successors(times, ttl, width), "claim-jumps")
    found = times.groupBy("_k").agg(F.min("_t").alias("_t"))
    while not jump.isEmpty():
        found = written(found.union(found.join(jump, ["_k", "_t"]).select("_k", F.col("to").alias("_t"))), "claim-found")
        ahead = jump.select("_k", F.col("_t").alias("to"), F.col("to").alias("_far"))
        jump = written(jump.join(ahead, ["_k", "to"]).select("_k", "_t", F.col("_far").alias("to")), "claim-jumps")
    return found


def _claim_stream(e: DataFrame, key: str, ts: str, order: str, ttl_hours: int, delay: str) -> DataFrame:
    ttl = ttl_hours * 3_600_000_000
    out = StructType([*[f for f in e.schema.fields if f.name != "_p"], StructField("outcome", StringType())])

    def decide(_, rows: pd.DataFrame, memory):
        outcomes = []
        own_t, own_o, own_p = (int(memory[0]), *memory[1:]) if memory else (None, None, None)
        for t, o, p in zip(rows["_t"].tolist(), rows[order].astype(str).tolist(), rows["_p"].tolist()):
            if own_t is None or t >= own_t + ttl:
                own_t, own_o, own_p = t, o, p
            outcomes.append("claimed" if (t, o) == (own_t, own_o) else "replay" if p == own_p else "conflict")
        return rows.drop(columns=["_t", "_p"]).assign(outcome=outcomes), (str(own_t), own_o, own_p)

    return _timed(e, ts, delay).groupBy(key).applyInPandasWithState(
        _in_event_order([order, "_p"], decide, lambda _, memory: int(memory[0]) + ttl), out, _STATE, "append",
        GroupStateTimeout.EventTimeTimeout)


def latest_status(events: DataFrame, subject: str, status: str, ts: str, order: str,
                  now: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Newest status per subject; records beyond the retention period are forgotten.

    Streaming (update mode): a subject is given out whenever its newest record changes, and its state
    is dropped when the watermark is a retention period past that record.
    """
    if events.isStreaming:
        return _status_stream(events, subject, status, ts, order, delay)
    kept = events
    if now is not None:
        kept = events.filter(F.col(ts) >= F.lit(now).cast("timestamp")
                             - F.expr(f"INTERVAL {V.STATUS_RETENTION_DAYS} DAYS"))
    return kept.groupBy(subject).agg(
        F.max_by(status, F.struct(F.col(ts), F.col(order))).alias("status"),
        F.max(ts).alias("updated_at"))


def _status_stream(events: DataFrame, subject: str, status: str, ts: str, order: str, delay: str) -> DataFrame:
    retention = V.STATUS_RETENTION_DAYS * 86_400_000
    kinds = events.schema
    out = StructType([kinds[subject], StructField("status", kinds[status].dataType),
                      StructField("updated_at", kinds[ts].dataType)])

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            state.remove()
            return
        before = _unpack(state.get[0]) if state.exists else None
        newest = before
        for frame in frames:
            rows = frame if newest is None else pd.concat([newest, frame], ignore_index=True)
            if len(rows):
                newest = rows.sort_values(["_t", order]).iloc[-1:].reset_index(drop=True)
        if newest is None:
            return
        state.update((_pack(newest), None))
        state.setTimeoutTimestamp(max(int(newest["_t"].iloc[0]) // 1000 + retention, mark + 1))
        if before is None or not newest.equals(before):
            yield pd.DataFrame({subject: [key[0]], "status": newest[status], "updated_at": newest[ts]})

    rows = _timed(events, ts, delay).select(subject, status, ts, order, "_t")
    return rows.groupBy(subject).applyInPandasWithState(step, out, _STATE, "update", GroupStateTimeout.EventTimeTimeout)


def stream_ingest(items: DataFrame, max_age_hours: int = 36) -> DataFrame:
    """Incremental ingest: fresh items, first of each canonical URL (T4).

    Input: link, published_at (may be NULL: never stale) and now.  In a stream the state of a URL
    is dropped once the watermark passes it.
    """
    keyed = items.withColumn("canonical_url", urls.canonical_url("link")).withColumn(
        "seen_at", F.coalesce("published_at", "now"))
    fresh = keyed.filter(F.col("published_at").isNull() | (
        F.col("published_at") >= F.col("now") - F.expr(f"INTERVAL {max_age_hours} HOURS")))
    if items.isStreaming:
        return (fresh.withWatermark("seen_at", f"{max_age_hours} hours")
                .dropDuplicatesWithinWatermark(["canonical_url"]))
    first = fresh.groupBy("canonical_url").agg(F.min("seq").alias("seq"))
    return fresh.join(first, ["canonical_url", "seq"])
