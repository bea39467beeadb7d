"""Dates, ages and recency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import col, text


def feed_time(s) -> Column:
    """RFC-822 date to UTC timestamp; NULL when it cannot be read."""
    bare = F.trim(F.regexp_replace(text(s), r"^\s*[A-Za-z]{3,9}\s*,\s*", ""))
    zoned = [F.try_to_timestamp(bare, F.lit(f)) for f in
             ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z",
              "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm z")]
    plain = [F.try_to_timestamp(bare, F.lit(f)) for f in
             ("d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm")]
    return F.coalesce(*zoned, *plain)


def iso_time(s) -> Column:
    """ISO date or date-time (offset or Z allowed) to UTC timestamp; NULL when malformed."""
    ok = text(s).rlike(
        r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$")
    return F.when(ok, F.try_to_timestamp(col(s)))


def hours_old(ts, now) -> Column:
    return (F.unix_micros(col(now)) - F.unix_micros(col(ts))) / F.lit(3600.0 * 1e6)


def recency(ts, now, fresh_hours: float) -> Column:
    """1 when new, falling linearly to 0 at ``fresh_hours``; 0 for an unknown time."""
    h = hours_old(ts, now)
    return F.when(h.isNull(), F.lit(0.0)).otherwise(F.greatest(
        F.lit(0.0), F.least(F.lit(1.0), (F.lit(float(fresh_hours)) - h) / float(fresh_hours))))


def is_stale(ts, now, stale_hours: float) -> Column:
    """An unknown time is not stale."""
    return F.coalesce(hours_old(ts, now) > F.lit(float(stale_hours)), F.lit(False))


def iso_z(ts) -> Column:
    """Timestamp as ISO text ending in Z, with microseconds only when there are any."""
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(F.unix_micros(ts) % 1000000 == 0, F.lit("")).otherwise(
            F.date_format(ts, ".SSSSSS")),
        F.lit("Z"))
