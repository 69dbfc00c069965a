"""Date/time expressions that work on TIMESTAMP_NTZ (the stored tick type)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch, independent of the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts.cast("timestamp_ntz"))


def from_epoch_micros(us: Column) -> Column:
    """Inverse of ``epoch_micros``; returns TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH))


def add_interval(ts: Column, days: int = 0, hours: int = 0, seconds: int = 0,
                 millis: int = 0) -> Column:
    us = ((days * 24 + hours) * 3600 + seconds) * 1_000_000 + millis * 1000
    return F.timestamp_add("MICROSECOND", F.lit(us), ts)


def window_start(ts: Column, seconds: int) -> Column:
    """Epoch-aligned tumbling window start (left-closed) as TIMESTAMP_NTZ.

    Plain arithmetic rather than ``F.window``: the latter adds an
    ``isnotnull`` filter that is pushed into the child plan, which makes
    otherwise identical sub-plans (e.g. the 1s candles under each roll-up)
    differ and defeats exchange reuse."""
    us = epoch_micros(ts)
    size = F.lit(seconds * 1_000_000)
    return from_epoch_micros(us - F.pmod(us, size))


def millis_between(a: Column, b: Column) -> Column:
    """Whole milliseconds from a to b, truncated toward zero."""
    return F.timestamp_diff("MILLISECOND", a, b)


def partition_columns(ts: Column) -> list[Column]:
    return [F.year(ts).alias("year"), F.month(ts).alias("month"),
            F.dayofmonth(ts).alias("day")]


def parse_iso(text: Column, strict: bool = True) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ (UTC wall time; an offset is applied).

    strict: malformed text raises (ANSI); lenient: malformed text -> null.
    """
    ts = F.to_timestamp(text) if strict else F.try_to_timestamp(text)
    return F.to_timestamp_ntz(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
