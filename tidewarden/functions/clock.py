"""Time arithmetic on zoned timestamps. ``as_of`` always stands for "now"."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

Instant = Column | datetime | str | None


def instant(as_of: Instant) -> Column:
    """Column for a point in time; ``None`` is the transaction-stable clock."""
    if as_of is None:
        return F.current_timestamp()
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


def minutes(n: int | Column) -> Column:
    return F.make_dt_interval(mins=F.lit(n) if isinstance(n, int) else n)


def hours(n: int | Column) -> Column:
    return F.make_dt_interval(hours=F.lit(n) if isinstance(n, int) else n)


def elapsed_micros(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Whole seconds, rounded down (toward the past)."""
    return F.floor(elapsed_micros(later, earlier) / F.lit(1_000_000)).cast("bigint")


def elapsed_minutes(later: Column, earlier: Column) -> Column:
    """Exact decimal minutes. Half-up rounding to two places is safe on it:
    the ties lie on whole microseconds, far above its nine decimal places."""
    return elapsed_micros(later, earlier).cast("decimal(20,0)") / F.lit(60_000_000).cast("decimal(8,0)")


def whole_minutes(later: Column, earlier: Column) -> Column:
    return F.floor(elapsed_minutes(later, earlier)).cast("int")
