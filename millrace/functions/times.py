"""Time helpers that do not depend on the session's zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def epoch_seconds(c: Column | str) -> Column:
    """Seconds since 1970-01-01 of a zone-free timestamp, exact to the microsecond."""
    c = F.col(c) if isinstance(c, str) else c
    span = (c.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")
    return span.cast("decimal(20,6)")


def epoch_micros(c: Column | str) -> Column:
    return (epoch_seconds(c) * 1_000_000).cast("bigint")


def as_instant(c: Column | str) -> Column:
    """A zone-free timestamp taken as UTC, as the instant type that watermarks need."""
    return F.timestamp_micros(epoch_micros(c))


def from_instant(c: Column) -> Column:
    """The UTC clock time of an instant, as a zone-free timestamp."""
    seconds = (F.unix_micros(c).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def between(df: DataFrame, column: str, dates: tuple[str, str]) -> DataFrame:
    """Rows from the first date up to, not including, the second; the range is pushed to the scan."""
    low, high = (F.lit(d).cast("timestamp_ntz") for d in dates)
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def years(first: int, last: int) -> tuple[str, str]:
    return f"{first}-01-01", f"{last + 1}-01-01"
