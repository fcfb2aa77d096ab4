"""Column expressions for decisions and times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from courierlens.params import DEFAULT_ZONE

MICROS = 1_000_000


def decide(inputs: Sequence[Column], weights: Sequence[float], intercept: float) -> Column:
    """Logistic rule at one half: true when the weighted sum is not negative.

    Missing and NaN inputs never decide for an event.
    """
    score = F.lit(float(intercept))
    for value, weight in zip(inputs, weights, strict=True):
        score = score + value * F.lit(float(weight))
    return F.coalesce(~F.isnan(score) & (score >= 0), F.lit(False))


def to_local(time: Column, zone: Column) -> Column:
    """UTC to wall-clock time of the zone; unchanged where the zone is missing."""
    return F.from_utc_timestamp(time, F.coalesce(zone, F.lit("UTC")))


def to_local_fixed(time: Column, zone: str = DEFAULT_ZONE) -> Column:
    return F.from_utc_timestamp(time, zone)


def seconds_between(earlier: Column, later: Column) -> Column:
    """Fractional seconds."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(MICROS)


def dwell_seconds(earlier: Column, later: Column) -> Column:
    """Whole seconds within a day; zero where there is no later point."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.coalesce(F.floor(micros / F.lit(MICROS)) % 86400, F.lit(0)).cast("long")


def halfway(start: Column, end: Column) -> Column:
    """Instant in the middle of two instants, in whole microseconds."""
    first, last = F.unix_micros(start), F.unix_micros(end)
    return F.timestamp_micros(first + ((last - first) / 2).cast("long"))


def real_id(column: Column) -> Column:
    """Ids arrive with the text 'null' in place of a missing value."""
    return F.nullif(column, F.lit("null"))
