"""Column functions over trip rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill import settings as S


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from ``start`` to ``end`` with the sub-second part kept."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1_000_000.0) / F.lit(60.0)


def zone_text(zone: Column) -> Column:
    """Zone id as text; 161, 161.0 and '161' all give '161', other text stays as it is."""
    return F.coalesce(zone.try_cast("int").cast("string"), zone.cast("string"))


def route(pickup: Column, dropoff: Column) -> Column:
    """Route key of two zone ids; null if either zone is null."""
    return F.concat(pickup, F.lit("_"), dropoff)


def duration_in_bounds(minutes: Column, low: float = S.MIN_MINUTES,
                       high: float = S.MAX_MINUTES) -> Column:
    return minutes.between(low, high)


def zone_in_range(zone: Column) -> Column:
    """True for ids of existing zones; null and non-numeric ids give false."""
    return F.coalesce(zone.try_cast("int").between(S.FIRST_ZONE, S.LAST_ZONE), F.lit(False))
