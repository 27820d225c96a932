"""Measures computed while loading facts, as Column expressions.

Everything stored with two decimals is computed in exact decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the stored measures.
TOP_RANK_BASE = 101
MISSING_RANK = 100
MISSING_POPULARITY = 50
STREAMS_PER_POINT = 10_000
COMPLETION_RATE = "85.00"


def _dec(value: str, kind: str = "decimal(10,2)") -> Column:
    return F.lit(value).cast(kind)


def rank_points(rank: Column) -> Column:
    return (F.lit(TOP_RANK_BASE) - rank).cast("decimal(18,2)")


def points_total(rows: Column, ranks: Column) -> Column:
    """Sum of the rank points of some rows, from their number and the sum of their ranks."""
    return F.lit(TOP_RANK_BASE) * rows - ranks


def performance_index(rank: Column, popularity: Column) -> Column:
    return ((rank_points(rank) + popularity) / 2).cast("decimal(18,2)")


def is_rising(daily: Column, weekly: Column) -> Column:
    return (daily > 0) | (weekly > 0)


def is_falling(daily: Column, weekly: Column) -> Column:
    return (daily < 0) | (weekly < 0)


def movement_magnitude(daily: Column, weekly: Column) -> Column:
    return F.abs(daily) + F.abs(weekly)


def trend_strength(magnitude: Column) -> Column:
    return F.least(_dec("10"), magnitude.cast("decimal(18,2)") / 10).cast("decimal(8,2)")


def previous_rank(rank: Column, daily: Column, sign: int = -1) -> Column:
    """Rank before the move; below 1 it is unknown and becomes 100."""
    moved = rank + F.lit(sign) * daily
    return F.when(moved >= 1, moved).otherwise(F.lit(MISSING_RANK)).cast("bigint")


def energy_dance_score(energy: Column, danceability: Column) -> Column:
    return ((energy + danceability) / 2).cast("float")


def mood_score(valence: Column, energy: Column) -> Column:
    return (valence * 0.6 + energy * 0.4).cast("float")


def estimated_streams(rank: Column) -> Column:
    return (F.lit(TOP_RANK_BASE) - rank).cast("bigint") * STREAMS_PER_POINT


def estimated_listeners(streams: Column) -> Column:
    # Streams are whole multiples of 10,000, so three fifths are whole as well.
    return F.greatest(F.lit(0).cast("bigint"), (streams * 3 / 5).cast("bigint"))


def completion_rate() -> Column:
    return _dec(COMPLETION_RATE, "decimal(5,2)")


def engagement_score(popularity: Column) -> Column:
    return F.least(_dec("100"), popularity.cast("decimal(10,2)") * _dec("1.2", "decimal(2,1)")).cast(
        "decimal(10,2)"
    )


def viral_coefficient(magnitude: Column) -> Column:
    return F.least(_dec("1"), magnitude.cast("decimal(18,2)") / 100).cast("decimal(8,2)")


def artist_score(index: Column, pos: Column) -> Column:
    share = F.when(pos == 0, _dec("1.0", "decimal(2,1)")).otherwise(_dec("0.7", "decimal(2,1)"))
    return (index * share).cast("decimal(18,2)")


def contribution_weight(pos: Column) -> Column:
    return F.when(pos == 0, _dec("1", "decimal(5,2)")).otherwise(_dec("0.5", "decimal(5,2)"))


def average(total: Column, count: Column) -> Column:
    """Mean from an exact sum and a count, divided once, in double."""
    return total.cast("double") / count.cast("double")
