"""Aggregates over a many-to-many left join, without making its rows.

A left row that meets ``w`` right rows occurs ``w`` times in the joined result,
once where it meets none. The right side is therefore counted per join key
first; the join then adds one weight to each left row, and
COUNT(*) = sum(w), SUM(x) = sum(x*w), AVG(x) = sum(x*w) / sum(w).
MIN, MAX and distinct counts of left columns do not change.

With song and day as join key no key is hot: the grain of the facts allows one
chart row per country and one artist row per country and listed artist. A song
that fills a third of the charts still spreads over its days.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.functions.metrics import average

FAN = "_fan"


def with_fan(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left`` with the number of joined rows that each of its rows stands for."""
    weights = right.groupBy(*on).agg(F.count(F.lit(1)).alias(FAN))
    return left.join(weights, list(on), "left").withColumn(
        FAN, F.coalesce(F.col(FAN), F.lit(1).cast("bigint"))
    )


def with_members(left: DataFrame, right: DataFrame, on: Sequence[str], member: str) -> DataFrame:
    """``left`` once per distinct ``member`` of its right rows, weighted.

    Right rows that agree in ``on`` and ``member`` are counted, not repeated;
    a left row without right rows stays once with a null member.
    """
    members = right.groupBy(*on, member).agg(F.count(F.lit(1)).alias(FAN))
    return left.join(members, list(on), "left").withColumn(
        FAN, F.coalesce(F.col(FAN), F.lit(1).cast("bigint"))
    )


def weighted(col: Column | str) -> Column:
    """Sum of ``col`` over the joined rows."""
    value = F.col(col) if isinstance(col, str) else col
    return F.sum(value * F.col(FAN))


def fan_join_agg(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    keys: Sequence[str],
    measures: Mapping[str, tuple[str, str | None]],
    distinct: Mapping[str, str] | None = None,
) -> DataFrame:
    """Aggregates of ``left`` LEFT JOIN ``right``, grouped by left columns ``keys``.

    ``measures`` maps a result name to ``(op, left column)`` with op one of
    count, sum, avg, min, max, count_distinct. ``distinct`` maps a result name to a right
    column whose distinct values are counted. Null values count in no aggregate
    but ``count``, as in the joined result.
    """
    rows = with_fan(left, right, on)
    ops = {
        "count": lambda c: F.sum(FAN),
        "sum": weighted,
        "avg": lambda c: average(weighted(c), F.sum(F.when(F.col(c).isNotNull(), F.col(FAN)))),
        "min": F.min,
        "max": F.max,
        "count_distinct": F.count_distinct,
    }
    aggs = [ops[op](col).alias(name) for name, (op, col) in measures.items()]
    result = rows.groupBy(*keys).agg(*aggs)
    for name, member in (distinct or {}).items():
        pairs = left.select(*on, *[k for k in keys if k not in on]).distinct()
        members = right.select(*on, member).distinct()
        counted = (
            pairs.join(members, list(on))
            .select(*keys, F.col(member).alias("_member"))
            .groupBy(*keys)
            .agg(F.count_distinct("_member").alias(name))
        )
        renamed = counted.select(*[F.col(k).alias(f"_k_{k}") for k in keys], name)
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        result = (
            result.join(renamed, same, "left")
            .drop(*[f"_k_{k}" for k in keys])
            .withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))
        )
    return result
