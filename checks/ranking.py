"""Ranks in groups of any size, for the feed that checks derive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked_in_group(
    df: DataFrame, group: Sequence[str], value: str, tie: str, name: str, width: int = 1 << 20
) -> DataFrame:
    """Position of each row in its group by ``value`` descending, then ``tie`` ascending.

    ``(*group, tie)`` must be unique and ``tie`` a whole number. A plain
    ``row_number`` would sort a whole group in one task. Here the group is cut
    into bins of equal value and at most ``width`` tie numbers: a running total
    over the bin counts gives where each bin starts, and rows are numbered
    within their bin only.
    """
    bin_keys = [*group, value, "_bin"]
    binned = df.withColumn("_bin", F.floor(F.col(tie) / width))
    before = (
        Window.partitionBy(*group)
        .orderBy(F.desc(value), F.asc("_bin"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        binned.groupBy(*bin_keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    within = F.row_number().over(Window.partitionBy(*bin_keys).orderBy(tie))
    return (
        binned.join(starts, bin_keys)
        .withColumn(name, F.col("_start") + within)
        .drop("_bin", "_start")
    )
