"""Row picking: first per key, best per group, previous value, ordered limit, recent rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[Column | str]


def first_per(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps one row per key in every task before the shuffle, so a key that
    holds much of the data arrives as one row per task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_pos", position).filter("_pos = 1").drop("_pos")


def top_k_per(df: DataFrame, part: Sequence[str], order: Order, k: int) -> DataFrame:
    """The best ``k`` rows of each group; ``order`` must be total to be repeatable."""
    position = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    return df.withColumn("_pos", position).filter(F.col("_pos") <= k).drop("_pos")


def with_previous(
    df: DataFrame, part: Sequence[str], order: Order, col: str, name: str, change: str
) -> DataFrame:
    """Adds the value of ``col`` in the row before, and the difference to it."""
    previous = F.lag(col).over(Window.partitionBy(*part).orderBy(*order))
    return df.withColumn(name, previous).withColumn(change, F.col(col) - F.col(name))


def top_k(df: DataFrame, order: Order, n: int | None) -> DataFrame:
    """Ordered rows, the first ``n`` of them where ``n`` is given."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def down(name: str) -> Column:
    """Descending with nulls first."""
    return F.desc_nulls_first(name)


def recent(
    df: DataFrame, as_of: dt.date, days: int, date_col: str = "snapshot_date"
) -> DataFrame:
    """Rows dated ``days`` before ``as_of`` or later; prunes month partitions."""
    start = as_of - dt.timedelta(days=days)
    kept = df.filter(F.col(date_col) >= F.lit(start))
    if "snapshot_month" in df.columns:
        kept = kept.filter(F.col("snapshot_month") >= F.lit(start.replace(day=1)))
    return kept


def on_day(df: DataFrame, day: dt.date, date_col: str = "snapshot_date") -> DataFrame:
    """Rows of one day; prunes month partitions."""
    kept = df.filter(F.col(date_col) == F.lit(day))
    if "snapshot_month" in df.columns:
        kept = kept.filter(F.col("snapshot_month") == F.lit(day.replace(day=1)))
    return kept
