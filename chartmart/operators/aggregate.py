"""Grouped summaries and the staged aggregates the queries are built from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def summarise(
    df: DataFrame, keys: Sequence[str], having: Column | None = None, **aggs: Column
) -> DataFrame:
    """``groupBy(keys)`` with named aggregates and an optional filter on the result."""
    named = [value.alias(name) for name, value in aggs.items()]
    grouped = df.groupBy(*keys).agg(*named) if keys else df.agg(*named)
    return grouped if having is None else grouped.filter(having)


def partial(
    df: DataFrame, keys: Sequence[str], sums: Sequence[str] = (), maxes: Sequence[str] = ()
) -> DataFrame:
    """Row count ``n``, ``sum_<c>`` and ``max_<c>`` per key.

    A first stage before a join or a distinct count: it shrinks a fact to one
    row per key inside each task, so the shuffle carries keys, not fact rows.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(f"sum_{c}") for c in sums],
        *[F.max(c).alias(f"max_{c}") for c in maxes],
    )


def summed(df: DataFrame, keys: Sequence[str], sums: Sequence[str], **others: Column) -> DataFrame:
    """Columns of a rollup summed up further per key, under their own names, and other aggregates."""
    totals = [F.sum(c).alias(c) for c in sums]
    return df.groupBy(*keys).agg(*totals, *[value.alias(c) for c, value in others.items()])


def text_list(rows: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """Distinct values of ``col`` per key, in order, joined with ', '; null where there is none."""
    values = F.array_sort(F.collect_set(col))
    listed = F.when(F.size(values) > 0, F.array_join(values, ", "))
    return rows.groupBy(*keys).agg(listed.alias(name))


def one_row(*branches: DataFrame) -> DataFrame:
    """One row from several one-row aggregates with different columns."""
    both = branches[0]
    for branch in branches[1:]:
        both = both.unionByName(branch, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
