"""Join helpers. There are no hints: Spark broadcasts a side by its own size check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
    default: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Adds the columns of ``dim`` by equal ``on`` columns.

    ``null_safe`` lets null keys match each other; ``default`` fills looked-up
    columns where nothing matched (with ``how='left'``).
    """
    if null_safe:
        renamed = dim.select(
            *[F.col(c).alias(f"_dim_{c}" if c in on else c) for c in dim.columns]
        )
        same = reduce(
            lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_dim_{c}")) for c in on]
        )
        joined = df.join(renamed, same, how).drop(*[f"_dim_{c}" for c in on])
    else:
        joined = df.join(dim, list(on), how)
    for name, value in (default or {}).items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), value))
    return joined


def star(fact: DataFrame, dims: Mapping[str, DataFrame], how: str = "inner") -> DataFrame:
    """Joins each dimension by the key column it is listed under."""
    for key, dim in dims.items():
        fact = fact.join(dim, key, how)
    return fact


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_semi")


def drop_keys(
    df: DataFrame, keys: DataFrame, on: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    if not null_safe:
        return df.join(keys.select(*on), list(on), "left_anti")
    known = keys.select(*[F.col(c).alias(f"_key_{c}") for c in on])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in on])
    return df.join(known, same, "left_anti")
