"""Surrogate keys: a hash of the natural key, the same in every build."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_of(*cols: Column | str) -> Column:
    return F.xxhash64(*cols)


def with_key(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """``df`` with the surrogate key of ``cols`` as its first column."""
    return df.select(key_of(*cols).alias(name), *df.columns)
