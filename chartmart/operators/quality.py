"""Table checks: rules, unique grain, foreign keys, column listings. All count, none stop."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations) from one pass; a rule is violated where its test is false.

    As with a table constraint, a null test counts as kept.
    """
    counts = df.agg(
        *[
            F.coalesce(F.sum(F.when(~test, 1).otherwise(0)), F.lit(0)).alias(f"_{i}")
            for i, test in enumerate(rules.values())
        ]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.col(f"_{i}").alias("violations"))
            for i, rule in enumerate(rules)
        ]
    )
    return counts.select(F.inline(pairs))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def check_fk(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Key values of ``fact`` that ``dim`` lacks, with their number of rows; null is allowed."""
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(dim.select(key), key, "left_anti")


LISTING = (
    "table_name string, position int, column_name string, data_type string, has_nulls boolean, "
    "filled_rows bigint, total_rows bigint"
)


def _like(name: str, pattern: str) -> bool:
    """SQL LIKE without escapes."""
    parts = {"%": ".*", "_": "."}
    return bool(re.fullmatch("".join(parts.get(c, re.escape(c)) for c in pattern), name, re.S))


def describe_tables(
    tables: Mapping[str, DataFrame],
    table_like: str = "%",
    column_like: str = "%",
    counted: bool = True,
) -> DataFrame:
    """One row per table column: position, type, whether nulls occur, filled and total rows.

    Tables and columns are chosen by LIKE patterns from the schemas, so only chosen columns are
    scanned; without ``counted`` none is, and the last three values are null.
    """

    def listing(name: str, df: DataFrame, fields: list) -> DataFrame:
        counts = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count(F.col(f.name)).alias(f"_c{i}") for i, f in fields],
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(i + 1).alias("position"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    (F.col(f"_c{i}") < F.col("_rows")).alias("has_nulls"),
                    F.col(f"_c{i}").alias("filled_rows"),
                    F.col("_rows").alias("total_rows"),
                )
                for i, f in fields
            ]
        )
        return counts.select(F.inline(entries))

    spark = next(iter(tables.values())).sparkSession
    chosen = {}
    for name in tables:
        if _like(name, table_like):
            fields = [x for x in enumerate(tables[name].schema.fields) if _like(x[1].name, column_like)]
            if fields:
                chosen[name] = fields
    if not counted or not chosen:
        rows = [
            (name, i + 1, f.name, f.dataType.simpleString(), None, None, None)
            for name, fields in chosen.items()
            for i, f in fields
        ]
        return spark.createDataFrame(rows, LISTING)
    return reduce(DataFrame.unionByName, [listing(n, tables[n], x) for n, x in chosen.items()])


def find_columns(
    tables: Mapping[str, DataFrame], table_like: str = "%", column_like: str = "%"
) -> DataFrame:
    """The listing of columns whose table and column names match; only those are scanned."""
    return describe_tables(tables, table_like, column_like)
