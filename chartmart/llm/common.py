"""What several text operators share: staging, words and spans."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmart.session import shared_dir

# ASCII white space; everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here.

    Later jobs read the same rows even when executors are lost.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words of a text in order; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(items: Column) -> Column:
    """Sum of an array of integers, 0 for an empty one."""
    return F.aggregate(items, F.lit(0).cast("long"), lambda acc, x: acc + x)
