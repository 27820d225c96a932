"""The warehouse that driver queries read: built once per session and data folder."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FloatType

from chartmart.plans.warehouse import OnDemandWarehouse
from chartmart.session import shared_dir
from checks.trade_feed import chart_feed

_OPEN: dict[tuple[str, str], OnDemandWarehouse] = {}


def run_dir(spark: SparkSession, sf_dir: str) -> str:
    """A folder of this application for this data, below the shared one."""
    digest = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
    return f"{shared_dir(spark)}/chartmart/{spark.sparkContext.applicationId}/{digest}"


def warehouse(spark: SparkSession, sf_dir: str) -> OnDemandWarehouse:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        tables = f"{run_dir(spark, sf_dir)}/tables"
        _OPEN[key] = OnDemandWarehouse(
            spark, tables, lambda: chart_feed(spark, sf_dir, f"{tables}/_stage")
        )
    return _OPEN[key]


def plain(df: DataFrame, *rounded: str) -> DataFrame:
    """Decimals and floats as double, the named columns rounded: comparable across engines."""

    def column(field):
        col = F.col(field.name)
        if isinstance(field.dataType, DecimalType | FloatType):
            col = col.cast("double")
        return F.round(col, 6).alias(field.name) if field.name in rounded else col.alias(field.name)

    return df.select(*[column(field) for field in df.schema.fields])
