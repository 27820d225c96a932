"""Folders and feed files for keys that read or write files themselves."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmart.sources.feed import FEED_COLUMNS, SEQ
from checks.warehouse import run_dir


def fresh_dir(spark: SparkSession, sf_dir: str, name: str) -> str:
    return f"{run_dir(spark, sf_dir)}/{name}-{uuid.uuid4().hex[:8]}"


# A compressed file is read by one task.
ROWS_PER_FILE = 2_000_000


def write_feed_csv(
    feed: DataFrame, path: str, mode: str = "append", compressed: bool = True
) -> None:
    """Feed rows as CSV files with a ``seq`` column for the input order.

    They take a ninth of the space compressed, but then a file is not split over tasks.
    """
    packed = {
        "compression": "gzip",
        "zlib.compress.level": "BEST_SPEED",
        "maxRecordsPerFile": ROWS_PER_FILE,
    }
    (
        feed.select(*FEED_COLUMNS, F.col(SEQ).alias("seq"))
        .write.mode(mode)
        .options(**(packed if compressed else {}))
        .option("header", "true")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
