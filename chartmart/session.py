"""Spark session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# The JVM does not optimise methods above 8,000 bytes. The cleaning projection
# over all feed columns is longer when fused into one method; with this limit
# Spark splits it instead, and it runs about twice as fast.
WIDE_ROW_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def get_spark(app: str = "chartmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tuned for; ``conf`` adds to or overrides them.

    Keyword names use ``__`` for a dot: ``spark__driver__memory="8g"``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Hash instead of sort-merge joins where every shuffled partition is this small.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        "spark.ui.showConsoleProgress": "false",
        **WIDE_ROW_CONF,
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def using_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Runs with the given SQL settings and puts the old ones back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables.

    It is the one the cluster names in ``spark.checkpoint.dir``, else the one
    set on the context. Only a local session may go without: it gets a
    temporary folder of its own.
    """
    found = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by driver and executors")
    made = tempfile.mkdtemp(prefix="chartmart-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made
