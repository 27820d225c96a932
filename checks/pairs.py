"""A list of driver keys, each with its Spark query and its oracle SQL side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.base import sql
from checks.warehouse import plain, warehouse


class Pairs:
    def __init__(self) -> None:
        self.QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.ORACLE: dict[str, str] = {}

    def on_tables(self, key: str, oracle: str, *rounded: str):
        """Registers a function of the warehouse tables."""

        def register(build: Callable[..., DataFrame]):
            self.QUERIES[key] = lambda spark, sf_dir: plain(
                build(warehouse(spark, sf_dir)), *rounded
            )
            self.ORACLE[key] = sql(oracle)
            return build

        return register

    def on_folder(self, key: str, oracle: str):
        """Registers a function of session and data folder."""

        def register(build: Callable[[SparkSession, str], DataFrame]):
            self.QUERIES[key] = lambda spark, sf_dir: plain(build(spark, sf_dir))
            self.ORACLE[key] = sql(oracle)
            return build

        return register
