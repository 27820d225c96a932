"""The whole warehouse: lazily, as written tables, or table by table on demand."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmart.operators.joins import keep_keys
from chartmart.plans import dims, facts, marts
from chartmart.plans.transform import clean_rows
from chartmart.session import WIDE_ROW_CONF, using_conf
from chartmart.sources import folders
from chartmart.sources.tables import (
    DIMENSIONS,
    MARTS,
    SCHEMAS,
    materialise,
    read_table,
    write_table,
    write_tables,
)

_DIM_BUILDERS = {
    "dim_song": dims.dim_song,
    "dim_artist": dims.dim_artist,
    "dim_album": dims.dim_album,
    "dim_date": dims.dim_date,
    "dim_country": dims.dim_country,
    "dim_audio_features": dims.dim_audio_features,
}
CHART_FACTS = {
    "fact_song_daily": facts.song_daily_of,
    "fact_chart_position": facts.chart_position_of,
    "fact_streaming_metrics": facts.streaming_metrics_of,
}
_KEYED_FACTS = {
    "fact_artist_stats": facts.fact_artist_stats,
    "fact_audio_analysis": facts.fact_audio_analysis,
}


def build_from_clean(
    clean: DataFrame,
    stage_rows: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    charted: DataFrame | None = None,
    listed: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The eleven tables as lazy plans over clean rows.

    ``stage_rows`` may write the chart rows that three facts share. Keys of ``charted`` rows are left out
    of these, keys of ``listed`` ones out of the artist rows.
    """
    keyed = facts.resolve_keys(clean)
    rows = stage_rows(facts.chart_rows(keyed, charted))
    unlisted = {} if listed is None else {"fact_artist_stats": facts.fact_artist_stats(keyed, known=listed)}
    return {
        **{name: build(clean) for name, build in _DIM_BUILDERS.items()},
        **{name: build(rows) for name, build in CHART_FACTS.items()},
        **{name: build(keyed) for name, build in _KEYED_FACTS.items()},
        **unlisted,
    }


def build_warehouse(feed: DataFrame) -> dict[str, DataFrame]:
    """The eleven tables as lazy plans over a raw feed."""
    return build_from_clean(clean_rows(feed))


def colliding_keys(dim: DataFrame, key: str) -> DataFrame:
    """Surrogate keys that stand for more than one row."""
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def check_keys(dims: Mapping[str, DataFrame], known: Mapping[str, DataFrame] | None = None) -> None:
    """Stops if two natural keys share a surrogate key.

    ``dims`` are looked through on their own and, as new members, against the ``known`` dimensions:
    these have none of their natural keys, so an equal surrogate key is a collision.
    """
    found = []
    for name, dim in dims.items():
        key = SCHEMAS[name].split()[0]
        shared = colliding_keys(dim, key).select(key)
        if known is not None:
            shared = shared.union(keep_keys(dim, known[name], [key]).select(key))
        found.append(shared.select(F.lit(name).alias("name"), F.col(key).alias("key")))
    first = reduce(DataFrame.union, found).first()
    if first:
        raise ValueError(f"{first.name}: different natural keys share the key {first.key}")


def write_warehouse(feed: DataFrame, path: str) -> dict[str, DataFrame]:
    """Builds and writes everything, then puts it in place of what is under ``path``.

    All tables and rollups are written to a folder of their own and checked there: a build that fails
    at any point leaves the old tables as they are. The clean rows and the chart rows are staged once
    as tables, since eleven and three tables are made from them. Stops if two natural keys of a
    dimension share a surrogate key.
    """
    spark = feed.sparkSession
    fresh = f"{path}/_build/{uuid.uuid4().hex}"
    try:
        with using_conf(spark, WIDE_ROW_CONF):
            clean = materialise(clean_rows(feed), f"{fresh}/_stage/clean")
        tables = build_from_clean(
            clean, lambda rows: materialise(rows, f"{fresh}/_stage/chart_rows", month_layout=True, laid_out=True)
        )
        write_tables(tables, fresh, laid_out={*CHART_FACTS, *marts.LAID_OUT})
        check_keys({name: read_table(spark, fresh, name) for name in DIMENSIONS})
        marts.refresh(spark, fresh)
        folders.replace(spark, fresh, path, (*SCHEMAS, *MARTS))
    finally:
        folders.remove(spark, f"{path}/_build")
    return open_warehouse(spark, path)


def open_warehouse(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The eleven tables and the rollups."""
    return {name: read_table(spark, path, name) for name in (*SCHEMAS, *MARTS)}


def register(tables: Mapping[str, DataFrame]) -> None:
    """Temp views for free-form SQL."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


class OnDemandWarehouse(Mapping[str, DataFrame]):
    """Tables that are built and written when they are first asked for.

    It lists the eleven tables and also offers the rollups and the stages ``feed``, ``clean`` and
    ``chart_rows``. A query then pays only for what it reads, and the next one
    finds it on storage. Clean rows are made from the plan of the feed where nobody has asked for the
    feed itself, and ``fact_song_daily``, which most queries read alone, without staged chart rows.
    """

    STAGES = ("feed", "clean", "chart_rows")

    def __init__(self, spark: SparkSession, path: str, feed: Callable[[], DataFrame]):
        self._spark, self._path, self._feed = spark, path, feed
        self._ready: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def __getitem__(self, name: str) -> DataFrame:
        if not (name in SCHEMAS or name in MARTS or name in self.STAGES):
            raise KeyError(name)
        with self._lock:
            if name not in self._ready:
                self._ready[name] = self._make(name)
            return self._ready[name]

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)

    def path_of(self, *names: str) -> str:
        """The folder, after making sure that the named tables are in it."""
        for name in names:
            self[name]
        return self._path

    def _make(self, name: str) -> DataFrame:
        if name in self.STAGES:
            plan = {
                "feed": lambda: self._feed(),
                "clean": lambda: clean_rows(self._ready["feed"] if "feed" in self._ready else self._feed()),
                "chart_rows": lambda: facts.chart_rows(facts.resolve_keys(self["clean"])),
            }[name]()
            with using_conf(self._spark, WIDE_ROW_CONF):
                return materialise(plan, f"{self._path}/_stage/{name}", name == "chart_rows", name == "chart_rows")
        staged = name in CHART_FACTS and (name != "fact_song_daily" or "chart_rows" in self._ready)
        if name in MARTS:
            plan = marts.BUILDERS[name](self)
        elif name in _DIM_BUILDERS:
            plan = _DIM_BUILDERS[name](self["clean"])
        elif staged:
            plan = CHART_FACTS[name](self["chart_rows"])
        elif name in CHART_FACTS:
            plan = facts.fact_song_daily(facts.resolve_keys(self["clean"]))
        else:
            plan = _KEYED_FACTS[name](facts.resolve_keys(self["clean"]))
        write_table(plan, self._path, name, laid_out=staged or name in marts.LAID_OUT)
        return read_table(self._spark, self._path, name)
