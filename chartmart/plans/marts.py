"""Rollups of the facts that the catalogue reads.

- ``agg_song_day``: a row per song and day, with the number of artist rows of that song and day
  (``weight``, 1 where there are none) and the artists themselves.
- ``agg_song_month``: a row per song, country, album and month. ``fan*`` columns hold the sums over
  chart rows joined to artist rows on song and day (each chart row counts ``weight`` times, see
  ``operators.fan``); ``artists`` are those met on its days, ``number_one_*`` what belongs to days at
  rank 1.
- ``agg_artist_month``: a row per artist, song, country and month.

Every one lies in month partitions and each row depends on fact rows of its own month alone. A load
therefore makes the months with new rows anew from the facts and replaces them (``refresh``): whatever the
split of the feed into batches, and however often one is replayed, the result is that of a full build.
Lists of artists are bounded by the artists of a song in a month, lists of days by 31.

Queries take a rollup from the tables where it is there (``rollup``) and plan it from the facts where
it is not.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartmart.plans.facts import SHARE, dealt
from chartmart.session import using_conf
from chartmart.sources import folders
from chartmart.sources.tables import MARTS, MONTH, create_missing, read_table, write_parts

Tables = Mapping[str, DataFrame]

SONG_DAY = ("song_key", "date_key")
# What rollups are made of.
FACTS = ("fact_song_daily", "fact_artist_stats")
# Tables whose plans come out laid out by month.
LAID_OUT = (*FACTS, "agg_song_day", "agg_song_month", "agg_artist_month")
_PLACE = (*SONG_DAY, MONTH, "snapshot_date", "country_key")
# The rows of ``_charts_and_artists`` as dealt for all rollups.
DEALT = "_dealt"
# Spark would take single fields out of a packed column before a shuffle, other ones for each rollup.
ONE_SHUFFLE = {"spark.sql.optimizer.nestedSchemaPruning.enabled": "false"}


def _artist_rows(t: Tables) -> DataFrame:
    popularity = F.col("song_popularity").alias("popularity_score")
    return t["fact_artist_stats"].select(*_PLACE, "artist_key", popularity, "artist_score")


def _charts_and_artists(t: Tables) -> DataFrame:
    """Chart rows and artist rows below each other; only the latter have an ``artist_key``."""
    charts = t["fact_song_daily"].select(*_PLACE, "album_key", "popularity_score", "daily_rank")
    both = charts.unionByName(_artist_rows(t), allowMissingColumns=True)
    return both.dropna(subset=[*SONG_DAY, MONTH])


def _dealt_rows(t: Tables) -> DataFrame:
    """What song rollups are made of: the rows that ``t`` has for all of them, or a shuffle of its facts.

    A song lies in one share, so that groups are made and written where rows are dealt.
    """
    return t[DEALT] if DEALT in t else dealt(_charts_and_artists(t))


def song_days(t: Tables) -> DataFrame:
    """``agg_song_day``: chart and artist rows meet in one aggregate, without a join; laid out by month."""
    is_chart = F.col("artist_key").isNull()
    grouped = (
        _dealt_rows(t)
        .groupBy(*SONG_DAY, "snapshot_date", *SHARE)
        .agg(
            F.count_if(is_chart).alias("n"),
            F.sum(F.when(is_chart, F.col("popularity_score"))).alias("sum_popularity_score"),
            F.sum("daily_rank").alias("sum_daily_rank"),
            F.max(F.when(is_chart, F.col("popularity_score"))).alias("max_popularity_score"),
            F.greatest(F.count("artist_key"), F.lit(1).cast("bigint")).alias("weight"),
            F.sort_array(F.collect_set("artist_key")).alias("artists"),
        )
    )
    return _in_shape(grouped.filter("n > 0"), "agg_song_day")


def _met(artists: Column) -> Column:
    """The distinct artists of several lists, in order."""
    return F.sort_array(F.array_distinct(F.flatten(F.collect_set(artists))))


def song_months(t: Tables) -> DataFrame:
    """``agg_song_month``, from chart and artist rows; comes out laid out by month."""
    # The artists of the day are met and the groups are made inside one shuffle.
    day = Window.partitionBy(*SONG_DAY, *SHARE)
    met = _dealt_rows(t).withColumns(
        {
            "weight": F.greatest(F.count("artist_key").over(day), F.lit(1).cast("bigint")),
            "met": F.sort_array(F.collect_set("artist_key").over(day)),
        }
    )
    rows = met.filter("artist_key IS NULL").withColumnRenamed("met", "artists")
    first = F.col("daily_rank") == 1
    grouped = rows.groupBy("song_key", "country_key", "album_key", *SHARE).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("popularity_score").alias("sum_popularity_score"),
        F.sum("daily_rank").alias("sum_daily_rank"),
        F.max("popularity_score").alias("max_popularity_score"),
        F.sum("weight").alias("fan"),
        F.sum(F.col("popularity_score") * F.col("weight")).alias("fan_popularity_score"),
        F.sum(F.col("daily_rank") * F.col("weight")).alias("fan_daily_rank"),
        _met(F.col("artists")).alias("artists"),
        F.sort_array(F.collect_set(F.when(first, F.col("snapshot_date")))).alias("number_one_days"),
        F.sum(F.when(first, F.col("weight")).otherwise(0)).alias("number_one_fan"),
        _met(F.when(first, F.col("artists"))).alias("number_one_artists"),
    )
    return _in_shape(grouped, "agg_song_month")


def artist_months(t: Tables) -> DataFrame:
    """``agg_artist_month``, from artist rows; laid out by month."""
    keys = ["artist_key", "song_key", "country_key", *SHARE]
    listed = t[DEALT] if DEALT in t else dealt(_artist_rows(t))
    grouped = listed.groupBy(*keys).agg(
        F.count("artist_key").alias("n"),
        F.sum("popularity_score").alias("sum_song_popularity"),
        F.sum("artist_score").alias("sum_artist_score"),
    )
    # Chart rows have no artist. Told by the count, as a test of the key would be moved below the shuffle,
    # which then were another one than that of the other rollups.
    return _in_shape(grouped.filter("n > 0"), "agg_artist_month")


BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    "agg_song_day": song_days,
    "agg_song_month": song_months,
    "agg_artist_month": artist_months,
}


def _in_shape(df: DataFrame, name: str) -> DataFrame:
    columns = [field.split(" ", 1) for field in MARTS[name].split(", ")]
    return df.select(*[F.col(column).cast(kind).alias(column) for column, kind in columns])


def rollup(t: Tables, name: str) -> DataFrame:
    """A rollup as stored, or as a plan over the facts."""
    return t[name] if name in t else BUILDERS[name](t)


def together(t: Tables) -> DataFrame:
    """The rows of all rollups, named by ``_rollup``, from one shuffle of the facts.

    What rows carry beside song and month travels as one column: pruned for each rollup by itself, it
    would be shuffled once for each (see ``ONE_SHUFFLE``).
    """
    rows = _charts_and_artists(t)
    packed = F.struct(*[c for c in rows.columns if c not in ("song_key", MONTH)]).alias("_row")
    shared = dealt(rows.select("song_key", MONTH, packed)).select("song_key", *SHARE, "_row.*")
    made = [
        build({**t, DEALT: shared}).withColumn("_rollup", F.lit(name)) for name, build in BUILDERS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), made)


def refresh(spark: SparkSession, path: str, months: Collection[object] | None = None) -> None:
    """Makes the rollups of ``months`` anew from the facts under ``path``; all of them without.

    Only partitions of those months are read and replaced, so repeating a refresh changes nothing. All
    are written before any is put in place.
    """
    tables: dict[str, DataFrame] = {}
    for name in FACTS:
        fact = read_table(spark, path, name)
        tables[name] = fact if months is None else fact.filter(F.col(MONTH).isin(list(months)))
    fresh = f"{path}/_rollups/{uuid.uuid4().hex}"
    try:
        with using_conf(spark, ONE_SHUFFLE):
            write_parts(together(tables), fresh, "_rollup")
        for name in BUILDERS:
            made = folders.names(spark, f"{fresh}/_rollup={name}")
            if months is None:
                folders.remove(spark, f"{path}/{name}")
            for month in made:
                folders.remove(spark, f"{path}/{name}/{month}")
                folders.move(spark, f"{fresh}/_rollup={name}/{month}", f"{path}/{name}/{month}")
        create_missing(spark, path, BUILDERS)
    finally:
        folders.remove(spark, f"{path}/_rollups")
