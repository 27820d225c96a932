"""Warehouse tables on storage: schemas, reading, writing, counts, exports."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSIONS = {
    "dim_song": "song_key bigint, spotify_id string, song_name string, duration_ms bigint, "
    "is_explicit boolean, created_at timestamp",
    "dim_artist": "artist_key bigint, artist_name string, created_at timestamp",
    "dim_album": "album_key bigint, album_name string, release_date date, release_year int, "
    "release_month int, created_at timestamp",
    "dim_date": "date_key bigint, full_date date, year int, quarter int, month int, "
    "month_name string, day int, day_of_week int, day_name string, week_of_year int, "
    "is_weekend boolean, season string",
    "dim_country": "country_key bigint, country_code string, country_name string",
    "dim_audio_features": "features_key bigint, energy_level string, danceability_level string, "
    "valence_level string, tempo_category string, acousticness_level string, "
    "created_at timestamp",
}
_GRAIN = "song_key bigint, date_key bigint, country_key bigint"
_DAY = "snapshot_date date, snapshot_month date"
FACTS = {
    "fact_song_daily": f"{_GRAIN}, album_key bigint, daily_rank bigint, popularity_score int, "
    f"rank_points decimal(18,2), performance_index decimal(18,2), {_DAY}",
    "fact_artist_stats": f"artist_key bigint, {_GRAIN}, song_rank bigint, song_popularity int, "
    f"artist_position int, artist_score decimal(18,2), contribution_weight decimal(5,2), {_DAY}",
    "fact_chart_position": f"{_GRAIN}, current_rank bigint, previous_rank bigint, daily_movement bigint, "
    "weekly_movement bigint, is_rising boolean, is_falling boolean, movement_magnitude bigint, "
    f"trend_strength decimal(8,2), {_DAY}",
    "fact_audio_analysis": "song_key bigint, features_key bigint, danceability float, "
    "energy float, key_signature int, loudness float, mode int, speechiness float, "
    "acousticness float, instrumentalness float, liveness float, valence float, tempo float, "
    "time_signature int, energy_dance_score float, mood_score float, created_at timestamp",
    "fact_streaming_metrics": f"{_GRAIN}, estimated_streams bigint, estimated_listeners bigint, "
    "avg_completion_rate decimal(5,2), engagement_score decimal(10,2), "
    f"viral_coefficient decimal(8,2), {_DAY}",
}
SCHEMAS = {**DIMENSIONS, **FACTS}
# Rollups kept beside the tables, see ``plans.marts``. Types have no comma and space in them.
MARTS = {
    "agg_song_day": "song_key bigint, date_key bigint, n bigint, sum_popularity_score bigint, "
    "sum_daily_rank bigint, max_popularity_score int, weight bigint, artists array<bigint>, "
    f"{_DAY}",
    "agg_song_month": "song_key bigint, country_key bigint, album_key bigint, n bigint, "
    "sum_popularity_score bigint, sum_daily_rank bigint, max_popularity_score int, fan bigint, "
    "fan_popularity_score bigint, fan_daily_rank bigint, artists array<bigint>, "
    "number_one_days array<date>, number_one_fan bigint, number_one_artists array<bigint>, "
    "snapshot_month date",
    "agg_artist_month": "artist_key bigint, song_key bigint, country_key bigint, n bigint, "
    "sum_song_popularity bigint, sum_artist_score decimal(38,2), snapshot_month date",
}
MONTH = "snapshot_month"
# Of stored and staged tables: a tenth smaller than Spark's default, in the same time.
CODEC = "zstd"
_ORDER = (MONTH, "song_key", "snapshot_date")

NATURAL_KEYS = {
    "dim_song": ("spotify_id",),
    "dim_artist": ("artist_name",),
    "dim_album": ("album_name", "release_date"),
    "dim_date": ("full_date",),
    "dim_country": ("country_code",),
    "dim_audio_features": (
        "energy_level",
        "danceability_level",
        "valence_level",
        "tempo_category",
        "acousticness_level",
    ),
    "fact_song_daily": ("song_key", "date_key", "country_key"),
    "fact_artist_stats": ("artist_key", "song_key", "date_key", "country_key"),
    "fact_chart_position": ("song_key", "date_key", "country_key"),
    "fact_audio_analysis": ("song_key",),
    "fact_streaming_metrics": ("song_key", "date_key", "country_key"),
}


def schema_of(name: str) -> str:
    return SCHEMAS[name] if name in SCHEMAS else MARTS[name]


def by_month(name: str) -> bool:
    return MONTH in schema_of(name)


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(schema_of(name)).parquet(f"{path}/{name}")


def _by_song(df: DataFrame) -> DataFrame:
    """Rows of a task by month and song: aggregates by song then shrink before they shuffle."""
    order = [c for c in _ORDER if c in df.columns]
    return df.sortWithinPartitions(*order) if order else df


def _month_layout(df: DataFrame) -> DataFrame:
    """Small months merged into one task, large ones split over several."""
    return _by_song(df.hint("rebalance", F.col(MONTH)))


def write_table(
    df: DataFrame, path: str, name: str, mode: str = "overwrite", laid_out: bool = False
) -> None:
    """Writes one table, dated facts in month partitions.

    ``laid_out`` tells that the rows come by month, from a stage or out of a shuffle:
    then each task writes what it has, without another shuffle.
    """
    if by_month(name):
        rows = _by_song(df) if laid_out else _month_layout(df)
        rows.write.mode(mode).option("compression", CODEC).partitionBy(MONTH).parquet(f"{path}/{name}")
    else:
        df.hint("rebalance").write.mode(mode).option("compression", CODEC).parquet(f"{path}/{name}")


def write_parts(df: DataFrame, path: str, part: str) -> None:
    """Writes rows of several tables, told apart by ``part``, to a folder of months for each."""
    rows = df.sortWithinPartitions(part, *[c for c in _ORDER if c in df.columns])
    rows.write.option("compression", CODEC).partitionBy(part, MONTH).parquet(path)


def write_tables(
    tables: Mapping[str, DataFrame],
    path: str,
    mode: str = "overwrite",
    laid_out: Collection[str] = (),
    at_once: int = 4,
) -> None:
    """Writes several tables, a few at a time, so that short jobs fill idle executors."""
    with ThreadPoolExecutor(at_once) as pool:
        writes = [
            pool.submit(write_table, df, path, name, mode, name in laid_out)
            for name, df in tables.items()
        ]
        for write in writes:
            write.result()


def create_missing(spark: SparkSession, path: str, names: Iterable[str] = (*SCHEMAS, *MARTS)) -> None:
    """Makes an empty table of each that is not there yet."""
    for name in names:
        empty = spark.createDataFrame([], schema_of(name)).write.mode("ignore")
        (empty.partitionBy(MONTH) if by_month(name) else empty).parquet(f"{path}/{name}")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Result as CSV with a header; ``single_file`` is for small results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def materialise(
    df: DataFrame, path: str, month_layout: bool = False, laid_out: bool = False
) -> DataFrame:
    """Writes a result once and reads it from there: reuse that survives lost executors."""
    if month_layout:
        rows = _by_song(df) if laid_out else _month_layout(df)
        rows.write.mode("overwrite").option("compression", CODEC).partitionBy(MONTH).parquet(path)
    else:
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
