"""Dimension builders over clean rows.

``created_at`` is the first day a key was seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.functions.classify import FEATURE_LABELS, season
from chartmart.functions.clean import DEFAULT_COUNTRY, split_artists
from chartmart.functions.keys import with_key
from chartmart.operators.rows import first_per
from chartmart.plans.transform import label_feed
from chartmart.sources.feed import SEQ

DEFAULT_COUNTRY_NAME = "Global"


def _first_seen() -> Column:
    return F.min("snapshot_date").cast("timestamp").alias("created_at")


def dim_artist(clean: DataFrame) -> DataFrame:
    names = clean.select(
        F.explode(split_artists(F.col("artists"))).alias("artist_name"), "snapshot_date"
    )
    return with_key(names.groupBy("artist_name").agg(_first_seen()), ["artist_name"], "artist_key")


def dim_album(clean: DataFrame) -> DataFrame:
    albums = (
        clean.filter(F.col("album_name").isNotNull())
        .groupBy("album_name", F.col("album_release_date").alias("release_date"))
        .agg(_first_seen())
        .select(
            "album_name",
            "release_date",
            F.year("release_date").alias("release_year"),
            F.month("release_date").alias("release_month"),
            "created_at",
        )
    )
    return with_key(albums, ["album_name", "release_date"], "album_key")


def dim_date(clean: DataFrame) -> DataFrame:
    day = F.col("full_date")
    days = (
        clean.select(F.col("snapshot_date").alias("full_date"))
        .distinct()
        .select(
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.dayofmonth(day).alias("day"),
            F.weekday(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.weekofyear(day).alias("week_of_year"),
            (F.weekday(day) >= 5).alias("is_weekend"),
            season(F.month(day)).alias("season"),
        )
    )
    return with_key(days, ["full_date"], "date_key")


def with_default_member(dim: DataFrame, code: str = DEFAULT_COUNTRY) -> DataFrame:
    """Adds the default country; one that the data brought keeps its own name."""
    default = dim.sparkSession.range(1).select(
        F.lit(code).alias("country_code"),
        F.lit(DEFAULT_COUNTRY_NAME).alias("country_name"),
        F.lit(1).alias("_rank"),
    )
    known = dim.select("country_code", "country_name", F.lit(0).alias("_rank"))
    return first_per(known.unionByName(default), ["country_code"], ["_rank"]).drop("_rank")


def dim_country(clean: DataFrame) -> DataFrame:
    codes = clean.select(F.col("country").alias("country_code")).dropna().distinct()
    named = codes.withColumn("country_name", F.col("country_code"))
    return with_key(with_default_member(named), ["country_code"], "country_key")


def dim_song(clean: DataFrame) -> DataFrame:
    """Attributes as first seen; later changes are ignored."""
    first = F.min_by(F.struct("name", "duration_ms", "is_explicit"), F.col(SEQ))
    songs = (
        clean.groupBy("spotify_id")
        .agg(first.alias("first"), _first_seen())
        .select(
            "spotify_id",
            F.col("first.name").alias("song_name"),
            F.col("first.duration_ms").alias("duration_ms"),
            F.col("first.is_explicit").alias("is_explicit"),
            "created_at",
        )
    )
    return with_key(songs, ["spotify_id"], "song_key")


def dim_audio_features(clean: DataFrame) -> DataFrame:
    combos = (
        label_feed(clean)
        .select("feature_labels.*", "snapshot_date")
        .groupBy(*FEATURE_LABELS)
        .agg(_first_seen())
    )
    return with_key(combos, list(FEATURE_LABELS), "features_key")
