"""Fact builders.

``resolve_keys`` gives clean rows their dimension keys, ``chart_rows`` keeps
the first row per song, day and country, and each fact is a projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.functions import metrics as m
from chartmart.functions.classify import FEATURE_LABELS
from chartmart.functions.clean import clean_country, split_artists
from chartmart.functions.keys import key_of
from chartmart.operators.joins import lookup
from chartmart.operators.rows import first_per
from chartmart.plans.transform import label_feed
from chartmart.sources.feed import SEQ

GRAIN = ("song_key", "date_key", "country_key")
NO_ALBUM_PLACES = 1000
ARTIST_GRAIN = ("artist_key", *GRAIN)
# Tasks, and so files, that a month is dealt to by song.
SHARES = 8
SHARE = ("snapshot_month", "_share")


def resolve_keys(clean: DataFrame, dims: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Clean rows with song, date, country and album key, and default rank and popularity.

    Keys are hashes of natural keys, so rows whose dimensions were built from
    the same feed get them without a join. With ``dims`` they are looked up:
    an unknown song or day drops the row, an unknown country falls back to the
    default member, an unknown album stays null.
    """
    rows = label_feed(clean).withColumns(
        {
            "country_code": clean_country(F.col("country")),
            "rank": F.coalesce(F.col("daily_rank"), F.lit(m.MISSING_RANK)),
            "popularity": F.coalesce(F.col("popularity"), F.lit(m.MISSING_POPULARITY)),
            "snapshot_month": F.trunc("snapshot_date", "MM"),
        }
    )
    if dims is None:
        album = F.when(
            F.col("album_name").isNotNull(), key_of("album_name", "album_release_date")
        )
        return rows.withColumns(
            {
                "song_key": key_of("spotify_id"),
                "date_key": key_of("snapshot_date"),
                "country_key": key_of("country_code"),
                "album_key": album,
                "features_key": key_of(*[F.col(f"feature_labels.{f}") for f in FEATURE_LABELS]),
            }
        )
    songs = dims["dim_song"].select("song_key", "spotify_id")
    days = dims["dim_date"].select("date_key", F.col("full_date").alias("snapshot_date"))
    countries = dims["dim_country"].select("country_key", "country_code")
    albums = dims["dim_album"].select(
        "album_key", "album_name", F.col("release_date").alias("album_release_date")
    )
    combos = dims["dim_audio_features"].select(
        "features_key", F.struct(*FEATURE_LABELS).alias("feature_labels")
    )
    fallback = {"country_key": key_of(clean_country(F.lit(None).cast("string")))}
    rows = lookup(rows, songs, ["spotify_id"])
    rows = lookup(rows, days, ["snapshot_date"])
    rows = lookup(rows, countries, ["country_code"], "left", default=fallback)
    # Rows without an album match none: spread, they are not one key in the join.
    place = F.pmod(F.xxhash64("song_key", "snapshot_date", "country_key"), F.lit(NO_ALBUM_PLACES))
    rows = rows.withColumn("_place", F.when(F.isnull("album_name"), place).otherwise(-1))
    albums = albums.withColumn("_place", F.lit(-1).cast("bigint"))
    album = ["album_name", "album_release_date", "_place"]
    rows = lookup(rows, albums, album, "left", null_safe=True).drop("_place")
    return lookup(rows, combos, ["feature_labels"], "left")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows by month and a share of its songs (``SHARE``): grouped and written there without a second shuffle."""
    return rows.withColumn("_share", F.pmod("song_key", F.lit(SHARES))).repartition(*SHARE)


def _first_unknown(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], known: DataFrame | None
) -> DataFrame:
    """First row of each key that ``known`` rows do not have, dealt by month and share.

    A day lies in one month and a song in one share: they divide no key. Known keys are dealt with the
    rows and come first among them, so that neither is shuffled again to meet the other.
    """
    if known is None:
        return first_per(dealt(rows), (*keys, *SHARE), order).drop("_share")
    there = known.select(*keys, "snapshot_month", F.lit(True).alias("_known"))
    both = rows.withColumn("_known", F.lit(False)).unionByName(there, allowMissingColumns=True)
    first = first_per(dealt(both), (*keys, *SHARE), [F.desc("_known"), *order])
    return first.filter("NOT _known").drop("_known", "_share")


def chart_rows(keyed: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """First row per song, day and country: the rows behind three of the facts, laid out by month.

    Keys of ``known`` chart rows are left out.
    """
    columns = (
        *GRAIN,
        "album_key",
        "rank",
        "popularity",
        "daily_movement",
        "weekly_movement",
        "snapshot_date",
        "snapshot_month",
        SEQ,
    )
    return _first_unknown(keyed.select(*columns), GRAIN, [SEQ], known).drop(SEQ)


def song_daily_of(rows: DataFrame) -> DataFrame:
    rank, popularity = F.col("rank"), F.col("popularity")
    return rows.select(
        *GRAIN,
        "album_key",
        rank.alias("daily_rank"),
        popularity.alias("popularity_score"),
        m.rank_points(rank).alias("rank_points"),
        m.performance_index(rank, popularity).alias("performance_index"),
        "snapshot_date",
        "snapshot_month",
    )


def chart_position_of(rows: DataFrame) -> DataFrame:
    daily, weekly = F.col("daily_movement"), F.col("weekly_movement")
    size = m.movement_magnitude(daily, weekly)
    return rows.select(
        *GRAIN,
        F.col("rank").alias("current_rank"),
        m.previous_rank(F.col("rank"), daily).alias("previous_rank"),
        "daily_movement",
        "weekly_movement",
        m.is_rising(daily, weekly).alias("is_rising"),
        m.is_falling(daily, weekly).alias("is_falling"),
        size.alias("movement_magnitude"),
        m.trend_strength(size).alias("trend_strength"),
        "snapshot_date",
        "snapshot_month",
    )


def streaming_metrics_of(rows: DataFrame) -> DataFrame:
    streams = m.estimated_streams(F.col("rank"))
    size = m.movement_magnitude(F.col("daily_movement"), F.col("weekly_movement"))
    return rows.select(
        *GRAIN,
        streams.alias("estimated_streams"),
        m.estimated_listeners(streams).alias("estimated_listeners"),
        m.completion_rate().alias("avg_completion_rate"),
        m.engagement_score(F.col("popularity")).alias("engagement_score"),
        m.viral_coefficient(size).alias("viral_coefficient"),
        "snapshot_date",
        "snapshot_month",
    )


def fact_song_daily(keyed: DataFrame) -> DataFrame:
    return song_daily_of(chart_rows(keyed))


def fact_chart_position(keyed: DataFrame) -> DataFrame:
    return chart_position_of(chart_rows(keyed))


def fact_streaming_metrics(keyed: DataFrame) -> DataFrame:
    return streaming_metrics_of(chart_rows(keyed))


def fact_artist_stats(
    keyed: DataFrame, artists: DataFrame | None = None, known: DataFrame | None = None
) -> DataFrame:
    """One row per listed artist, laid out by month; of repeats the first row and list position counts.

    With ``artists`` names are looked up there and unknown ones dropped. Keys of ``known`` rows are left out.
    """
    listed = keyed.select(
        *GRAIN,
        "rank",
        "popularity",
        "snapshot_date",
        "snapshot_month",
        SEQ,
        F.posexplode(split_artists(F.col("artists"))).alias("pos", "artist_name"),
    )
    if artists is None:
        listed = listed.withColumn("artist_key", key_of("artist_name"))
    else:
        listed = lookup(listed, artists.select("artist_key", "artist_name"), ["artist_name"])
    first = _first_unknown(listed.drop("artist_name"), ARTIST_GRAIN, [SEQ, "pos"], known)
    index, pos = m.performance_index(F.col("rank"), F.col("popularity")), F.col("pos")
    return first.select(
        *ARTIST_GRAIN,
        F.col("rank").alias("song_rank"),
        F.col("popularity").alias("song_popularity"),
        (pos + 1).alias("artist_position"),
        m.artist_score(index, pos).alias("artist_score"),
        m.contribution_weight(pos).alias("contribution_weight"),
        "snapshot_date",
        "snapshot_month",
    )


FEATURES = (
    "danceability",
    "energy",
    "key",
    "loudness",
    "mode",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "valence",
    "tempo",
    "time_signature",
)


def fact_audio_analysis(keyed: DataFrame) -> DataFrame:
    """Features of each song as first seen; real numbers are stored as float32."""
    whole = ("key", "mode", "time_signature")
    first = first_per(
        keyed.select("song_key", "features_key", *FEATURES, "snapshot_date", SEQ),
        ["song_key"],
        [SEQ],
    )
    stored = [
        F.col(f).alias("key_signature" if f == "key" else f)
        if f in whole
        else F.col(f).cast("float").alias(f)
        for f in FEATURES
    ]
    return first.select(
        "song_key",
        "features_key",
        *stored,
        m.energy_dance_score(F.col("energy"), F.col("danceability")).alias("energy_dance_score"),
        m.mood_score(F.col("valence"), F.col("energy")).alias("mood_score"),
        F.col("snapshot_date").cast("timestamp").alias("created_at"),
    )
