"""Second-stage results: aggregates of query results, as a dashboard shows them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.functions.classify import explicit_label
from chartmart.operators.joins import keep_keys
from chartmart.operators.rows import down, top_k
from chartmart.plans import catalogue as q

Tables = Mapping[str, DataFrame]


def mood_distribution(t: Tables, cut: int | None = None) -> DataFrame:
    """Here and below, ``cut`` limits the first result as the dashboard does; ``None`` takes all."""
    return q.audio_features_trending(t, n=cut).groupBy("mood").agg(F.sum("song_count").alias("song_count"))


def energy_dance_matrix(t: Tables, cut: int | None = None) -> DataFrame:
    return (
        q.audio_features_trending(t, n=cut)
        .groupBy("energy_level", "danceability_level")
        .agg(F.sum("song_count").alias("song_count"))
    )


def artist_tier_sizes(t: Tables, cut: int | None = None) -> DataFrame:
    return q.artist_followers(t, n=cut).groupBy("artist_tier").agg(F.count(F.lit(1)).alias("count"))


def regional_moods(t: Tables, k: int = 10, cut: int | None = None) -> DataFrame:
    """Moods of the ``k`` regions with most rows.

    ``cut`` limits the regional result first, as a dashboard would (100 rows);
    without it all regions count.
    """
    moods = (
        q.regional_music_preferences(t, n=cut)
        .groupBy("region", "mood")
        .agg(F.sum("song_count").alias("song_count"))
    )
    totals = moods.groupBy("region").agg(F.sum("song_count").alias("total"))
    best = top_k(totals, [down("total"), F.asc("region")], k)
    return keep_keys(moods, best, ["region"])


def _feature_popularity(t: Tables, level: str, cut: int | None) -> DataFrame:
    return (
        q.audio_features_popularity(t, n=cut)
        .groupBy(level)
        .agg(
            F.avg("avg_popularity").alias("avg_popularity"),
            F.sum("song_count").alias("song_count"),
        )
    )


def popularity_by_energy(t: Tables, cut: int | None = None) -> DataFrame:
    """Unweighted mean of group averages."""
    return _feature_popularity(t, "energy_level", cut)


def popularity_by_danceability(t: Tables, cut: int | None = None) -> DataFrame:
    return _feature_popularity(t, "danceability_level", cut)


def explicit_types(t: Tables) -> DataFrame:
    return q.explicit_analysis(t).withColumn("type", explicit_label(F.col("is_explicit")))


def headline_numbers(t: Tables) -> DataFrame:
    """Summary with 0 where there is nothing yet."""
    zero = F.lit(0)
    counts = ["total_songs", "total_artists", "total_countries", "total_albums"]
    return q.summary_stats(t).select(
        *[F.coalesce(F.col(c), zero).cast("bigint").alias(c) for c in counts],
        F.coalesce(F.col("avg_popularity"), F.lit(0.0)).alias("avg_popularity"),
        F.coalesce(F.col("max_popularity"), zero).cast("double").alias("max_popularity"),
    )


# How many rows of each ordered result are shown.
SHOWN = {
    "top_songs_global": 15,
    "genre_trends": 10,
    "top_artists": 15,
    "artists_global_reach": 15,
    "trending_artists": 15,
    "artist_followers": 15,
    "longest_number_one": 15,
    "top_albums": 15,
}


def shown(name: str, t: Tables, **params: object) -> DataFrame:
    """The first rows of a query as shown in its chart."""
    return getattr(q, name)(t, **params).limit(SHOWN[name])
