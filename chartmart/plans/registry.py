"""Queries by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from chartmart.plans import analyses, catalogue, summaries

CATALOGUE: dict[str, Callable[..., DataFrame]] = {
    name: getattr(catalogue, name)
    for name in (
        "top_songs_global",
        "trending_songs",
        "genre_trends",
        "audio_features_trending",
        "top_artists",
        "artists_global_reach",
        "trending_artists",
        "artist_followers",
        "top_songs_by_country",
        "popularity_by_country",
        "biggest_music_markets",
        "regional_music_preferences",
        "popularity_by_weekday",
        "popularity_by_month",
        "longest_number_one",
        "days_at_number_one",
        "top_albums",
        "album_type_analysis",
        "album_release_trends",
        "audio_features_popularity",
        "mood_analysis",
        "explicit_analysis",
        "summary_stats",
        "duration_analysis",
    )
}
# There is no continent in the data: the older name means countries.
CATALOGUE["popularity_by_continent"] = catalogue.popularity_by_country

ANALYSES: dict[str, Callable[..., DataFrame]] = {
    name: getattr(analyses, name)
    for name in (
        "top_songs_in_country",
        "hottest_artists",
        "viral_songs",
        "workout_playlist",
        "top_earners",
        "promotion_candidates",
        "playlist_of_day",
        "top_ranks_in_countries",
        "artist_growth",
        "song_listing",
    )
}

SUMMARIES: dict[str, Callable[..., DataFrame]] = {
    name: getattr(summaries, name)
    for name in (
        "mood_distribution",
        "energy_dance_matrix",
        "artist_tier_sizes",
        "regional_moods",
        "popularity_by_energy",
        "popularity_by_danceability",
        "explicit_types",
        "headline_numbers",
    )
}

ALL = {**CATALOGUE, **ANALYSES, **SUMMARIES}


def run(name: str, tables: Mapping[str, DataFrame], **params: object) -> DataFrame:
    """A named query over warehouse tables."""
    if name not in ALL:
        raise KeyError(f"no query {name!r}; there are {sorted(ALL)}")
    return ALL[name](tables, **params)
