"""Spark side of the checks for the catalogue, the further analyses and second-stage results."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chartmart.plans import analyses, catalogue, summaries
from checks.warehouse import plain, warehouse

AS_OF = dt.date(2001, 8, 1)
DAY = dt.date(2001, 7, 28)

Query = Callable[[SparkSession, str], DataFrame]


def on_tables(build: Callable[..., DataFrame], *rounded: str, **params: object) -> Query:
    """A driver query that runs ``build`` on the warehouse of the given folder."""
    return lambda spark, sf_dir: plain(build(warehouse(spark, sf_dir), **params), *rounded)


def _shown(name: str, **params: object) -> Query:
    return on_tables(lambda t: summaries.shown(name, t, **params))


QUERIES: dict[str, Query] = {
    "q01_top_songs_global": on_tables(catalogue.top_songs_global),
    "q02_trending_songs": on_tables(catalogue.trending_songs, as_of=AS_OF),
    "q03_genre_trends": on_tables(catalogue.genre_trends),
    "q04_audio_features_trending": on_tables(catalogue.audio_features_trending),
    "q05_top_artists": on_tables(catalogue.top_artists),
    "q06_artists_global_reach": on_tables(catalogue.artists_global_reach),
    "q07_trending_artists": on_tables(catalogue.trending_artists, as_of=AS_OF),
    "q08_artist_followers": on_tables(catalogue.artist_followers),
    "q09_top_songs_by_country": on_tables(catalogue.top_songs_by_country),
    "q10_popularity_by_country": on_tables(catalogue.popularity_by_country),
    "q11_biggest_music_markets": on_tables(catalogue.biggest_music_markets),
    "q12_regional_music_preferences": on_tables(catalogue.regional_music_preferences),
    "q13_popularity_by_weekday": on_tables(catalogue.popularity_by_weekday),
    "q14_popularity_by_month": on_tables(catalogue.popularity_by_month),
    "q15_longest_number_one": on_tables(catalogue.longest_number_one),
    "q15x_days_at_number_one": on_tables(catalogue.days_at_number_one),
    "q16_top_albums": on_tables(catalogue.top_albums),
    "q17_album_type_analysis": on_tables(
        catalogue.album_type_analysis, "avg_popularity", "avg_duration_minutes"
    ),
    "q18_album_release_trends": on_tables(catalogue.album_release_trends),
    "q19_audio_features_popularity": on_tables(catalogue.audio_features_popularity),
    "q20_mood_analysis": on_tables(catalogue.mood_analysis),
    "q21_explicit_analysis": on_tables(catalogue.explicit_analysis),
    "q22_summary_stats": on_tables(catalogue.summary_stats),
    "q23_duration_analysis": on_tables(catalogue.duration_analysis),
    "r01_top_songs_in_country": on_tables(
        analyses.top_songs_in_country, country="N5", as_of=AS_OF
    ),
    "r02_hottest_artists": on_tables(analyses.hottest_artists, as_of=AS_OF),
    "r03_viral_songs": on_tables(analyses.viral_songs, as_of=DAY),
    "r04_workout_playlist": on_tables(analyses.workout_playlist),
    "r05_top_earners": on_tables(analyses.top_earners, as_of=AS_OF),
    "r06_promotion_candidates": on_tables(analyses.promotion_candidates, as_of=DAY),
    "r07_playlist_of_day": on_tables(analyses.playlist_of_day, as_of=DAY),
    "r08_top_ranks_in_countries": on_tables(
        analyses.top_ranks_in_countries, as_of=DAY, countries=("N1", "N2", "N5", "N9", "GLOBAL")
    ),
    "r09_artist_growth": on_tables(analyses.artist_growth, year=2000),
    "r10_song_listing": on_tables(analyses.song_listing),
    "g1_mood_distribution": on_tables(summaries.mood_distribution, cut=20),
    "g1_mood_distribution_all": on_tables(summaries.mood_distribution),
    "g2_energy_dance_matrix": on_tables(summaries.energy_dance_matrix, cut=20),
    "g2_energy_dance_matrix_all": on_tables(summaries.energy_dance_matrix),
    "g3_artist_tier_sizes": on_tables(summaries.artist_tier_sizes, cut=50),
    "g3_artist_tier_sizes_all": on_tables(summaries.artist_tier_sizes),
    "g4_regional_moods": on_tables(summaries.regional_moods, cut=100),
    "g4_regional_moods_all": on_tables(summaries.regional_moods),
    "g5_popularity_by_energy": on_tables(
        summaries.popularity_by_energy, "avg_popularity", cut=30
    ),
    "g5_popularity_by_energy_all": on_tables(summaries.popularity_by_energy, "avg_popularity"),
    "g6_popularity_by_danceability": on_tables(
        summaries.popularity_by_danceability, "avg_popularity", cut=30
    ),
    "g6_popularity_by_danceability_all": on_tables(
        summaries.popularity_by_danceability, "avg_popularity"
    ),
    "g7_explicit_types": on_tables(summaries.explicit_types),
    "g8_headline_numbers": on_tables(summaries.headline_numbers),
    "g9_shown_top_songs_global": _shown("top_songs_global"),
    "g9_shown_genre_trends": _shown("genre_trends"),
    "g9_shown_top_artists": _shown("top_artists"),
    "g9_shown_artists_global_reach": _shown("artists_global_reach"),
    "g9_shown_trending_artists": _shown("trending_artists", as_of=AS_OF),
    "g9_shown_artist_followers": _shown("artist_followers"),
    "g9_shown_longest_number_one": _shown("longest_number_one"),
    "g9_shown_top_albums": _shown("top_albums"),
}
