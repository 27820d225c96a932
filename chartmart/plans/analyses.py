"""Further analyses of songs, artists and playlists, each with its cut points as parameters.

Artists are reached through artist rows of the same song, day and country.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.functions.metrics import average
from chartmart.operators.aggregate import partial
from chartmart.operators.joins import star
from chartmart.operators.rows import down, on_day, recent, top_k, with_previous
from chartmart.plans.catalogue import latest_day
from chartmart.plans.marts import rollup

Tables = Mapping[str, DataFrame]

GRAIN = ["song_key", "date_key", "country_key"]


def _songs(t: Tables) -> DataFrame:
    return t["dim_song"].select("song_key", "song_name")


def _artists(t: Tables) -> DataFrame:
    return t["dim_artist"].select("artist_key", "artist_name")


def _countries(t: Tables) -> DataFrame:
    return t["dim_country"].select("country_key", "country_code", "country_name")


def _artist_keys(rows: DataFrame) -> DataFrame:
    return rows.select(*GRAIN, "artist_key")


def _with_artist_keys(songs: DataFrame, t: Tables) -> DataFrame:
    """``songs`` once per artist that the rollup lists for them."""
    listed = rollup(t, "agg_song_month").select("song_key", "artists")
    return (
        songs.join(listed, "song_key")
        .select(*songs.columns, F.explode("artists").alias("artist_key"))
        .distinct()
    )


def top_songs_in_country(
    t: Tables, country: str = "VN", as_of: dt.date | None = None, days: int = 7, n: int | None = 10
) -> DataFrame:
    """Chart rows of one country in the last days by rank points."""
    as_of = as_of or latest_day(t)
    code = _countries(t).filter(F.col("country_code") == country).select("country_key")
    rows = recent(t["fact_song_daily"], as_of, days).select(
        *GRAIN, "daily_rank", "popularity_score", "rank_points", "snapshot_date"
    )
    listed = star(
        rows.join(code, "country_key").join(
            _artist_keys(recent(t["fact_artist_stats"], as_of, days)), GRAIN
        ),
        {"song_key": _songs(t), "artist_key": _artists(t)},
    )
    order = [
        down("rank_points"),
        F.asc("song_name"),
        F.asc("artist_name"),
        F.asc("snapshot_date"),
        F.asc("daily_rank"),
        F.asc("popularity_score"),
    ]
    return top_k(
        listed.select(
            "song_name",
            "artist_name",
            "snapshot_date",
            "daily_rank",
            "popularity_score",
            "rank_points",
        ),
        order,
        n,
    )


def hottest_artists(
    t: Tables, as_of: dt.date | None = None, days: int = 30, n: int | None = 5
) -> DataFrame:
    rows = recent(t["fact_artist_stats"], as_of or latest_day(t), days)
    grouped = (
        partial(rows, ["artist_key", "song_key"], sums=["artist_score"])
        .groupBy("artist_key")
        .agg(
            F.count(F.lit(1)).alias("num_songs"),
            average(F.sum("sum_artist_score"), F.sum("n")).alias("avg_score"),
        )
        .join(_artists(t), "artist_key")
        .select("artist_name", "num_songs", "avg_score")
    )
    return top_k(grouped, [down("avg_score"), F.asc("artist_name")], n)


def viral_songs(t: Tables, as_of: dt.date | None = None, min_trend: float = 5) -> DataFrame:
    """Rising songs with a strong trend on one day."""
    day = as_of or latest_day(t)
    rows = (
        on_day(t["fact_chart_position"], day)
        .filter(F.col("is_rising") & (F.col("trend_strength") > min_trend))
        .select(*GRAIN, "current_rank", "daily_movement", "trend_strength")
    )
    listed = star(
        rows.join(_artist_keys(on_day(t["fact_artist_stats"], day)), GRAIN),
        {"song_key": _songs(t), "artist_key": _artists(t), "country_key": _countries(t)},
    )
    return listed.select(
        "song_name",
        "artist_name",
        "country_code",
        "current_rank",
        "daily_movement",
        "trend_strength",
    ).orderBy(down("trend_strength"), "song_name", "artist_name", "country_code")


def _lively(t: Tables, energy: float, danceability: float, tempo: float) -> DataFrame:
    return (
        t["fact_audio_analysis"]
        .filter(
            (F.col("energy") > energy)
            & (F.col("danceability") > danceability)
            & (F.col("tempo") > tempo)
        )
        .select("song_key", "energy", "danceability", "tempo")
    )


def workout_playlist(
    t: Tables,
    energy: float = 0.8,
    danceability: float = 0.7,
    tempo: float = 120,
    n: int | None = 50,
) -> DataFrame:
    """Energetic, danceable, fast songs with their artists."""
    listed = star(
        _with_artist_keys(_lively(t, energy, danceability, tempo), t),
        {"song_key": _songs(t), "artist_key": _artists(t)},
    ).select("song_name", "artist_name", "energy", "danceability", "tempo")
    order = [
        down("energy"),
        down("tempo"),
        F.asc("song_name"),
        F.asc("artist_name"),
        F.asc("danceability"),
    ]
    return top_k(listed, order, n)


def playlist_of_day(
    t: Tables,
    as_of: dt.date | None = None,
    energy: float = 0.8,
    danceability: float = 0.7,
    tempo: float = 130,
    n: int | None = 50,
) -> DataFrame:
    """The same songs as charted on one day, with that day's popularity in each country."""
    day = as_of or latest_day(t)
    rows = on_day(t["fact_song_daily"], day).select(*GRAIN, "popularity_score")
    listed = star(
        rows.join(_lively(t, energy, danceability, tempo), "song_key").join(
            _artist_keys(on_day(t["fact_artist_stats"], day)), GRAIN
        ),
        {"song_key": _songs(t), "artist_key": _artists(t), "country_key": _countries(t)},
    ).select(
        "song_name",
        "artist_name",
        "country_code",
        "energy",
        "danceability",
        "tempo",
        "popularity_score",
    )
    order = [
        down("energy"),
        down("tempo"),
        F.asc("song_name"),
        F.asc("artist_name"),
        F.asc("country_code"),
        F.asc("popularity_score"),
        F.asc("danceability"),
    ]
    return top_k(listed, order, n)


def top_earners(
    t: Tables, as_of: dt.date | None = None, days: int = 90, n: int | None = 20
) -> DataFrame:
    """Songs by estimated streams of the last days."""
    as_of = as_of or latest_day(t)
    rows = recent(t["fact_streaming_metrics"], as_of, days).select(*GRAIN, "estimated_streams")
    met = _artist_keys(recent(t["fact_artist_stats"], as_of, days))
    summed = (
        rows.join(met, GRAIN)
        .groupBy("song_key", "artist_key", "country_key")
        .agg(F.sum("estimated_streams").alias("streams"))
    )
    grouped = (
        star(summed, {"song_key": _songs(t), "artist_key": _artists(t)})
        .groupBy("song_name", "artist_name")
        .agg(
            F.sum("streams").cast("bigint").alias("total_streams"),
            F.count_distinct("country_key").alias("countries"),
        )
    )
    order = [down("total_streams"), F.asc("song_name"), F.asc("artist_name")]
    return top_k(grouped, order, n)


def promotion_candidates(
    t: Tables,
    as_of: dt.date | None = None,
    min_trend: float = 7,
    min_engagement: float = 80,
    n: int | None = 10,
) -> DataFrame:
    """Rising songs with a strong trend and high engagement, and in how many countries."""
    day = as_of or latest_day(t)
    rising = (
        on_day(t["fact_chart_position"], day)
        .filter(F.col("is_rising") & (F.col("trend_strength") > min_trend))
        .select(*GRAIN, "trend_strength")
    )
    engaging = (
        on_day(t["fact_streaming_metrics"], day)
        .filter(F.col("engagement_score") > min_engagement)
        .select(*GRAIN, "engagement_score")
    )
    rows = (
        rising.join(engaging, GRAIN)
        .join(t["fact_audio_analysis"].select("song_key", "energy"), "song_key")
        .join(_artist_keys(on_day(t["fact_artist_stats"], day)), GRAIN)
    )
    keys = ["song_name", "artist_name", "trend_strength", "energy", "engagement_score"]
    grouped = (
        star(rows, {"song_key": _songs(t), "artist_key": _artists(t)})
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("countries_trending"))
    )
    order = [
        down("trend_strength"),
        F.asc("song_name"),
        F.asc("artist_name"),
        F.asc("energy"),
        F.asc("engagement_score"),
    ]
    return top_k(grouped, order, n)


def top_ranks_in_countries(
    t: Tables,
    as_of: dt.date | None = None,
    countries: Sequence[str] = ("VN", "KR", "US", "BR", "IN"),
    k: int = 10,
) -> DataFrame:
    """The first ``k`` ranks of one day in a list of countries."""
    day = as_of or latest_day(t)
    rows = (
        on_day(t["fact_song_daily"], day)
        .filter(F.col("daily_rank") <= k)
        .select(*GRAIN, "daily_rank", "popularity_score")
    )
    wanted = _countries(t).filter(F.col("country_code").isin(*countries))
    listed = star(
        rows.join(wanted, "country_key").join(
            _artist_keys(on_day(t["fact_artist_stats"], day)), GRAIN
        ),
        {"song_key": _songs(t), "artist_key": _artists(t)},
    )
    return listed.select(
        "country_code",
        "country_name",
        "song_name",
        "artist_name",
        "daily_rank",
        "popularity_score",
    ).orderBy("country_code", "daily_rank", "song_name", "artist_name")


def artist_growth(t: Tables, year: int | None = None) -> DataFrame:
    """Monthly average score of each artist in a year, and its change from the month before."""
    year = year or latest_day(t).year
    months = t["dim_date"].filter(F.col("year") == year).select("date_key", "month")
    first, last = dt.date(year, 1, 1), dt.date(year, 12, 31)
    rows = t["fact_artist_stats"].filter(
        F.col("snapshot_date").between(first, last)
        & F.col("snapshot_month").between(first, last)
    )
    monthly = (
        partial(rows, ["artist_key", "date_key", "song_key"], sums=["artist_score"])
        .join(months, "date_key")
        .groupBy("artist_key", "month")
        .agg(
            F.count_distinct("song_key").alias("num_songs"),
            average(F.sum("sum_artist_score"), F.sum("n")).alias("avg_score"),
        )
    )
    moved = with_previous(monthly, ["artist_key"], ["month"], "avg_score", "prev_score", "growth")
    return (
        moved.join(_artists(t), "artist_key")
        .select("artist_name", "month", "num_songs", "avg_score", "growth")
        .orderBy(down("growth"), "artist_name", "month")
    )


def song_listing(t: Tables, n: int | None = 10) -> DataFrame:
    """Songs, artists and ranks, best ranks and latest days first."""
    rows = t["fact_song_daily"].select(*GRAIN, "daily_rank", "snapshot_date")
    listed = star(
        rows.join(_artist_keys(t["fact_artist_stats"]), GRAIN),
        {"song_key": _songs(t), "artist_key": _artists(t), "country_key": _countries(t)},
    ).select("song_name", "artist_name", "country_code", "snapshot_date", "daily_rank")
    order = [
        F.asc("daily_rank"),
        down("snapshot_date"),
        F.asc("song_name"),
        F.asc("artist_name"),
        F.asc("country_code"),
    ]
    return top_k(listed, order, n)
