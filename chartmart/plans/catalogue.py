"""The query catalogue over the warehouse tables.

Every query takes the tables by name and returns an ordered DataFrame: one lazy plan, the same for
every limit. Queries over whole months read the rollups of ``plans.marts``, so no fact is shuffled;
others first aggregate a fact by song or artist key (``partial``). Dimension joins and distinct counts
then work on keys instead of chart rows. Artist name lists are made only for the groups that a limit
has chosen, from the artists that the rollup rows of those groups carry.

Queries marked "fan" are defined over chart rows left-joined to artist rows on song and day alone: one
chart row counts once per artist row of that song and day in any country. The rollups hold those
weighted sums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.functions import classify as k
from chartmart.functions.metrics import average, points_total
from chartmart.operators.aggregate import one_row, partial, summed, text_list
from chartmart.operators.rows import down, recent, top_k, top_k_per, with_previous
from chartmart.plans.marts import rollup

Tables = Mapping[str, DataFrame]


# --- shared pieces ------------------------------------------------------------


def latest_day(t: Tables) -> dt.date:
    """The last day in the warehouse: the default ``as_of``."""
    return t["dim_date"].agg(F.max("full_date")).first()[0]


def _dim(t: Tables, name: str, *cols: str) -> DataFrame:
    return t[name].select(*cols)


def _n_avg(col: str) -> Column:
    """Mean of ``col`` over rows summed up by ``partial``."""
    return average(F.sum(f"sum_{col}"), F.sum("n"))


def _fan_avg(col: str) -> Column:
    """Mean of ``col`` over joined rows, from the weighted sums of the rollups."""
    return average(F.sum(f"fan_{col}"), F.sum("fan"))


def _songs(t: Tables, keys: Sequence[str], sums: Sequence[str] = (), **others: Column) -> DataFrame:
    """The song rollup summed up by ``keys``: ``n``, ``sum_<c>`` and ``others``."""
    return summed(rollup(t, "agg_song_month"), keys, ["n", *[f"sum_{c}" for c in sums]], **others)


def _points(rows: str = "n", ranks: str = "sum_daily_rank") -> Column:
    """Rank points of all rows of a group."""
    return points_total(F.sum(rows), F.sum(ranks)).cast("double")


def _distinct_artists(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of distinct artists that the rollup rows of each key carry."""
    return (
        rows.select(*keys, F.explode("artists").alias("artist_key"))
        .groupBy(*keys)
        .agg(F.count_distinct("artist_key").alias(name))
    )


def _with_artists(
    best: DataFrame,
    spread: DataFrame,
    rows: DataFrame,
    on: Sequence[str],
    t: Tables,
    order: Sequence[Column],
    n: int | None,
    listed: str = "artists",
) -> DataFrame:
    """``best`` with ``artist_name``: the distinct artists that the rows of each group list.

    ``spread`` is ``best`` with the keys ``on`` of its groups, so the groups are computed once. Their
    rows exist, since the groups were made of them; lists may be empty. The ``n`` groups come out in
    ``order``.
    """
    cols = best.columns
    named = (
        spread.select(*cols, *[c for c in on if c not in cols])
        .join(rows.select(*on, listed), list(on))
        .select(*cols, F.explode_outer(listed).alias("artist_key"))
        .join(_dim(t, "dim_artist", "artist_key", "artist_name"), "artist_key", "left")
    )
    return top_k(text_list(named, cols, "artist_name", "artist_name"), order, n)


# --- songs --------------------------------------------------------------------


def top_songs_global(t: Tables, n: int | None = 20) -> DataFrame:
    """Songs by name with the best average popularity (fan)."""
    rows, songs = rollup(t, "agg_song_month"), _dim(t, "dim_song", "song_key", "song_name")
    measured = (
        summed(
            rows,
            ["song_key", "country_key"],
            ["fan", "fan_popularity_score", "fan_daily_rank"],
            max_popularity_score=F.max("max_popularity_score"),
        )
        .join(songs, "song_key")
        .join(_dim(t, "dim_country", "country_key", "country_name"), "country_key")
        .groupBy("song_name")
        .agg(
            _fan_avg("popularity_score").alias("avg_popularity"),
            _fan_avg("daily_rank").alias("avg_rank"),
            F.max("max_popularity_score").alias("max_popularity"),
            F.count_distinct("country_name").alias("num_countries"),
        )
    )
    order = [down("avg_popularity"), down("num_countries"), F.asc("song_name")]
    best = top_k(measured, order, n)
    spread = best.join(songs, "song_name")
    return _with_artists(best, spread, rows, ["song_key"], t, order, n).select(
        "song_name", "artist_name", "num_countries", "avg_popularity", "avg_rank", "max_popularity"
    )


def trending_songs(
    t: Tables, as_of: dt.date | None = None, days: int = 30, n: int | None = 50
) -> DataFrame:
    """Average rank per song name and day of the window, with its change (fan)."""
    as_of = as_of or latest_day(t)
    rows = recent(rollup(t, "agg_song_day"), as_of, days).withColumnRenamed("snapshot_date", "date")
    songs = _dim(t, "dim_song", "song_key", "song_name")
    weight = F.col("weight")
    grouped = (
        rows.select(
            "song_key",
            "date",
            (F.col("n") * weight).alias("fan"),
            (F.col("sum_daily_rank") * weight).alias("fan_daily_rank"),
            (F.col("sum_popularity_score") * weight).alias("fan_popularity_score"),
        )
        .join(songs, "song_key")
        .groupBy("song_name", "date")
        .agg(
            _fan_avg("daily_rank").alias("avg_rank"),
            _fan_avg("popularity_score").alias("avg_popularity"),
        )
    )
    moved = with_previous(grouped, ["song_name"], ["date"], "avg_rank", "prev_rank", "rank_change")
    order = [down("date"), down("avg_popularity"), F.asc("song_name")]
    best = top_k(moved, order, n)
    spread = best.join(songs, "song_name")
    return _with_artists(best, spread, rows, ["song_key", "date"], t, order, n).select(
        "song_name",
        "artist_name",
        "date",
        "avg_rank",
        "avg_popularity",
        "prev_rank",
        "rank_change",
    )


def genre_trends(t: Tables, n: int | None = 15) -> DataFrame:
    """Music categories drawn from audio features."""
    per_song = _songs(t, ["song_key"], ["popularity_score", "daily_rank"])
    audio = t["fact_audio_analysis"].select(
        "song_key",
        k.music_category(
            F.col("energy"), F.col("danceability"), F.col("acousticness"), F.col("valence")
        ).alias("music_category"),
    )
    grouped = (
        per_song.join(audio, "song_key")
        .groupBy("music_category")
        .agg(
            # One row per song here, so rows are songs.
            F.count(F.lit(1)).alias("num_songs"),
            _n_avg("popularity_score").alias("avg_popularity"),
            _n_avg("daily_rank").alias("avg_rank"),
            _points().alias("total_rank_points"),
        )
    )
    return top_k(grouped, [down("avg_popularity"), F.asc("music_category")], n)


def audio_features_trending(t: Tables, min_pop: int = 70, n: int | None = 20) -> DataFrame:
    """Feature levels of chart rows with high popularity."""
    popular = t["fact_song_daily"].filter(F.col("popularity_score") >= min_pop)
    audio = t["fact_audio_analysis"].select(
        "song_key",
        k.level3(F.col("energy"), k.ENERGY3).alias("energy_level"),
        k.level3(F.col("danceability"), k.DANCE3).alias("danceability_level"),
        k.level3(F.col("valence"), k.VALENCE3).alias("valence_level"),
        k.mood_trending(F.col("valence"), F.col("energy")).alias("mood"),
    )
    keys = ["energy_level", "danceability_level", "valence_level", "mood"]
    grouped = (
        partial(popular, ["song_key"], sums=["popularity_score"])
        .join(audio, "song_key")
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("song_count"),
            _n_avg("popularity_score").alias("avg_popularity"),
        )
    )
    return top_k(grouped, [down("song_count"), *keys], n)


# --- artists ------------------------------------------------------------------


def _artist_measures(t: Tables) -> DataFrame:
    """Artist rows summed up per artist, song and country."""
    return summed(
        rollup(t, "agg_artist_month"),
        ["artist_key", "song_key", "country_key"],
        ["n", "sum_song_popularity", "sum_artist_score"],
    )


def _artist_names(t: Tables) -> DataFrame:
    return _dim(t, "dim_artist", "artist_key", "artist_name")


def top_artists(t: Tables, n: int | None = 20) -> DataFrame:
    grouped = (
        _artist_measures(t)
        .groupBy("artist_key")
        .agg(
            F.count_distinct("song_key").alias("total_songs"),
            F.count_distinct("country_key").alias("countries_present"),
            _n_avg("artist_score").alias("avg_artist_score"),
            _n_avg("song_popularity").alias("avg_popularity"),
        )
        .join(_artist_names(t), "artist_key")
        .select(
            "artist_name",
            "total_songs",
            "countries_present",
            "avg_artist_score",
            "avg_popularity",
        )
    )
    order = [down("avg_artist_score"), down("countries_present"), F.asc("artist_name")]
    return top_k(grouped, order, n)


def artists_global_reach(t: Tables, min_countries: int = 5, n: int | None = 20) -> DataFrame:
    grouped = (
        _artist_measures(t)
        .join(_dim(t, "dim_country", "country_key", "country_name"), "country_key")
        .groupBy("artist_key")
        .agg(
            F.count_distinct("country_name").alias("num_countries"),
            F.count_distinct("song_key").alias("num_songs"),
            _n_avg("song_popularity").alias("avg_popularity"),
        )
        .filter(F.col("num_countries") >= min_countries)
        .join(_artist_names(t), "artist_key")
        .select("artist_name", "num_countries", "num_songs", "avg_popularity")
    )
    order = [down("num_countries"), down("avg_popularity"), F.asc("artist_name")]
    return top_k(grouped, order, n)


def trending_artists(
    t: Tables,
    as_of: dt.date | None = None,
    days: int = 60,
    min_growth: float = 5,
    n: int | None = 20,
) -> DataFrame:
    """Artists by the spread of their weekly average popularity in the window."""
    rows = recent(t["fact_artist_stats"], as_of or latest_day(t), days)
    weeks = _dim(t, "dim_date", "date_key", "week_of_year", "year")
    weekly = (
        partial(rows, ["artist_key", "date_key", "song_key"], sums=["song_popularity"])
        .join(weeks, "date_key")
        .groupBy("artist_key", "week_of_year", "year")
        .agg(
            _n_avg("song_popularity").alias("avg_popularity"),
            F.count_distinct("song_key").alias("num_songs_chart"),
        )
    )
    grouped = (
        weekly.groupBy("artist_key")
        .agg(
            F.max("avg_popularity").alias("current_popularity"),
            F.min("avg_popularity").alias("starting_popularity"),
            F.avg("num_songs_chart").alias("avg_songs_in_chart"),
        )
        .withColumn(
            "popularity_growth", F.col("current_popularity") - F.col("starting_popularity")
        )
        .filter(F.col("popularity_growth") > min_growth)
        .join(_artist_names(t), "artist_key")
        .select(
            "artist_name",
            "current_popularity",
            "starting_popularity",
            "popularity_growth",
            "avg_songs_in_chart",
        )
    )
    return top_k(grouped, [down("popularity_growth"), F.asc("artist_name")], n)


def artist_followers(t: Tables, n: int | None = 50) -> DataFrame:
    """Every known artist with a tier by number of songs."""
    measured = (
        _artist_measures(t)
        .groupBy("artist_key")
        .agg(
            F.count_distinct("song_key").alias("num_songs"),
            _n_avg("song_popularity").alias("avg_song_popularity"),
            F.count_distinct("country_key").alias("countries_present"),
        )
    )
    none = F.lit(0).cast("bigint")
    grouped = (
        _artist_names(t)
        .join(measured, "artist_key", "left")
        .select(
            "artist_name",
            F.coalesce("num_songs", none).alias("num_songs"),
            "avg_song_popularity",
            F.coalesce("countries_present", none).alias("countries_present"),
        )
        .withColumn("artist_tier", k.artist_tier(F.col("num_songs")))
    )
    order = [down("num_songs"), down("avg_song_popularity"), F.asc("artist_name")]
    return top_k(grouped, order, n)


# --- countries ----------------------------------------------------------------


def top_songs_by_country(t: Tables, k: int = 1, n: int | None = 50) -> DataFrame:
    """The best ``k`` song names of each country (fan)."""
    rows, keys = rollup(t, "agg_song_month"), ["song_key", "country_key"]
    songs = _dim(t, "dim_song", "song_key", "song_name")
    countries = _dim(t, "dim_country", "country_key", "country_name")
    grouped = (
        summed(rows, keys, ["fan", "fan_popularity_score"])
        .join(songs, "song_key")
        .join(countries, "country_key")
        .groupBy("country_name", "song_name")
        .agg(_fan_avg("popularity_score").alias("avg_popularity"))
    )
    inner = [down("avg_popularity"), F.asc("song_name")]
    order = [F.asc("country_name"), *inner]
    best = top_k(top_k_per(grouped, ["country_name"], inner, k), order, n)
    spread = best.join(songs, "song_name").join(countries, "country_name")
    return _with_artists(best, spread, rows, keys, t, order, n).select(
        "country_name", "song_name", "artist_name", "avg_popularity"
    )


def _country_measures(t: Tables, songs_as: str) -> DataFrame:
    """Distinct songs and artists, and popularity and points, by country (fan)."""
    countries = _dim(t, "dim_country", "country_key", "country_name")
    rows = rollup(t, "agg_song_month").join(countries, "country_key")
    measured = rows.groupBy("country_name").agg(
        F.count_distinct("song_key").alias(songs_as),
        _fan_avg("popularity_score").alias("avg_popularity"),
        F.max("max_popularity_score").alias("max_popularity"),
        _points("fan", "fan_daily_rank").alias("total_rank_points"),
    )
    artists = _distinct_artists(rows, ["country_name"], "unique_artists")
    return measured.join(artists, "country_name", "left").fillna(0, ["unique_artists"])


def popularity_by_country(t: Tables, n: int | None = 15) -> DataFrame:
    grouped = _country_measures(t, "unique_songs").select(
        F.col("country_name").alias("region"),
        "unique_songs",
        "unique_artists",
        "avg_popularity",
        "max_popularity",
    )
    return top_k(grouped, [down("avg_popularity"), F.asc("region")], n)


def biggest_music_markets(t: Tables, n: int | None = 25) -> DataFrame:
    grouped = _country_measures(t, "unique_songs_in_chart").select(
        "country_name",
        "unique_songs_in_chart",
        "unique_artists",
        "avg_popularity",
        "total_rank_points",
    )
    order = [down("unique_songs_in_chart"), down("avg_popularity"), F.asc("country_name")]
    return top_k(grouped, order, n)


def regional_music_preferences(t: Tables, n: int | None = 100) -> DataFrame:
    audio = t["fact_audio_analysis"].select(
        "song_key",
        k.mood_regional(F.col("valence"), F.col("energy")).alias("mood"),
        k.level3(F.col("energy")).alias("energy_level"),
        k.level3(F.col("danceability")).alias("danceability_level"),
    )
    labels = ["mood", "energy_level", "danceability_level"]
    grouped = (
        _songs(t, ["song_key", "country_key"], ["popularity_score"])
        .join(audio, "song_key")
        .groupBy("country_key", *labels)
        .agg(F.sum("n").alias("n"), F.sum("sum_popularity_score").alias("sum_popularity_score"))
        .join(_dim(t, "dim_country", "country_key", "country_name"), "country_key")
        .groupBy(F.col("country_name").alias("region"), *labels)
        .agg(
            F.sum("n").alias("song_count"),
            _n_avg("popularity_score").alias("avg_popularity"),
        )
    )
    return top_k(grouped, [F.asc("region"), down("song_count"), *labels], n)


# --- time ---------------------------------------------------------------------


def popularity_by_weekday(t: Tables) -> DataFrame:
    keys = ["day_of_week", "day_name"]
    per_song_day = rollup(t, "agg_song_day").select(
        "song_key", "date_key", "n", "sum_popularity_score", "sum_daily_rank"
    )
    grouped = (
        per_song_day.join(_dim(t, "dim_date", "date_key", *keys), "date_key")
        .groupBy(*keys)
        .agg(
            F.count_distinct("song_key").alias("num_songs"),
            _n_avg("popularity_score").alias("avg_popularity"),
            _n_avg("daily_rank").alias("avg_rank"),
        )
    )
    return grouped.orderBy("day_of_week")


def popularity_by_month(t: Tables) -> DataFrame:
    """Songs, artists and popularity by calendar month (fan)."""
    keys = ["year", "month", "month_name"]
    day = F.col("snapshot_month")
    rows = rollup(t, "agg_song_month").withColumns(
        {"year": F.year(day), "month": F.month(day), "month_name": F.date_format(day, "MMMM")}
    )
    measured = rows.groupBy(*keys).agg(
        F.count_distinct("song_key").alias("num_songs"),
        _fan_avg("popularity_score").alias("avg_popularity"),
    )
    return (
        measured.join(_distinct_artists(rows, keys, "num_artists"), keys, "left")
        .fillna(0, ["num_artists"])
        .select(*keys, "num_songs", "avg_popularity", "num_artists")
        .orderBy("year", "month")
    )


def _longest(t: Tables, n: int | None, exact: bool) -> DataFrame:
    keys = ["song_name", "country_name"]
    rows = rollup(t, "agg_song_month").filter("number_one_fan > 0")
    songs = _dim(t, "dim_song", "song_key", "song_name")
    countries = _dim(t, "dim_country", "country_key", "country_name")
    firsts = rows.select(
        "song_key",
        "country_key",
        "number_one_fan",
        *([F.explode("number_one_days").alias("day")] if exact else []),
        F.array_min("number_one_days").alias("first_date"),
        F.array_max("number_one_days").alias("last_date"),
    )
    count = F.count_distinct("day") if exact else F.sum("number_one_fan")
    grouped = (
        firsts.join(songs, "song_key")
        .join(countries, "country_key")
        .groupBy(*keys)
        .agg(
            count.alias("days_at_number_one"),
            F.min("first_date").alias("first_date"),
            F.max("last_date").alias("last_date"),
        )
    )
    order = [down("days_at_number_one"), *keys]
    best = top_k(grouped, order, n)
    spread = best.join(songs, "song_name").join(countries, "country_name")
    on = ["song_key", "country_key"]
    named = _with_artists(best, spread, rows, on, t, order, n, "number_one_artists")
    return named.select(
        "song_name",
        "artist_name",
        "country_name",
        "days_at_number_one",
        "first_date",
        "last_date",
    )


def longest_number_one(t: Tables, n: int | None = 20) -> DataFrame:
    """Rows at number one per song name and country (fan: counts joined rows, not days)."""
    return _longest(t, n, exact=False)


def days_at_number_one(t: Tables, n: int | None = 20) -> DataFrame:
    """The same with distinct days."""
    return _longest(t, n, exact=True)


# --- albums -------------------------------------------------------------------


def _albums(t: Tables) -> DataFrame:
    return _dim(t, "dim_album", "album_key", "album_name", "release_year").filter(
        F.col("album_name").isNotNull()
    )


def _album_rows(t: Tables) -> DataFrame:
    return rollup(t, "agg_song_month").filter(F.col("album_key").isNotNull())


def top_albums(t: Tables, n: int | None = 20) -> DataFrame:
    """Albums by name and year with the best average popularity (fan)."""
    keys = ["album_name", "release_year"]
    rows, albums = _album_rows(t), _albums(t)
    sums = ["fan", "fan_popularity_score", "fan_daily_rank"]
    measured = (
        summed(rows, ["album_key", "song_key"], sums)
        .join(albums, "album_key")
        .groupBy(*keys)
        .agg(
            F.count_distinct("song_key").alias("num_songs"),
            _fan_avg("popularity_score").alias("avg_popularity"),
            _points("fan", "fan_daily_rank").alias("total_rank_points"),
        )
    )
    order = [down("avg_popularity"), F.asc("album_name"), F.asc_nulls_last("release_year")]
    best = top_k(measured, order, n)
    same = F.col("_name").eqNullSafe(F.col("album_name")) & F.col("_year").eqNullSafe(
        F.col("release_year")
    )
    spread = best.join(albums.toDF("album_key", "_name", "_year"), same)
    return _with_artists(best, spread, rows, ["album_key"], t, order, n).select(
        "album_name",
        "artist_name",
        "release_year",
        "num_songs",
        "avg_popularity",
        "total_rank_points",
    )


def _album_songs(t: Tables) -> DataFrame:
    return summed(_album_rows(t), ["album_key", "song_key"], ["n", "sum_popularity_score"])


def album_type_analysis(t: Tables) -> DataFrame:
    """Album types by number of songs: averages over albums, not over chart rows."""
    sized = (
        _album_songs(t)
        .join(_albums(t), "album_key")
        .join(_dim(t, "dim_song", "song_key", "duration_ms"), "song_key")
        .withColumn("sum_duration_ms", F.col("duration_ms").cast("bigint") * F.col("n"))
        .groupBy("album_name", "release_year")
        .agg(
            F.count_distinct("song_key").alias("num_songs"),
            _n_avg("popularity_score").alias("avg_popularity"),
            (_n_avg("duration_ms") / 60_000).alias("avg_duration_minutes"),
        )
        .withColumn("album_type", k.album_type(F.col("num_songs")))
    )
    grouped = sized.groupBy("album_type").agg(
        F.count_distinct("album_name").alias("num_albums"),
        F.sum("num_songs").alias("total_songs"),
        F.avg("avg_popularity").alias("avg_popularity"),
        F.avg("avg_duration_minutes").alias("avg_duration_minutes"),
    )
    return grouped.orderBy(down("avg_popularity"), "album_type")


def album_release_trends(t: Tables, from_year: int = 2000) -> DataFrame:
    dated = _dim(t, "dim_album", "album_key", "release_year").filter(
        F.col("release_year") >= from_year
    )
    grouped = (
        _album_songs(t)
        .join(dated, "album_key")
        .groupBy("release_year")
        .agg(
            F.count_distinct("album_key").alias("num_albums"),
            F.count_distinct("song_key").alias("num_songs"),
            _n_avg("popularity_score").alias("avg_popularity"),
        )
    )
    return grouped.orderBy(down("release_year"))


# --- audio features and songs ---------------------------------------------------


def audio_features_popularity(t: Tables, n: int | None = 30) -> DataFrame:
    audio = t["fact_audio_analysis"].select(
        "song_key",
        k.level3(F.col("energy")).alias("energy_level"),
        k.level3(F.col("danceability")).alias("danceability_level"),
        k.level3(F.col("valence")).alias("valence_level"),
        k.level3(F.col("acousticness")).alias("acousticness_level"),
        k.tempo4(F.col("tempo")).alias("tempo_category"),
        k.mood_popularity(F.col("valence"), F.col("energy")).alias("mood"),
    )
    labels = [c for c in audio.columns if c != "song_key"]
    grouped = (
        _songs(t, ["song_key"], ["popularity_score"])
        .join(audio, "song_key")
        .join(_dim(t, "dim_song", "song_key", "duration_ms"), "song_key")
        .withColumn("sum_duration_ms", F.col("duration_ms").cast("bigint") * F.col("n"))
        .groupBy(*labels)
        .agg(
            F.sum("n").alias("song_count"),
            _n_avg("popularity_score").alias("avg_popularity"),
            (_n_avg("duration_ms") / 60_000).alias("avg_duration_minutes"),
        )
    )
    return top_k(grouped, [down("avg_popularity"), *labels], n)


def mood_analysis(t: Tables) -> DataFrame:
    audio = t["fact_audio_analysis"].select(
        "song_key", k.mood_strict(F.col("valence"), F.col("energy")).alias("mood")
    )
    grouped = (
        _songs(t, ["song_key", "country_key"], ["popularity_score", "daily_rank"])
        .join(audio, "song_key")
        .filter(F.col("mood").isNotNull())
        .groupBy("mood")
        .agg(
            F.count_distinct("song_key").alias("num_songs"),
            _n_avg("popularity_score").alias("avg_popularity"),
            _n_avg("daily_rank").alias("avg_rank"),
            F.count_distinct("country_key").alias("num_countries"),
        )
    )
    return grouped.orderBy(down("avg_popularity"), "mood")


def explicit_analysis(t: Tables) -> DataFrame:
    grouped = (
        _songs(t, ["song_key", "country_key"], ["popularity_score", "daily_rank"])
        .join(_dim(t, "dim_song", "song_key", "is_explicit"), "song_key")
        .groupBy("is_explicit")
        .agg(
            F.count_distinct("song_key").alias("num_songs"),
            _n_avg("popularity_score").alias("avg_popularity"),
            _n_avg("daily_rank").alias("avg_rank"),
            F.count_distinct("country_key").alias("num_countries"),
        )
    )
    return grouped.orderBy(down("is_explicit"))


# --- whole warehouse ------------------------------------------------------------


def summary_stats(t: Tables) -> DataFrame:
    """One row over everything (fan)."""
    rows = rollup(t, "agg_song_month")
    countries = (
        rows.select("country_key")
        .distinct()
        .join(_dim(t, "dim_country", "country_key", "country_name"), "country_key")
    )
    return one_row(
        rows.agg(
            F.count_distinct("song_key").alias("total_songs"),
            _fan_avg("popularity_score").alias("avg_popularity"),
            F.max("max_popularity_score").alias("max_popularity"),
        ),
        _distinct_artists(rows, [], "total_artists"),
        countries.agg(F.count_distinct("country_name").alias("total_countries")),
        rows.agg(F.count_distinct("album_key").alias("total_albums")),
    ).select(
        "total_songs",
        "total_artists",
        "total_countries",
        "total_albums",
        "avg_popularity",
        "max_popularity",
    )


def duration_analysis(t: Tables) -> DataFrame:
    songs = _dim(t, "dim_song", "song_key", "duration_ms").filter("duration_ms > 0")
    grouped = (
        _songs(t, ["song_key"], ["popularity_score"])
        .join(songs, "song_key")
        .groupBy(k.duration_category(F.col("duration_ms")).alias("duration_category"))
        .agg(
            F.count(F.lit(1)).alias("num_songs"),
            _n_avg("popularity_score").alias("avg_popularity"),
        )
    )
    return grouped.orderBy(down("avg_popularity"), "duration_category")
