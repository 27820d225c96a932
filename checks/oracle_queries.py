"""Oracle SQL for the catalogue, the further analyses and the second-stage results."""

from __future__ import annotations

from checks.base import case, reach, sql, under, wide

L3 = ("Low", "Medium", "High")
CUT3 = (0.3, 0.7)
ENERGY, DANCE, VALENCE, ACOUSTIC, TEMPO = (
    wide(c) for c in ("energy", "danceability", "valence", "acousticness", "tempo")
)


def above(x: str, cut: float) -> str:
    return f"{x} > {cut}::DOUBLE"


def less(x: str, cut: float) -> str:
    return f"{x} < {cut}::DOUBLE"


E6, V6, V4, E4 = above(ENERGY, 0.6), above(VALENCE, 0.6), less(VALENCE, 0.4), less(ENERGY, 0.4)

MUSIC_CATEGORY = case(
    [
        (f"{above(ENERGY, 0.7)} AND {above(DANCE, 0.7)}", "High Energy Dance"),
        (above(ENERGY, 0.7), "High Energy"),
        (above(DANCE, 0.7), "Dance"),
        (above(ACOUSTIC, 0.5), "Acoustic"),
        (V6, "Positive"),
        (V4, "Melancholic"),
    ],
    "Balanced",
)
MOOD_TRENDING = case(
    [(f"{V6} AND {E6}", "Energetic"), (V6, "Happy"), (f"{V4} AND {E4}", "Sad")], "Neutral"
)
MOOD_REGIONAL = case(
    [(f"{V6} AND {E6}", "Happy & Energetic"), (V6, "Happy"), (E6, "Energetic"), (V4, "Melancholic")],
    "Neutral",
)
MOOD_POPULARITY = case(
    [(f"{V6} AND {E6}", "Happy"), (V6, "Calm"), (f"{V4} AND {E6}", "Energetic"), (V4, "Sad")],
    "Neutral",
)
MOOD_STRICT = case(
    [
        (f"{V6} AND {E6}", "Happy"),
        (f"{V6} AND {E4}", "Calm"),
        (f"{V4} AND {E6}", "Energetic"),
        (f"{V4} AND {E4}", "Sad"),
    ],
    "Neutral",
)
TIERS = ("Prolific (50+)", "Active (20-50)", "Regular (10-20)", "Emerging (<10)")
TYPES = ("Full Album (12+)", "EP (6-12)", "Single/Duo (2-5)", "Single (1)")
DURATIONS = (
    "Very Short (<2min)",
    "Short (2-3min)",
    "Medium (3-4min)",
    "Long (4-5min)",
    "Very Long (>5min)",
)
DURATION = under("duration_ms", (120000, 180000, 240000, 300000), DURATIONS)
NAMES = "STRING_AGG(DISTINCT artist_name, ', ' ORDER BY artist_name)"
SCORE = "CAST(SUM(artist_score) AS DOUBLE) / COUNT(*)"
POINTS = "CAST(SUM(rank_points) AS DOUBLE)"
MINUTES = "CAST(SUM(duration_ms) AS DOUBLE) / COUNT(*) / 60000"
AS_OF = "DATE '2001-08-01'"
DAY = "DATE '2001-07-28'"

AUDIO_TRENDING = f"""
    SELECT {under(ENERGY, CUT3, ('Low Energy', 'Medium Energy', 'High Energy'))} AS energy_level,
      {under(DANCE, CUT3, ('Low Dance', 'Medium Dance', 'High Dance'))} AS danceability_level,
      {under(VALENCE, CUT3, ('Sad', 'Neutral', 'Happy'))} AS valence_level,
      {MOOD_TRENDING} AS mood, COUNT(*) AS song_count, AVG(popularity_score) AS avg_popularity
    FROM fact_song_daily JOIN fact_audio_analysis USING (song_key)
    WHERE popularity_score >= 70 GROUP BY 1, 2, 3, 4
    ORDER BY song_count DESC, energy_level, danceability_level, valence_level, mood LIMIT 20"""
REGIONAL = f"""
    SELECT country_name AS region, {MOOD_REGIONAL} AS mood,
      {under(ENERGY, CUT3, L3)} AS energy_level, {under(DANCE, CUT3, L3)} AS danceability_level,
      COUNT(*) AS song_count, AVG(popularity_score) AS avg_popularity
    FROM fact_song_daily JOIN fact_audio_analysis USING (song_key)
    JOIN dim_country USING (country_key) GROUP BY 1, 2, 3, 4
    ORDER BY region, song_count DESC, mood, energy_level, danceability_level LIMIT 100"""
FEATURE_POPULARITY = f"""
    SELECT {under(ENERGY, CUT3, L3)} AS energy_level,
      {under(DANCE, CUT3, L3)} AS danceability_level, {under(VALENCE, CUT3, L3)} AS valence_level,
      {under(ACOUSTIC, CUT3, L3)} AS acousticness_level,
      {under(TEMPO, (90, 120, 150), ('Slow', 'Medium', 'Fast', 'Very Fast'))} AS tempo_category,
      {MOOD_POPULARITY} AS mood, COUNT(*) AS song_count,
      AVG(popularity_score) AS avg_popularity, {MINUTES} AS avg_duration_minutes
    FROM fact_song_daily JOIN fact_audio_analysis USING (song_key) JOIN dim_song USING (song_key)
    GROUP BY 1, 2, 3, 4, 5, 6
    ORDER BY avg_popularity DESC, energy_level, danceability_level, valence_level,
      acousticness_level, tempo_category, mood LIMIT 30"""
FOLLOWERS = f"""
    SELECT artist_name, COUNT(DISTINCT song_key) AS num_songs,
      AVG(song_popularity) AS avg_song_popularity,
      COUNT(DISTINCT country_key) AS countries_present,
      {reach('COUNT(DISTINCT song_key)', (50, 20, 10), TIERS)} AS artist_tier
    FROM dim_artist LEFT JOIN fact_artist_stats USING (artist_key) GROUP BY artist_name
    ORDER BY num_songs DESC, avg_song_popularity DESC NULLS FIRST, artist_name LIMIT 50"""
TOP_SONGS = f"""
    SELECT song_name, {NAMES} AS artist_name, COUNT(DISTINCT country_name) AS num_countries,
      AVG(popularity_score) AS avg_popularity, AVG(daily_rank) AS avg_rank,
      MAX(popularity_score) AS max_popularity
    FROM fan GROUP BY song_name
    ORDER BY avg_popularity DESC, num_countries DESC, song_name LIMIT 20"""
GENRES = f"""
    SELECT {MUSIC_CATEGORY} AS music_category, COUNT(DISTINCT song_key) AS num_songs,
      AVG(popularity_score) AS avg_popularity, AVG(daily_rank) AS avg_rank,
      {POINTS} AS total_rank_points
    FROM fact_song_daily JOIN fact_audio_analysis USING (song_key) GROUP BY 1
    ORDER BY avg_popularity DESC, music_category LIMIT 15"""
TOP_ARTISTS = f"""
    SELECT artist_name, COUNT(DISTINCT song_key) AS total_songs,
      COUNT(DISTINCT country_key) AS countries_present, {SCORE} AS avg_artist_score,
      AVG(song_popularity) AS avg_popularity
    FROM fact_artist_stats JOIN dim_artist USING (artist_key) GROUP BY artist_name
    ORDER BY avg_artist_score DESC, countries_present DESC, artist_name LIMIT 20"""
REACH = """
    SELECT artist_name, COUNT(DISTINCT country_name) AS num_countries,
      COUNT(DISTINCT song_key) AS num_songs, AVG(song_popularity) AS avg_popularity
    FROM fact_artist_stats JOIN dim_artist USING (artist_key) JOIN dim_country USING (country_key)
    GROUP BY artist_name HAVING COUNT(DISTINCT country_name) >= 5
    ORDER BY num_countries DESC, avg_popularity DESC, artist_name LIMIT 20"""
TRENDING_ARTISTS = f"""
    SELECT artist_name, MAX(p) AS current_popularity, MIN(p) AS starting_popularity,
      MAX(p) - MIN(p) AS popularity_growth, AVG(songs) AS avg_songs_in_chart
    FROM (
      SELECT artist_name, week_of_year, year, AVG(song_popularity) AS p,
        COUNT(DISTINCT song_key) AS songs
      FROM fact_artist_stats JOIN dim_artist USING (artist_key) JOIN dim_date USING (date_key)
      WHERE full_date >= {AS_OF} - 60 GROUP BY ALL)
    GROUP BY artist_name HAVING MAX(p) - MIN(p) > 5
    ORDER BY popularity_growth DESC, artist_name LIMIT 20"""
LONGEST = f"""
    SELECT song_name, {NAMES} AS artist_name, country_name, COUNT(*) AS days_at_number_one,
      MIN(snapshot_date) AS first_date, MAX(snapshot_date) AS last_date
    FROM fan WHERE daily_rank = 1 GROUP BY song_name, country_name
    ORDER BY days_at_number_one DESC, song_name, country_name LIMIT 20"""
ALBUMS = f"""
    SELECT album_name, {NAMES} AS artist_name, release_year, COUNT(DISTINCT song_key) AS num_songs,
      AVG(popularity_score) AS avg_popularity, {POINTS} AS total_rank_points
    FROM fan JOIN dim_album USING (album_key) GROUP BY album_name, release_year
    ORDER BY avg_popularity DESC, album_name, release_year LIMIT 20"""
EXPLICIT = """
    SELECT is_explicit, COUNT(DISTINCT song_key) AS num_songs,
      AVG(popularity_score) AS avg_popularity, AVG(daily_rank) AS avg_rank,
      COUNT(DISTINCT country_key) AS num_countries
    FROM fact_song_daily JOIN dim_song USING (song_key) GROUP BY is_explicit"""
SUMMARY = """
    SELECT COUNT(DISTINCT song_key) AS total_songs, COUNT(DISTINCT artist_key) AS total_artists,
      COUNT(DISTINCT country_name) AS total_countries, COUNT(DISTINCT album_key) AS total_albums,
      AVG(popularity_score) AS avg_popularity, MAX(popularity_score) AS max_popularity
    FROM fan"""

CATALOGUE = {
    "q01_top_songs_global": TOP_SONGS,
    "q02_trending_songs": f"""
        SELECT *, LAG(avg_rank) OVER w AS prev_rank, avg_rank - LAG(avg_rank) OVER w AS rank_change
        FROM (
          SELECT song_name, {NAMES} AS artist_name, snapshot_date AS date,
            AVG(daily_rank) AS avg_rank, AVG(popularity_score) AS avg_popularity
          FROM fan WHERE snapshot_date >= {AS_OF} - 30 GROUP BY song_name, snapshot_date)
        WINDOW w AS (PARTITION BY song_name ORDER BY date)
        ORDER BY date DESC, avg_popularity DESC, song_name LIMIT 50""",
    "q03_genre_trends": GENRES,
    "q04_audio_features_trending": AUDIO_TRENDING,
    "q05_top_artists": TOP_ARTISTS,
    "q06_artists_global_reach": REACH,
    "q07_trending_artists": TRENDING_ARTISTS,
    "q08_artist_followers": FOLLOWERS,
    "q09_top_songs_by_country": f"""
        SELECT country_name, song_name, artist_name, avg_popularity
        FROM (
          SELECT country_name, song_name, {NAMES} AS artist_name,
            AVG(popularity_score) AS avg_popularity
          FROM fan GROUP BY country_name, song_name)
        QUALIFY ROW_NUMBER() OVER (
          PARTITION BY country_name ORDER BY avg_popularity DESC, song_name) = 1
        ORDER BY country_name LIMIT 50""",
    "q10_popularity_by_country": """
        SELECT country_name AS region, COUNT(DISTINCT song_key) AS unique_songs,
          COUNT(DISTINCT artist_key) AS unique_artists, AVG(popularity_score) AS avg_popularity,
          MAX(popularity_score) AS max_popularity
        FROM fan GROUP BY country_name ORDER BY avg_popularity DESC, region LIMIT 15""",
    "q11_biggest_music_markets": f"""
        SELECT country_name, COUNT(DISTINCT song_key) AS unique_songs_in_chart,
          COUNT(DISTINCT artist_key) AS unique_artists, AVG(popularity_score) AS avg_popularity,
          {POINTS} AS total_rank_points
        FROM fan GROUP BY country_name
        ORDER BY unique_songs_in_chart DESC, avg_popularity DESC, country_name LIMIT 25""",
    "q12_regional_music_preferences": REGIONAL,
    "q13_popularity_by_weekday": """
        SELECT day_of_week, day_name, COUNT(DISTINCT song_key) AS num_songs,
          AVG(popularity_score) AS avg_popularity, AVG(daily_rank) AS avg_rank
        FROM fact_song_daily JOIN dim_date USING (date_key) GROUP BY day_of_week, day_name""",
    "q14_popularity_by_month": """
        SELECT year, month, month_name, COUNT(DISTINCT song_key) AS num_songs,
          AVG(popularity_score) AS avg_popularity, COUNT(DISTINCT artist_key) AS num_artists
        FROM fan JOIN dim_date USING (date_key) GROUP BY year, month, month_name""",
    "q15_longest_number_one": LONGEST,
    "q15x_days_at_number_one": LONGEST.replace("COUNT(*)", "COUNT(DISTINCT snapshot_date)"),
    "q16_top_albums": ALBUMS,
    "q17_album_type_analysis": f"""
        SELECT {reach('num_songs', (12, 6, 2), TYPES)} AS album_type,
          COUNT(DISTINCT album_name) AS num_albums, CAST(SUM(num_songs) AS BIGINT) AS total_songs,
          ROUND(AVG(p), 6) AS avg_popularity, ROUND(AVG(minutes), 6) AS avg_duration_minutes
        FROM (
          SELECT album_name, release_year, COUNT(DISTINCT song_key) AS num_songs,
            AVG(popularity_score) AS p, {MINUTES} AS minutes
          FROM fact_song_daily JOIN dim_album USING (album_key) JOIN dim_song USING (song_key)
          GROUP BY album_name, release_year)
        GROUP BY 1""",
    "q18_album_release_trends": """
        SELECT release_year, COUNT(DISTINCT album_key) AS num_albums,
          COUNT(DISTINCT song_key) AS num_songs, AVG(popularity_score) AS avg_popularity
        FROM fact_song_daily JOIN dim_album USING (album_key)
        WHERE release_year >= 2000 GROUP BY release_year""",
    "q19_audio_features_popularity": FEATURE_POPULARITY,
    "q20_mood_analysis": f"""
        SELECT {MOOD_STRICT} AS mood, COUNT(DISTINCT song_key) AS num_songs,
          AVG(popularity_score) AS avg_popularity, AVG(daily_rank) AS avg_rank,
          COUNT(DISTINCT country_key) AS num_countries
        FROM fact_song_daily JOIN fact_audio_analysis USING (song_key) GROUP BY 1""",
    "q21_explicit_analysis": EXPLICIT,
    "q22_summary_stats": SUMMARY,
    "q23_duration_analysis": f"""
        SELECT {DURATION} AS duration_category, COUNT(DISTINCT song_key) AS num_songs,
          AVG(popularity_score) AS avg_popularity
        FROM fact_song_daily JOIN dim_song USING (song_key) WHERE duration_ms > 0 GROUP BY 1""",
}

LIVELY = (
    f"{above(wide('f.energy'), 0.8)} AND {above(wide('f.danceability'), 0.7)} "
    f"AND {wide('f.tempo')} > "
)
GRAIN = "USING (song_key, date_key, country_key)"
FEATURES = (
    f"{wide('f.energy')} AS energy, {wide('f.danceability')} AS danceability, "
    f"{wide('f.tempo')} AS tempo"
)

ANALYSES = {
    "r01_top_songs_in_country": f"""
        SELECT song_name, artist_name, c.snapshot_date, daily_rank, popularity_score,
          CAST(rank_points AS DOUBLE) AS rank_points
        FROM fact_song_daily s JOIN credits c {GRAIN}
        WHERE country_code = 'N5' AND c.snapshot_date >= {AS_OF} - 7
        ORDER BY rank_points DESC, song_name, artist_name, c.snapshot_date, daily_rank,
          popularity_score LIMIT 10""",
    "r02_hottest_artists": f"""
        SELECT artist_name, COUNT(DISTINCT song_key) AS num_songs, {SCORE} AS avg_score
        FROM credits WHERE snapshot_date >= {AS_OF} - 30 GROUP BY artist_name
        ORDER BY avg_score DESC, artist_name LIMIT 5""",
    "r03_viral_songs": f"""
        SELECT song_name, artist_name, country_code, current_rank, daily_movement,
          CAST(trend_strength AS DOUBLE) AS trend_strength
        FROM fact_chart_position p JOIN credits c {GRAIN}
        WHERE is_rising AND trend_strength > 5 AND c.snapshot_date = {DAY}""",
    "r04_workout_playlist": f"""
        SELECT song_name, artist_name, {FEATURES}
        FROM fact_audio_analysis f
        JOIN (SELECT DISTINCT song_key, song_name, artist_name FROM credits) c USING (song_key)
        WHERE {LIVELY} 120
        ORDER BY energy DESC, tempo DESC, song_name, artist_name, danceability LIMIT 50""",
    "r05_top_earners": f"""
        SELECT song_name, artist_name, CAST(SUM(estimated_streams) AS BIGINT) AS total_streams,
          COUNT(DISTINCT country_key) AS countries
        FROM fact_streaming_metrics m JOIN credits c {GRAIN}
        WHERE c.snapshot_date >= {AS_OF} - 90 GROUP BY song_name, artist_name
        ORDER BY total_streams DESC, song_name, artist_name LIMIT 20""",
    "r06_promotion_candidates": f"""
        SELECT song_name, artist_name, CAST(trend_strength AS DOUBLE) AS trend_strength,
          {wide('f.energy')} AS energy, CAST(engagement_score AS DOUBLE) AS engagement_score,
          COUNT(*) AS countries_trending
        FROM fact_chart_position p
        JOIN fact_streaming_metrics m {GRAIN}
        JOIN credits c {GRAIN}
        JOIN fact_audio_analysis f USING (song_key)
        WHERE is_rising AND trend_strength > 7 AND engagement_score > 80
          AND c.snapshot_date = {DAY}
        GROUP BY 1, 2, 3, 4, 5
        ORDER BY 3 DESC, 1, 2, 4, 5 LIMIT 10""",
    "r07_playlist_of_day": f"""
        SELECT song_name, artist_name, country_code, {FEATURES}, popularity_score
        FROM fact_song_daily s JOIN credits c {GRAIN} JOIN fact_audio_analysis f USING (song_key)
        WHERE {LIVELY} 130 AND c.snapshot_date = {DAY}
        ORDER BY energy DESC, tempo DESC, song_name, artist_name, country_code,
          popularity_score, danceability LIMIT 50""",
    "r08_top_ranks_in_countries": f"""
        SELECT country_code, country_name, song_name, artist_name, daily_rank, popularity_score
        FROM fact_song_daily s JOIN credits c {GRAIN}
        WHERE daily_rank <= 10 AND c.snapshot_date = {DAY}
          AND country_code IN ('N1', 'N2', 'N5', 'N9', 'GLOBAL')""",
    "r09_artist_growth": f"""
        SELECT artist_name, month, num_songs, avg_score,
          avg_score - LAG(avg_score) OVER (PARTITION BY artist_name ORDER BY month) AS growth
        FROM (
          SELECT artist_name, month, COUNT(DISTINCT song_key) AS num_songs, {SCORE} AS avg_score
          FROM credits JOIN dim_date USING (date_key) WHERE year = 2000
          GROUP BY artist_name, month)""",
    "r10_song_listing": f"""
        SELECT song_name, artist_name, country_code, c.snapshot_date, daily_rank
        FROM fact_song_daily s JOIN credits c {GRAIN}
        ORDER BY daily_rank, c.snapshot_date DESC, song_name, artist_name, country_code LIMIT 10""",
}


def _whole(query: str) -> str:
    """The query without its limit."""
    return query.rsplit("LIMIT", 1)[0]


def _second(level: str, source: str = FEATURE_POPULARITY) -> str:
    return f"""
        SELECT {level}, ROUND(AVG(avg_popularity), 6) AS avg_popularity,
          CAST(SUM(song_count) AS BIGINT) AS song_count
        FROM ({source}) GROUP BY {level}"""


def _first(query: str, n: int) -> str:
    return f"SELECT * FROM ({_whole(query)} LIMIT {n})"


SUMMARIES = {
    "g1_mood_distribution": f"""
        SELECT mood, CAST(SUM(song_count) AS BIGINT) AS song_count
        FROM ({AUDIO_TRENDING}) GROUP BY mood""",
    "g2_energy_dance_matrix": f"""
        SELECT energy_level, danceability_level, CAST(SUM(song_count) AS BIGINT) AS song_count
        FROM ({AUDIO_TRENDING}) GROUP BY energy_level, danceability_level""",
    "g3_artist_tier_sizes": f"""
        SELECT artist_tier, COUNT(*) AS count FROM ({FOLLOWERS}) GROUP BY artist_tier""",
    "g1_mood_distribution_all": f"""
        SELECT mood, CAST(SUM(song_count) AS BIGINT) AS song_count
        FROM ({_whole(AUDIO_TRENDING)}) GROUP BY mood""",
    "g2_energy_dance_matrix_all": f"""
        SELECT energy_level, danceability_level, CAST(SUM(song_count) AS BIGINT) AS song_count
        FROM ({_whole(AUDIO_TRENDING)}) GROUP BY energy_level, danceability_level""",
    "g3_artist_tier_sizes_all": f"""
        SELECT artist_tier, COUNT(*) AS count FROM ({_whole(FOLLOWERS)}) GROUP BY artist_tier""",
    "g5_popularity_by_energy_all": _second("energy_level", _whole(FEATURE_POPULARITY)),
    "g6_popularity_by_danceability_all": _second("danceability_level", _whole(FEATURE_POPULARITY)),
    "g4_regional_moods": f"""
        WITH regional AS ({REGIONAL}),
        best AS (SELECT region FROM regional GROUP BY region
                 ORDER BY SUM(song_count) DESC, region LIMIT 10)
        SELECT region, mood, CAST(SUM(song_count) AS BIGINT) AS song_count
        FROM regional WHERE region IN (SELECT region FROM best) GROUP BY region, mood""",
    "g4_regional_moods_all": f"""
        WITH regional AS ({_whole(REGIONAL)}),
        best AS (SELECT region FROM regional GROUP BY region
                 ORDER BY SUM(song_count) DESC, region LIMIT 10)
        SELECT region, mood, CAST(SUM(song_count) AS BIGINT) AS song_count
        FROM regional WHERE region IN (SELECT region FROM best) GROUP BY region, mood""",
    "g5_popularity_by_energy": _second("energy_level"),
    "g6_popularity_by_danceability": _second("danceability_level"),
    "g7_explicit_types": f"""
        SELECT *, CASE WHEN is_explicit THEN 'Explicit' ELSE 'Non-Explicit' END AS type
        FROM ({EXPLICIT})""",
    "g8_headline_numbers": f"""
        SELECT total_songs, total_artists, total_countries, total_albums,
          COALESCE(avg_popularity, 0) AS avg_popularity,
          CAST(COALESCE(max_popularity, 0) AS DOUBLE) AS max_popularity
        FROM ({SUMMARY})""",
    "g9_shown_top_songs_global": _first(TOP_SONGS, 15),
    "g9_shown_genre_trends": _first(GENRES, 10),
    "g9_shown_top_artists": _first(TOP_ARTISTS, 15),
    "g9_shown_artists_global_reach": _first(REACH, 15),
    "g9_shown_trending_artists": _first(TRENDING_ARTISTS, 15),
    "g9_shown_artist_followers": _first(FOLLOWERS, 15),
    "g9_shown_longest_number_one": _first(LONGEST, 15),
    "g9_shown_top_albums": _first(ALBUMS, 15),
}

ORACLE = {key: sql(body) for key, body in {**CATALOGUE, **ANALYSES, **SUMMARIES}.items()}
