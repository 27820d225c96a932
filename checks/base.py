"""DuckDB side of the checks: the feed and the warehouse tables as SQL over the trade tables.

Surrogate keys are left out: here the natural key stands in each ``*_key``
column. ``sql`` puts the CTEs that a query mentions in front of it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence


def case(rules: Sequence[tuple[str, str]], otherwise: str) -> str:
    whens = " ".join(f"WHEN {test} THEN '{label}'" for test, label in rules)
    return f"CASE {whens} ELSE '{otherwise}' END"


def under(x: str, cuts: Sequence[float], labels: Sequence[str]) -> str:
    return case([(f"{x} < {c}::DOUBLE", lb) for c, lb in zip(cuts, labels)], labels[-1])


def reach(x: str, cuts: Sequence[float], labels: Sequence[str]) -> str:
    return case([(f"{x} >= {c}::DOUBLE", lb) for c, lb in zip(cuts, labels)], labels[-1])


def text(x: str) -> str:
    return rf"NULLIF(TRIM(REGEXP_REPLACE({x}, '\s+', ' ', 'g')), '')"


def number(x: str, lo: float, hi: float, default: object) -> str:
    value = f"TRY_CAST({x} AS DOUBLE)"
    return f"CASE WHEN {value} BETWEEN {lo} AND {hi} THEN {value} ELSE {default} END"


def whole(x: str, lo: float, hi: float, default: object, kind: str = "INTEGER") -> str:
    return f"CAST(TRUNC({number(x, lo, hi, default)}) AS {kind})"


def day(x: str) -> str:
    return (
        f"COALESCE(CAST(TRY_STRPTIME({x}, '%Y-%m-%d') AS DATE), "
        f"CAST(TRY_STRPTIME({x}, '%m/%d/%Y') AS DATE))"
    )


def pct(x: str) -> str:
    return f"CAST(({x}) % 101 // 100 AS VARCHAR) || '.' || LPAD(CAST(({x}) % 101 % 100 AS VARCHAR), 2, '0')"


def wide(x: str) -> str:
    """A stored float32 as double."""
    return f"CAST({x} AS DOUBLE)"


LEVELS = ("Very High", "High", "Medium", "Low", "Very Low")
VALENCES = ("Very Positive", "Positive", "Neutral", "Negative", "Very Negative")
TEMPOS = ("Very Fast", "Fast", "Moderate", "Slow", "Very Slow")


def level5(x: str) -> str:
    return reach(f"COALESCE(NULLIF({x}, 0), 0.5)", (0.8, 0.6, 0.4, 0.2), LEVELS)


def valence5(x: str) -> str:
    return reach(f"COALESCE(NULLIF({x}, 0), 0.5)", (0.8, 0.6, 0.4, 0.2), VALENCES)


def tempo5(x: str) -> str:
    return reach(f"COALESCE(NULLIF({x}, 0), 120)", (140, 120, 90, 60), TEMPOS)


def mood_etl(v: str = "valence", e: str = "energy") -> str:
    return case(
        [
            (f"{v} >= 0.6::DOUBLE AND {e} >= 0.6::DOUBLE", "Happy"),
            (f"{v} >= 0.6::DOUBLE", "Calm"),
            (f"{v} < 0.4::DOUBLE AND {e} >= 0.6::DOUBLE", "Energetic"),
            (f"{v} < 0.4::DOUBLE", "Sad"),
        ],
        "Neutral",
    )


FEATURE_KEY = (
    "energy_level || '|' || danceability_level || '|' || valence_level || '|' || "
    "tempo_category || '|' || acousticness_level"
)
ALBUM_KEY = "album_name || '|' || COALESCE(CAST({d} AS VARCHAR), '')"

CTES = {
    "sold": """
        SELECT l_partkey AS pk, c_nationkey AS nk,
               DATE_DIFF('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 5 * 5 AS dn,
               CAST(SUM(l_quantity) AS BIGINT) AS q
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        GROUP BY ALL""",
    "charted": """
        SELECT sold.*, part.*, cp,
               ROW_NUMBER() OVER (PARTITION BY cp, nk, dn ORDER BY q DESC, pk) AS plain_rk
        FROM sold JOIN part ON pk = p_partkey CROSS JOIN (VALUES (0), (1)) AS copies(cp)""",
    "feed": f"""
        SELECT
          CASE WHEN pk % 101 <> 0 THEN 'T' || pk END AS spotify_id,
          CASE WHEN pk % 103 = 0 THEN ''
               WHEN pk % 17 = 0 THEN '  ' || p_name || '  ' || pk % 400
               ELSE p_name || ' ' || pk % 400 END AS name,
          CASE WHEN pk % 19 = 0 THEN ''
               WHEN pk % 3 = 0 THEN 'A' || pk % 50 || ', A' || pk * 7 % 50
               WHEN pk % 23 = 0 THEN 'A' || pk % 50 || ', '
               ELSE 'A' || pk % 50 END AS artists,
          CASE WHEN (pk + dn) % 97 = 0 THEN NULL
               WHEN (pk + dn) % 98 = 0 THEN 'x'
               ELSE CAST(plain_rk AS VARCHAR) END AS daily_rank,
          CASE WHEN pk % 29 <> 0 THEN CAST((pk * 7 + dn) % 101 - 50 AS VARCHAR) END AS daily_movement,
          CAST((pk * 11 + dn) % 141 - 70 AS VARCHAR) AS weekly_movement,
          CASE WHEN nk = 24 THEN NULL WHEN nk = 23 THEN '' ELSE 'N' || nk END AS country,
          CAST(DATE '1995-01-01' + CAST(dn AS INTEGER) AS VARCHAR) AS snapshot_date,
          CASE WHEN pk % 89 = 0 THEN '999'
               ELSE CAST((p_size * 2 + q + cp) % 101 AS VARCHAR) END AS popularity,
          CASE WHEN pk % 5 = 0 THEN 'True' ELSE 'False' END AS is_explicit,
          CASE WHEN pk % 83 = 0 THEN '-5' ELSE CAST(90000 + pk % 60 * 5000 AS VARCHAR) END AS duration_ms,
          CASE WHEN pk % 31 <> 0 THEN p_brand END AS album_name,
          CASE WHEN pk % 37 = 0 THEN NULL
               WHEN pk % 41 = 0 THEN 'bad'
               WHEN pk % 13 = 0
                 THEN (1 + pk % 12) || '/' || (1 + pk % 28) || '/' || (1998 + pk % 7)
               ELSE (1998 + pk % 7) || '-' || LPAD(CAST(1 + pk % 12 AS VARCHAR), 2, '0') || '-'
                 || LPAD(CAST(1 + pk % 28 AS VARCHAR), 2, '0') END AS album_release_date,
          {pct('pk * 53')} AS danceability,
          CASE WHEN pk % 43 = 0 THEN '-1' ELSE {pct('pk * 37')} END AS energy,
          CAST(pk % 13 AS VARCHAR) AS key,
          CASE WHEN pk % 59 = 0 THEN '5' ELSE CAST(-(pk * 3 % 60) AS VARCHAR) END AS loudness,
          CASE WHEN pk % 71 <> 0 THEN CAST(pk % 2 AS VARCHAR) END AS mode,
          {pct('pk * 11')} AS speechiness,
          {pct('pk * 29')} AS acousticness,
          {pct('pk * 19')} AS instrumentalness,
          {pct('pk * 23')} AS liveness,
          {pct('pk * 71')} AS valence,
          CASE WHEN pk % 61 = 0 THEN '10' ELSE CAST(50 + pk * 13 % 130 AS VARCHAR) END AS tempo,
          CAST(pk % 9 AS VARCHAR) AS time_signature,
          ROW_NUMBER() OVER (ORDER BY cp, dn, nk, plain_rk) AS seq
        FROM charted WHERE cp = 0 OR pk % 53 = 0""",
    "clean_all": f"""
        SELECT seq, NULLIF(spotify_id, '') AS spotify_id, {text('name')} AS name,
          {text('artists')} AS artists,
          {whole('daily_rank', 1, 1e14, 'NULL', 'BIGINT')} AS daily_rank,
          {whole('daily_movement', -1e14, 1e14, 0, 'BIGINT')} AS daily_movement,
          {whole('weekly_movement', -1e14, 1e14, 0, 'BIGINT')} AS weekly_movement,
          {text('country')} AS country, {day('snapshot_date')} AS snapshot_date,
          {whole('popularity', 0, 100, 50)} AS popularity,
          COALESCE(LOWER(is_explicit) IN ('true', '1', 'yes', 't'), FALSE) AS is_explicit,
          {whole('duration_ms', 0, 1e14, 180000, 'BIGINT')} AS duration_ms,
          {text('album_name')} AS album_name, {day('album_release_date')} AS album_release_date,
          {number('danceability', 0, 1, 0.5)} AS danceability,
          {number('energy', 0, 1, 0.5)} AS energy, {whole('key', 0, 11, 0)} AS key,
          {number('loudness', -60, 0, -7)} AS loudness,
          CASE WHEN COALESCE(TRY_CAST(mode AS DOUBLE), 1) >= 0.5 THEN 1 ELSE 0 END AS mode,
          {number('speechiness', 0, 1, 0.05)} AS speechiness,
          {number('acousticness', 0, 1, 0.5)} AS acousticness,
          {number('instrumentalness', 0, 1, 0)} AS instrumentalness,
          {number('liveness', 0, 1, 0.1)} AS liveness, {number('valence', 0, 1, 0.5)} AS valence,
          {number('tempo', 30, 250, 120)} AS tempo,
          {whole('time_signature', 3, 7, 4)} AS time_signature
        FROM feed""",
    "clean": """
        SELECT * FROM clean_all
        WHERE spotify_id IS NOT NULL AND name IS NOT NULL AND snapshot_date IS NOT NULL""",
    "labelled": f"""
        SELECT *, {mood_etl()} AS mood_category, {level5('energy')} AS energy_level,
          {level5('danceability')} AS danceability_level, {valence5('valence')} AS valence_level,
          {tempo5('tempo')} AS tempo_category, {level5('acousticness')} AS acousticness_level
        FROM clean""",
    "keyed": f"""
        SELECT *, spotify_id AS song_key, snapshot_date AS date_key,
          COALESCE(country, 'GLOBAL') AS country_key,
          {ALBUM_KEY.format(d='album_release_date')} AS album_key,
          {FEATURE_KEY} AS features_key, COALESCE(daily_rank, 100) AS rank,
          CAST((101 - COALESCE(daily_rank, 100) + popularity) / 2.0 AS DECIMAL(22,2)) AS idx,
          ABS(daily_movement) + ABS(weekly_movement) AS magnitude
        FROM labelled""",
    "chart_rows": """
        SELECT * FROM keyed
        QUALIFY ROW_NUMBER() OVER (PARTITION BY song_key, date_key, country_key ORDER BY seq) = 1""",
    "name_lists": f"""
        SELECT *, LIST_FILTER(
            LIST_TRANSFORM(STRING_SPLIT(artists, ','), lambda x: {text('x')}),
            lambda x: x IS NOT NULL) AS names
        FROM keyed""",
    "listed": """
        SELECT *, UNNEST(names) AS artist_name, GENERATE_SUBSCRIPTS(names, 1) - 1 AS pos
        FROM name_lists""",
    "dim_song": """
        SELECT spotify_id AS song_key, spotify_id, FIRST(name ORDER BY seq) AS song_name,
          FIRST(duration_ms ORDER BY seq) AS duration_ms,
          FIRST(is_explicit ORDER BY seq) AS is_explicit, MIN(snapshot_date) AS created_at
        FROM clean GROUP BY spotify_id""",
    "dim_artist": """
        SELECT artist_name AS artist_key, artist_name, MIN(snapshot_date) AS created_at
        FROM listed GROUP BY artist_name""",
    "dim_album": f"""
        SELECT {ALBUM_KEY.format(d='album_release_date')} AS album_key, album_name,
          album_release_date AS release_date,
          CAST(YEAR(album_release_date) AS INTEGER) AS release_year,
          CAST(MONTH(album_release_date) AS INTEGER) AS release_month,
          MIN(snapshot_date) AS created_at
        FROM clean WHERE album_name IS NOT NULL GROUP BY album_name, album_release_date""",
    "dim_date": f"""
        SELECT snapshot_date AS date_key, snapshot_date AS full_date,
          CAST(YEAR(snapshot_date) AS INTEGER) AS year,
          CAST(QUARTER(snapshot_date) AS INTEGER) AS quarter,
          CAST(MONTH(snapshot_date) AS INTEGER) AS month,
          MONTHNAME(snapshot_date) AS month_name, CAST(DAY(snapshot_date) AS INTEGER) AS day,
          CAST(ISODOW(snapshot_date) - 1 AS INTEGER) AS day_of_week,
          DAYNAME(snapshot_date) AS day_name,
          CAST(WEEK(snapshot_date) AS INTEGER) AS week_of_year,
          ISODOW(snapshot_date) >= 6 AS is_weekend,
          {case([
              ("MONTH(snapshot_date) IN (12, 1, 2)", "Winter"),
              ("MONTH(snapshot_date) <= 5", "Spring"),
              ("MONTH(snapshot_date) <= 8", "Summer"),
          ], "Fall")} AS season
        FROM (SELECT DISTINCT snapshot_date FROM clean)""",
    "dim_country": """
        SELECT country AS country_key, country AS country_code, country AS country_name
        FROM (SELECT DISTINCT country FROM clean WHERE country IS NOT NULL)
        UNION ALL
        SELECT 'GLOBAL', 'GLOBAL', 'Global'
        WHERE NOT EXISTS (SELECT 1 FROM clean WHERE country = 'GLOBAL')""",
    "dim_audio_features": f"""
        SELECT {FEATURE_KEY} AS features_key, energy_level, danceability_level, valence_level,
          tempo_category, acousticness_level, MIN(snapshot_date) AS created_at
        FROM labelled GROUP BY ALL""",
    "fact_song_daily": """
        SELECT song_key, date_key, country_key, album_key, rank AS daily_rank,
          popularity AS popularity_score, CAST(101 - rank AS DECIMAL(22,2)) AS rank_points,
          idx AS performance_index, snapshot_date
        FROM chart_rows""",
    "fact_artist_stats": """
        SELECT artist_name AS artist_key, song_key, date_key, country_key, rank AS song_rank,
          popularity AS song_popularity, CAST(pos + 1 AS INTEGER) AS artist_position,
          CAST(idx * CASE WHEN pos = 0 THEN 1.0 ELSE 0.7 END AS DECIMAL(22,2)) AS artist_score,
          CAST(CASE WHEN pos = 0 THEN 1.0 ELSE 0.5 END AS DECIMAL(5,2)) AS contribution_weight,
          snapshot_date
        FROM listed
        QUALIFY ROW_NUMBER() OVER (
          PARTITION BY artist_name, song_key, date_key, country_key ORDER BY seq, pos) = 1""",
    "fact_chart_position": """
        SELECT song_key, date_key, country_key, rank AS current_rank,
          CAST(CASE WHEN rank - daily_movement >= 1 THEN rank - daily_movement ELSE 100 END
            AS BIGINT) AS previous_rank,
          daily_movement, weekly_movement,
          daily_movement > 0 OR weekly_movement > 0 AS is_rising,
          daily_movement < 0 OR weekly_movement < 0 AS is_falling,
          CAST(magnitude AS BIGINT) AS movement_magnitude,
          CAST(LEAST(10.0, magnitude / 10.0) AS DECIMAL(8,2)) AS trend_strength, snapshot_date
        FROM chart_rows""",
    "fact_audio_analysis": """
        SELECT song_key, features_key, CAST(danceability AS REAL) AS danceability,
          CAST(energy AS REAL) AS energy, key AS key_signature, CAST(loudness AS REAL) AS loudness,
          mode, CAST(speechiness AS REAL) AS speechiness,
          CAST(acousticness AS REAL) AS acousticness,
          CAST(instrumentalness AS REAL) AS instrumentalness, CAST(liveness AS REAL) AS liveness,
          CAST(valence AS REAL) AS valence, CAST(tempo AS REAL) AS tempo, time_signature,
          CAST((energy + danceability) / 2 AS REAL) AS energy_dance_score,
          CAST(valence * 0.6::DOUBLE + energy * 0.4::DOUBLE AS REAL) AS mood_score,
          snapshot_date AS created_at
        FROM keyed
        QUALIFY ROW_NUMBER() OVER (PARTITION BY song_key ORDER BY seq) = 1""",
    "fact_streaming_metrics": """
        SELECT song_key, date_key, country_key,
          CAST((101 - rank) * 10000 AS BIGINT) AS estimated_streams,
          CAST(GREATEST(0, (101 - rank) * 6000) AS BIGINT) AS estimated_listeners,
          CAST(85 AS DECIMAL(5,2)) AS avg_completion_rate,
          CAST(LEAST(100.0, popularity * 1.2) AS DECIMAL(10,2)) AS engagement_score,
          CAST(LEAST(1.0, magnitude / 100.0) AS DECIMAL(8,2)) AS viral_coefficient, snapshot_date
        FROM chart_rows""",
    # The many-to-many join that the fan queries are defined over.
    "fan": """
        SELECT s.*, a.artist_key, a.artist_name, song_name, country_name
        FROM fact_song_daily s
        LEFT JOIN (
          SELECT song_key, date_key, dim_artist.artist_key, artist_name
          FROM fact_artist_stats JOIN dim_artist USING (artist_key)
        ) a ON s.song_key = a.song_key AND s.date_key = a.date_key
        JOIN dim_song ON dim_song.song_key = s.song_key
        JOIN dim_country ON dim_country.country_key = s.country_key""",
    # Chart rows with their own artists, songs and countries.
    "credits": """
        SELECT song_key, date_key, country_key, snapshot_date, artist_key, artist_name, song_name,
          country_code, country_name, artist_score
        FROM fact_artist_stats
        JOIN dim_artist USING (artist_key)
        JOIN dim_song USING (song_key)
        JOIN dim_country USING (country_key)""",
}


def _mentions(body: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b{name}\b", body)]


_USES = {name: set(_mentions(body)) - {name} for name, body in CTES.items()}


def sql(body: str) -> str:
    """``body`` with the CTEs it needs in front, in order of definition."""
    needed, todo = set(), _mentions(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo.extend(_USES[name])
    if not needed:
        return body.strip()
    order = [name for name in CTES if name in needed]
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"
