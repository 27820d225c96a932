"""Keys for sources, cleaning, labels, dimensions and facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chartmart.functions import classify as k
from chartmart.functions import clean as c
from chartmart.functions.keys import with_key
from chartmart.operators.append import append_new
from chartmart.plans import dims, facts, rejects
from chartmart.plans.registry import run
from chartmart.plans.transform import (
    FEED_RULES,
    Number,
    clean_feed,
    clean_rows,
    dedupe_feed,
    drop_incomplete,
    label_feed,
    transform,
)
from chartmart.plans.warehouse import write_warehouse
from chartmart.sources.feed import FEED_COLUMNS, read_feed, stream_feed
from chartmart.sources.tables import (
    SCHEMAS,
    export_csv,
    materialise,
    read_table,
    table_counts,
)
from checks import oracle_queries as oq
from checks.base import day, number, text, under, wide
from checks.files import fresh_dir, write_feed_csv
from checks.pairs import Pairs
from checks.warehouse import warehouse

CHECKS = Pairs()
CUT = dt.date(1998, 1, 1)
OVERLAP = dt.date(1997, 1, 1)


def counted(df, **cols):
    return df.groupBy(*[col.alias(name) for name, col in cols.items()]).agg(
        F.count(F.lit(1)).alias("n")
    )


def natural(fact, t):
    """A fact with natural keys in place of surrogate ones."""
    out = fact
    for key, dim, name in (
        ("song_key", "dim_song", "spotify_id"),
        ("country_key", "dim_country", "country_code"),
        ("artist_key", "dim_artist", "artist_name"),
    ):
        if key in out.columns:
            out = out.join(t[dim].select(key, name), key).drop(key)
    if "album_key" in out.columns:
        albums = t["dim_album"].select("album_key", "album_name", "release_date")
        out = out.join(albums, "album_key", "left").drop("album_key")
    return out.drop("date_key", "snapshot_month")


# --- sources and sinks ----------------------------------------------------------

_FEED_TEXT = ", ".join(f"NULLIF({col}, '') AS {col}" for col in FEED_COLUMNS)


@CHECKS.on_folder("s1_csv_scan", f"SELECT {_FEED_TEXT} FROM feed")
def csv_scan(spark, sf_dir):
    path = fresh_dir(spark, sf_dir, "csv")
    write_feed_csv(warehouse(spark, sf_dir)["feed"], path)
    return read_feed(spark, path).drop("_seq")


@CHECKS.on_folder("s2_chunked_scan", f"SELECT {_FEED_TEXT} FROM feed")
def chunked_scan(spark, sf_dir):
    path = fresh_dir(spark, sf_dir, "chunks")
    write_feed_csv(warehouse(spark, sf_dir)["feed"], f"{path}/in")
    stream = stream_feed(spark, f"{path}/in", [*FEED_COLUMNS, "seq"], max_files=4).drop("_place")
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/ckpt")
        .trigger(availableNow=True)
        .start(f"{path}/out")
        .awaitTermination()
    )
    return spark.read.parquet(f"{path}/out")


@CHECKS.on_tables(
    "s3_append_dimension",
    f"""SELECT album_name, release_date,
          CASE WHEN MIN(created_at) < DATE '{CUT}' THEN 1 ELSE 2 END AS batch
        FROM dim_album GROUP BY album_name, release_date""",
)
def append_dimension(t):
    early = dims.dim_album(t["clean"].filter(F.col("snapshot_date") < F.lit(CUT)))
    late = dims.dim_album(t["clean"].filter(F.col("snapshot_date") >= F.lit(OVERLAP)))
    keys = ["album_name", "release_date"]
    new = append_new(early, late, keys, null_safe=True)
    return early.select(*keys, F.lit(1).alias("batch")).unionByName(
        new.select(*keys, F.lit(2).alias("batch"))
    )


@CHECKS.on_tables(
    "s4_append_fact",
    f"""SELECT spotify_id, snapshot_date, country_key AS country_code, daily_rank,
          popularity_score, CASE WHEN snapshot_date < DATE '{CUT}' THEN 1 ELSE 2 END AS batch
        FROM fact_song_daily JOIN dim_song USING (song_key)""",
)
def append_fact(t):
    def built(rows):
        return facts.fact_song_daily(facts.resolve_keys(rows))

    early = built(t["clean"].filter(F.col("snapshot_date") < F.lit(CUT)))
    late = built(t["clean"].filter(F.col("snapshot_date") >= F.lit(OVERLAP)))
    new = append_new(early, late, list(facts.GRAIN))
    both = early.withColumn("batch", F.lit(1)).unionByName(new.withColumn("batch", F.lit(2)))
    return natural(both, t).select(
        "spotify_id", "snapshot_date", "country_code", "daily_rank", "popularity_score", "batch"
    )


_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {name}" for name in SCHEMAS
)


@CHECKS.on_folder("s5_full_rebuild", _COUNTS)
def full_rebuild(spark, sf_dir):
    path = fresh_dir(spark, sf_dir, "rebuild")
    written = write_warehouse(warehouse(spark, sf_dir)["feed"], path)
    return table_counts({name: written[name] for name in SCHEMAS})


@CHECKS.on_folder(
    "s6_read_table",
    """SELECT album_name, release_date, COUNT(*) AS chart_rows
       FROM fact_song_daily JOIN dim_album USING (album_key) GROUP BY ALL""",
)
def read_back(spark, sf_dir):
    t = warehouse(spark, sf_dir)
    path = t.path_of("dim_album", "fact_song_daily")
    albums = read_table(spark, path, "dim_album").select("album_key", "album_name", "release_date")
    rows = read_table(spark, path, "fact_song_daily").groupBy("album_key").count()
    return rows.join(albums, "album_key").select(
        "album_name", "release_date", F.col("count").alias("chart_rows")
    )


@CHECKS.on_tables("s7_table_counts", _COUNTS)
def counts(t):
    return table_counts(t)


@CHECKS.on_tables("s8_run_by_name", oq.CATALOGUE["q10_popularity_by_country"])
def by_name(t):
    return run("popularity_by_continent", t, n=15)


@CHECKS.on_folder("s9_export_csv", oq.CATALOGUE["q13_popularity_by_weekday"])
def exported(spark, sf_dir):
    path = fresh_dir(spark, sf_dir, "export")
    result = run("popularity_by_weekday", warehouse(spark, sf_dir))
    export_csv(result, path)
    return spark.read.schema(result.schema).option("header", "true").csv(path)


@CHECKS.on_folder("s10_reused_result", oq.CATALOGUE["q03_genre_trends"])
def reused(spark, sf_dir):
    path = fresh_dir(spark, sf_dir, "result")
    return materialise(run("genre_trends", warehouse(spark, sf_dir)), path)


# --- cleaning -------------------------------------------------------------------


def _grouped(cols: str, source: str) -> str:
    return f"SELECT {cols}, COUNT(*) AS n FROM {source} GROUP BY ALL"


@CHECKS.on_tables("c1_clean_text", _grouped(f"{text('name')} AS name", "feed"))
def c1(t):
    return counted(t["feed"], name=c.clean_text(F.col("name")))


@CHECKS.on_tables(
    "c2_clean_numeric",
    _grouped(
        f"{number('daily_rank', 1, 1e8, 'NULL')} AS daily_rank, "
        f"{number('popularity', 0, 100, 50)} AS popularity, "
        f"{number('energy', 0, 1, 0.5)} AS energy",
        "feed",
    ),
)
def c2(t):
    return counted(
        t["feed"],
        daily_rank=c.clean_numeric(F.col("daily_rank"), 1),
        popularity=c.clean_numeric(F.col("popularity"), 0, 100, 50),
        energy=c.clean_numeric(F.col("energy"), 0, 1, 0.5),
    )


@CHECKS.on_tables(
    "c3_clean_boolean",
    _grouped(
        "COALESCE(LOWER(is_explicit) IN ('true', '1', 'yes', 't'), FALSE) AS is_explicit", "feed"
    ),
)
def c3(t):
    return counted(t["feed"], is_explicit=c.clean_boolean(F.col("is_explicit")))


@CHECKS.on_tables("c4_clean_date", _grouped(f"{day('album_release_date')} AS released", "feed"))
def c4(t):
    return counted(t["feed"], released=c.clean_date(F.col("album_release_date")))


@CHECKS.on_tables(
    "c5_split_artists",
    "SELECT artist_name, CAST(pos AS INTEGER) AS pos, COUNT(*) AS n FROM listed GROUP BY ALL",
)
def c5(t):
    listed = t["clean"].select(
        F.posexplode(c.split_artists(F.col("artists"))).alias("pos", "artist_name")
    )
    return counted(listed, artist_name=F.col("artist_name"), pos=F.col("pos"))


@CHECKS.on_tables(
    "c6_clean_country", _grouped(f"COALESCE({text('country')}, 'GLOBAL') AS country", "feed")
)
def c6(t):
    return counted(t["feed"], country=c.clean_country(F.col("country")))


@CHECKS.on_tables(
    "c7_clean_mode",
    _grouped(
        "CASE WHEN COALESCE(TRY_CAST(mode AS DOUBLE), 1) >= 0.5 THEN 1 ELSE 0 END AS mode", "feed"
    ),
)
def c7(t):
    return counted(t["feed"], mode=c.clean_mode(F.col("mode")))


_CLEAN_COLUMNS = ", ".join(FEED_COLUMNS)


@CHECKS.on_tables("c8_clean_feed", f"SELECT {_CLEAN_COLUMNS} FROM clean_all")
def c8(t):
    return clean_feed(t["feed"], FEED_RULES).drop("_seq")


_RANGES = {
    n: (rule.lo, rule.hi) for n, rule in FEED_RULES.items() if isinstance(rule, Number)
}
_UNUSED = {
    **{
        n: f"TRIM({n}) <> '' AND NOT COALESCE(TRY_CAST({n} AS DOUBLE) BETWEEN {lo} AND {hi}, FALSE)"
        for n, (lo, hi) in _RANGES.items()
    },
    "snapshot_date": f"{day('snapshot_date')} IS NULL",
    "album_release_date": f"TRIM(album_release_date) <> '' AND {day('album_release_date')} IS NULL",
    "spotify_id": "COALESCE(spotify_id, '') = ''",
    "name": f"{text('name')} IS NULL",
}


@CHECKS.on_tables(
    "c9_rejects_by_column",
    " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, COUNT(*) AS n FROM feed WHERE {test} HAVING COUNT(*) > 0"
        for n, test in _UNUSED.items()
    ),
)
def rejects_by_column(t):
    reasons = rejects.quarantine(rejects.judged(t["feed"])).select(F.explode("reasons").alias("r"))
    return counted(reasons, column_name=F.split_part("r", F.lit(":"), F.lit(1)))


@CHECKS.on_tables("c9_drop_incomplete", _grouped("snapshot_date", "clean"))
def c9(t):
    return counted(drop_incomplete(clean_feed(t["feed"])), snapshot_date=F.col("snapshot_date"))


_DEDUPED = """FROM labelled QUALIFY ROW_NUMBER() OVER (
    PARTITION BY spotify_id, artists, snapshot_date, country ORDER BY seq) = 1"""


@CHECKS.on_tables(
    "c10_dedupe_feed", f"SELECT spotify_id, artists, snapshot_date, country, popularity {_DEDUPED}"
)
def c10(t):
    return dedupe_feed(clean_rows(t["feed"])).select(
        "spotify_id", "artists", "snapshot_date", "country", "popularity"
    )


@CHECKS.on_tables(
    "c11_transform",
    f"""SELECT {_CLEAN_COLUMNS}, mood_category, energy_level, danceability_level, valence_level,
          tempo_category, acousticness_level {_DEDUPED}""",
)
def c11(t):
    return transform(t["feed"]).select(*FEED_COLUMNS, "mood_category", "feature_labels.*")


# --- labels ---------------------------------------------------------------------


def _load_label(key: str, label: str, build) -> None:
    @CHECKS.on_tables(key, _grouped(label, "labelled"))
    def _(t):
        return counted(t["clean"], **{label: build()})


_load_label("k1_mood_etl", "mood_category", lambda: k.mood_etl(F.col("valence"), F.col("energy")))
_load_label("k2_energy_level", "energy_level", lambda: k.level5(F.col("energy")))
_load_label("k3_danceability_level", "danceability_level", lambda: k.level5(F.col("danceability")))
_load_label("k4_valence_level", "valence_level", lambda: k.valence5(F.col("valence")))
_load_label("k5_tempo_category", "tempo_category", lambda: k.tempo5(F.col("tempo")))
_load_label("k6_acousticness_level", "acousticness_level", lambda: k.level5(F.col("acousticness")))


@CHECKS.on_tables(
    "k7_feature_labels",
    _grouped(
        "energy_level, danceability_level, valence_level, tempo_category, acousticness_level",
        "labelled",
    ),
)
def k7(t):
    labels = label_feed(t["clean"]).select("feature_labels.*")
    return labels.groupBy(*labels.columns).agg(F.count(F.lit(1)).alias("n"))


def _query_label(key: str, labels: dict[str, tuple[str, object]], source: str, table: str) -> None:
    columns = ", ".join(f"{expr} AS {name}" for name, (expr, _) in labels.items())

    @CHECKS.on_tables(key, _grouped(columns, source))
    def _(t):
        return counted(t[table], **{name: build() for name, (_, build) in labels.items()})


def _audio(key: str, **labels: tuple[str, object]) -> None:
    _query_label(key, labels, "fact_audio_analysis", "fact_audio_analysis")


_E, _D, _V, _A, _T = (
    (lambda n=name: F.col(n))
    for name in ("energy", "danceability", "valence", "acousticness", "tempo")
)
_audio(
    "k8_music_category",
    music_category=(oq.MUSIC_CATEGORY, lambda: k.music_category(_E(), _D(), _A(), _V())),
)
_audio(
    "k9_three_levels",
    energy_level=(under(wide("energy"), oq.CUT3, k.ENERGY3), lambda: k.level3(_E(), k.ENERGY3)),
    danceability_level=(
        under(wide("danceability"), oq.CUT3, k.DANCE3),
        lambda: k.level3(_D(), k.DANCE3),
    ),
    valence_level=(under(wide("valence"), oq.CUT3, k.VALENCE3), lambda: k.level3(_V(), k.VALENCE3)),
)
_audio("k10_mood_trending", mood=(oq.MOOD_TRENDING, lambda: k.mood_trending(_V(), _E())))
_audio("k12_mood_regional", mood=(oq.MOOD_REGIONAL, lambda: k.mood_regional(_V(), _E())))
_audio(
    "k13_low_medium_high",
    energy_level=(under(wide("energy"), oq.CUT3, oq.L3), lambda: k.level3(_E())),
    danceability_level=(under(wide("danceability"), oq.CUT3, oq.L3), lambda: k.level3(_D())),
    valence_level=(under(wide("valence"), oq.CUT3, oq.L3), lambda: k.level3(_V())),
    acousticness_level=(under(wide("acousticness"), oq.CUT3, oq.L3), lambda: k.level3(_A())),
)
_audio(
    "k14_tempo",
    tempo_category=(
        under(wide("tempo"), (90, 120, 150), ("Slow", "Medium", "Fast", "Very Fast")),
        lambda: k.tempo4(_T()),
    ),
)
_audio("k15_mood_popularity", mood=(oq.MOOD_POPULARITY, lambda: k.mood_popularity(_V(), _E())))
_audio("k16_mood_strict", mood=(oq.MOOD_STRICT, lambda: k.mood_strict(_V(), _E())))
_query_label(
    "k18_duration_category",
    {"duration_category": (oq.DURATION, lambda: k.duration_category(F.col("duration_ms")))},
    "dim_song",
    "dim_song",
)
_query_label(
    "k19_season",
    {"month": ("month", lambda: F.col("month")), "season": ("season", lambda: k.season(F.col("month")))},
    "dim_date",
    "dim_date",
)
_query_label(
    "k20_explicit_label",
    {
        "type": (
            "CASE WHEN is_explicit THEN 'Explicit' ELSE 'Non-Explicit' END",
            lambda: k.explicit_label(F.col("is_explicit")),
        )
    },
    "dim_song",
    "dim_song",
)


@CHECKS.on_tables(
    "k11_artist_tier",
    f"""SELECT artist_key AS artist_name,
          {oq.reach('COUNT(DISTINCT song_key)', (50, 20, 10), oq.TIERS)} AS artist_tier
        FROM fact_artist_stats GROUP BY artist_key""",
)
def k11(t):
    songs = t["fact_artist_stats"].groupBy("artist_key").agg(F.count_distinct("song_key").alias("s"))
    return natural(songs.withColumn("artist_tier", k.artist_tier(F.col("s"))), t).drop("s")


@CHECKS.on_tables(
    "k17_album_type",
    f"""SELECT album_name, release_date,
          {oq.reach('COUNT(DISTINCT song_key)', (12, 6, 2), oq.TYPES)} AS album_type
        FROM fact_song_daily JOIN dim_album USING (album_key) GROUP BY album_name, release_date""",
)
def k17(t):
    rows = t["fact_song_daily"].filter("album_key IS NOT NULL")
    songs = rows.groupBy("album_key").agg(F.count_distinct("song_key").alias("s"))
    return natural(songs.withColumn("album_type", k.album_type(F.col("s"))), t).drop("s")


# --- dimensions -----------------------------------------------------------------


def _dim(key: str, name: str, cols: str, build) -> None:
    @CHECKS.on_tables(key, f"SELECT {cols} FROM {name}")
    def _(t):
        built = build(t["clean"])
        if "created_at" in built.columns:
            built = built.withColumn("created_at", F.to_date("created_at"))
        return built.drop(built.columns[0])


_dim("d1_dim_artist", "dim_artist", "artist_name, created_at", dims.dim_artist)
_dim(
    "d2_dim_album",
    "dim_album",
    "album_name, release_date, release_year, release_month, created_at",
    dims.dim_album,
)
_dim("d3_dim_date", "dim_date", "* EXCLUDE (date_key)", dims.dim_date)
_dim("d6_dim_song", "dim_song", "* EXCLUDE (song_key)", dims.dim_song)
_dim(
    "d7_dim_audio_features",
    "dim_audio_features",
    "* EXCLUDE (features_key)",
    dims.dim_audio_features,
)


@CHECKS.on_tables(
    "d4_dim_country",
    "SELECT country_code, country_name FROM dim_country",
)
def d4(t):
    return dims.dim_country(t["clean"]).drop("country_key")


@CHECKS.on_tables("d5_default_member", "SELECT country_code, country_name FROM dim_country")
def d5(t):
    codes = t["clean"].select(F.col("country").alias("country_code")).dropna().distinct()
    return dims.with_default_member(codes.withColumn("country_name", F.col("country_code")))


@CHECKS.on_tables(
    "d8_surrogate_key",
    """SELECT COUNT(*) AS songs, COUNT(DISTINCT spotify_id) AS keys FROM dim_song""",
)
def d8(t):
    songs = with_key(t["clean"].select("spotify_id").distinct(), ["spotify_id"], "song_key")
    return songs.agg(
        F.count(F.lit(1)).alias("songs"), F.count_distinct("song_key").alias("keys")
    )


# --- facts ----------------------------------------------------------------------


@CHECKS.on_tables(
    "f0_resolve_keys",
    """SELECT k.spotify_id, k.snapshot_date, country_key AS country_code, k.album_name,
          CASE WHEN k.album_name IS NOT NULL THEN album_release_date END AS release_date,
          energy_level, COUNT(*) AS n
        FROM keyed k GROUP BY ALL""",
)
def f0(t):
    keyed = facts.resolve_keys(t["clean"], t).select(
        "song_key", "snapshot_date", "country_key", "album_key", "features_key"
    )
    levels = t["dim_audio_features"].select("features_key", "energy_level")
    rows = natural(keyed.join(levels, "features_key").drop("features_key"), t)
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


_NATURAL = "song_key AS spotify_id, snapshot_date, country_key AS country_code"


def _reals(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


@CHECKS.on_tables(
    "f1_fact_song_daily",
    f"""SELECT {_NATURAL}, album_name, release_date, daily_rank, popularity_score,
          {_reals('rank_points', 'performance_index')}
        FROM fact_song_daily LEFT JOIN dim_album USING (album_key)""",
)
def f1(t):
    return natural(facts.fact_song_daily(facts.resolve_keys(t["clean"])), t)


@CHECKS.on_tables(
    "f2_fact_artist_stats",
    f"""SELECT artist_key AS artist_name, {_NATURAL}, song_rank, song_popularity, artist_position,
          {_reals('artist_score', 'contribution_weight')} FROM fact_artist_stats""",
)
def f2(t):
    return natural(facts.fact_artist_stats(facts.resolve_keys(t["clean"])), t)


@CHECKS.on_tables(
    "f3_fact_chart_position",
    f"""SELECT {_NATURAL}, current_rank, previous_rank, daily_movement, weekly_movement, is_rising,
          is_falling, movement_magnitude, {_reals('trend_strength')} FROM fact_chart_position""",
)
def f3(t):
    return natural(facts.fact_chart_position(facts.resolve_keys(t["clean"])), t)


@CHECKS.on_tables(
    "f4_fact_audio_analysis",
    f"""SELECT song_key AS spotify_id, energy_level, danceability_level, valence_level,
          tempo_category, acousticness_level, key_signature, mode, time_signature,
          {_reals('danceability', 'energy', 'loudness', 'speechiness', 'acousticness',
                  'instrumentalness', 'liveness', 'valence', 'tempo', 'energy_dance_score',
                  'mood_score')}, fact_audio_analysis.created_at
        FROM fact_audio_analysis JOIN dim_audio_features USING (features_key)""",
)
def f4(t):
    built = facts.fact_audio_analysis(facts.resolve_keys(t["clean"]))
    labels = t["dim_audio_features"].drop("created_at")
    built = built.withColumn("created_at", F.col("created_at").cast("date"))
    return natural(built.join(labels, "features_key").drop("features_key"), t)


@CHECKS.on_tables(
    "f5_fact_streaming_metrics",
    f"""SELECT {_NATURAL}, estimated_streams, estimated_listeners,
          {_reals('avg_completion_rate', 'engagement_score', 'viral_coefficient')}
        FROM fact_streaming_metrics""",
)
def f5(t):
    return natural(facts.fact_streaming_metrics(facts.resolve_keys(t["clean"])), t)
