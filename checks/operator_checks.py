"""Keys for single operators, streaming loads and table checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chartmart.functions import classify as k
from chartmart.functions.clean import clean_country, split_artists
from chartmart.functions.keys import key_of
from chartmart.operators.aggregate import summarise, text_list
from chartmart.operators.fan import fan_join_agg
from chartmart.operators.joins import drop_keys, keep_keys, lookup, star
from chartmart.operators.quality import describe_tables, find_columns
from chartmart.operators.rows import (
    down,
    first_per,
    recent,
    top_k,
    top_k_per,
    with_previous,
)
from chartmart.plans import rules
from chartmart.sources.feed import FEED_COLUMNS
from chartmart.sources.tables import FACTS, NATURAL_KEYS, SCHEMAS, read_table, table_counts
from chartmart.streaming.ingest import start_ingest
from checks import oracle_queries as oq
from checks.base import wide
from checks.files import fresh_dir, write_feed_csv
from checks.load_checks import natural
from checks.pairs import Pairs
from checks.ranking import ranked_in_group
from checks.warehouse import warehouse

CHECKS = Pairs()
AS_OF = dt.date(2001, 8, 1)


def rows():
    return F.count(F.lit(1))


# --- joins ----------------------------------------------------------------------


@CHECKS.on_tables(
    "j1_required_lookup",
    """SELECT country_key AS country_code, COUNT(*) AS n FROM keyed
       JOIN dim_song s USING (song_key) WHERE s.duration_ms >= 200000 GROUP BY country_key""",
)
def j1(t):
    long_songs = t["dim_song"].filter("duration_ms >= 200000").select("spotify_id", "song_key")
    found = lookup(t["clean"], long_songs, ["spotify_id"])
    return summarise(found.withColumn("country_code", clean_country(F.col("country"))), ["country_code"], n=rows())


@CHECKS.on_tables(
    "j2_lookup_with_default",
    """SELECT COALESCE(country_name, 'Global') AS country_name, COUNT(*) AS n
       FROM clean LEFT JOIN dim_country ON country = country_code GROUP BY 1""",
)
def j2(t):
    names = t["dim_country"].select(F.col("country_code").alias("country"), "country_name")
    found = lookup(t["clean"], names, ["country"], "left", default={"country_name": F.lit("Global")})
    return summarise(found, ["country_name"], n=rows())


@CHECKS.on_tables(
    "j3_null_safe_lookup",
    """SELECT c.album_name, release_year, COUNT(*) AS n
       FROM clean c LEFT JOIN dim_album d
         ON c.album_name = d.album_name
         AND c.album_release_date IS NOT DISTINCT FROM d.release_date
       GROUP BY ALL""",
)
def j3(t):
    albums = t["dim_album"].select(
        "album_name", F.col("release_date").alias("album_release_date"), "release_year"
    )
    found = lookup(t["clean"], albums, ["album_name", "album_release_date"], "left", null_safe=True)
    return summarise(found, ["album_name", "release_year"], n=rows())


@CHECKS.on_tables(
    "j4_artist_lookup", "SELECT artist_name, COUNT(*) AS n FROM listed GROUP BY artist_name"
)
def j4(t):
    listed = t["clean"].select(F.posexplode(split_artists(F.col("artists"))).alias("pos", "artist_name"))
    known = t["dim_artist"].select("artist_name", "artist_key")
    return summarise(lookup(listed, known, ["artist_name"]), ["artist_name"], n=rows())


_LEVELS = ", ".join(k.FEATURE_LABELS)


@CHECKS.on_tables("j5_label_lookup", f"SELECT {_LEVELS}, COUNT(*) AS n FROM labelled GROUP BY ALL")
def j5(t):
    labels = t["clean"].select(
        k.feature_labels(
            *[F.col(f) for f in ("energy", "danceability", "valence", "acousticness", "tempo")]
        ).alias("l")
    ).select("l.*")
    combos = t["dim_audio_features"].select("features_key", *k.FEATURE_LABELS)
    found = lookup(labels, combos, list(k.FEATURE_LABELS), "left")
    return summarise(found.filter("features_key IS NOT NULL"), list(k.FEATURE_LABELS), n=rows())


@CHECKS.on_tables(
    "j6_star_join",
    """SELECT country_name, year, COUNT(*) AS n
       FROM fact_song_daily JOIN dim_country USING (country_key) JOIN dim_date USING (date_key)
       GROUP BY ALL""",
)
def j6(t):
    dims = {
        "country_key": t["dim_country"].select("country_key", "country_name"),
        "date_key": t["dim_date"].select("date_key", "year"),
    }
    return summarise(star(t["fact_song_daily"], dims), ["country_name", "year"], n=rows())


_FAN_BY_COUNTRY = """
    SELECT country_key AS country_code, COUNT(*) AS joined_rows,
      AVG(popularity_score) AS avg_popularity, MIN(daily_rank) AS best_rank,
      MAX(popularity_score) AS max_popularity, COUNT(DISTINCT artist_key) AS artists
    FROM fan GROUP BY country_key"""


@CHECKS.on_tables("j7_fan_join", "SELECT country_key AS country_code, COUNT(*) AS joined_rows FROM fan GROUP BY 1")
def j7(t):
    counted = fan_join_agg(
        t["fact_song_daily"],
        t["fact_artist_stats"],
        ["song_key", "date_key"],
        ["country_key"],
        {"joined_rows": ("count", None)},
    )
    return natural(counted, t)


@CHECKS.on_tables("o1_fan_join_agg", _FAN_BY_COUNTRY)
def o1(t):
    grouped = fan_join_agg(
        t["fact_song_daily"],
        t["fact_artist_stats"],
        ["song_key", "date_key"],
        ["country_key"],
        {
            "joined_rows": ("count", None),
            "avg_popularity": ("avg", "popularity_score"),
            "best_rank": ("min", "daily_rank"),
            "max_popularity": ("max", "popularity_score"),
        },
        distinct={"artists": "artist_key"},
    )
    return natural(grouped, t)


@CHECKS.on_tables(
    "j8_fact_to_song_fact",
    """SELECT key_signature, COUNT(*) AS n
       FROM fact_song_daily JOIN fact_audio_analysis USING (song_key) GROUP BY 1""",
)
def j8(t):
    keys = t["fact_audio_analysis"].select("song_key", "key_signature")
    return summarise(t["fact_song_daily"].select("song_key").join(keys, "song_key"), ["key_signature"], n=rows())


@CHECKS.on_tables(
    "j9_dimension_left_join",
    """SELECT spotify_id, COUNT(artist_key) AS n
       FROM dim_song LEFT JOIN fact_artist_stats USING (song_key) GROUP BY spotify_id""",
)
def j9(t):
    played = t["fact_artist_stats"].select("song_key", "artist_key")
    found = lookup(t["dim_song"].select("song_key", "spotify_id"), played, ["song_key"], "left")
    return summarise(found, ["spotify_id"], n=F.count("artist_key"))


@CHECKS.on_tables(
    "j10_all_left_join",
    """SELECT country_name, COUNT(*) AS n, COUNT(album_name) AS with_album
       FROM fact_song_daily LEFT JOIN dim_country USING (country_key)
       LEFT JOIN dim_album USING (album_key) GROUP BY country_name""",
)
def j10(t):
    dims = {
        "country_key": t["dim_country"].select("country_key", "country_name"),
        "album_key": t["dim_album"].select("album_key", "album_name"),
    }
    found = star(t["fact_song_daily"], dims, how="left")
    return summarise(found, ["country_name"], n=rows(), with_album=F.count("album_name"))


_BUSY = """SELECT country_key FROM fact_song_daily GROUP BY country_key
           ORDER BY COUNT(*) DESC, country_key LIMIT 5"""


def _busy_countries(t):
    named = natural(summarise(t["fact_song_daily"], ["country_key"], n=rows()), t)
    best = top_k(named, [down("n"), F.asc("country_code")], 5)
    return best.select(key_of("country_code").alias("country_key"))


@CHECKS.on_tables(
    "j11_keep_keys",
    f"""SELECT country_key AS country_code, COUNT(*) AS n FROM fact_song_daily
        WHERE country_key IN ({_BUSY}) GROUP BY 1""",
)
def j11(t):
    kept = keep_keys(t["fact_song_daily"], _busy_countries(t), ["country_key"])
    return natural(summarise(kept, ["country_key"], n=rows()), t)


@CHECKS.on_tables(
    "j12_drop_keys",
    f"""SELECT country_key AS country_code, COUNT(*) AS n FROM fact_song_daily
        WHERE country_key NOT IN ({_BUSY}) GROUP BY 1""",
)
def j12(t):
    kept = drop_keys(t["fact_song_daily"], _busy_countries(t), ["country_key"])
    return natural(summarise(kept, ["country_key"], n=rows()), t)


# --- aggregates -----------------------------------------------------------------


def _agg(key: str, oracle: str, build, *rounded: str) -> None:
    CHECKS.on_tables(key, oracle, *rounded)(build)


def _daily(t):
    return t["fact_song_daily"]


_agg(
    "a1_count",
    "SELECT snapshot_date, COUNT(*) AS n FROM fact_song_daily GROUP BY 1",
    lambda t: summarise(_daily(t), ["snapshot_date"], n=rows()),
)
_agg(
    "a2_count_distinct",
    """SELECT snapshot_date, COUNT(DISTINCT song_key) AS songs,
         COUNT(DISTINCT country_key) AS countries FROM fact_song_daily GROUP BY 1""",
    lambda t: summarise(
        _daily(t),
        ["snapshot_date"],
        songs=F.count_distinct("song_key"),
        countries=F.count_distinct("country_key"),
    ),
)
_agg(
    "a3_avg",
    "SELECT snapshot_date, AVG(daily_rank) AS avg_rank FROM fact_song_daily GROUP BY 1",
    lambda t: summarise(_daily(t), ["snapshot_date"], avg_rank=F.avg("daily_rank")),
)
_agg(
    "a4_sum",
    f"SELECT snapshot_date, {oq.POINTS} AS points FROM fact_song_daily GROUP BY 1",
    lambda t: summarise(
        _daily(t), ["snapshot_date"], points=F.sum("rank_points").cast("double")
    ),
)
_agg(
    "a5_min_max",
    """SELECT daily_rank, MIN(snapshot_date) AS first_date, MAX(snapshot_date) AS last_date,
         MIN(popularity_score) AS low, MAX(popularity_score) AS high
       FROM fact_song_daily GROUP BY 1""",
    lambda t: summarise(
        _daily(t),
        ["daily_rank"],
        first_date=F.min("snapshot_date"),
        last_date=F.max("snapshot_date"),
        low=F.min("popularity_score"),
        high=F.max("popularity_score"),
    ),
)
_agg(
    "a6_text_list",
    """SELECT song_name, STRING_AGG(DISTINCT country_name, ', ' ORDER BY country_name) AS countries
       FROM fact_song_daily JOIN dim_song USING (song_key) JOIN dim_country USING (country_key)
       GROUP BY song_name""",
    lambda t: text_list(
        star(
            _daily(t).select("song_key", "country_key").distinct(),
            {
                "song_key": t["dim_song"].select("song_key", "song_name"),
                "country_key": t["dim_country"].select("country_key", "country_name"),
            },
        ),
        ["song_name"],
        "country_name",
        "countries",
    ),
)
_agg(
    "a7_difference_of_aggregates",
    """SELECT snapshot_date, MAX(popularity_score) - MIN(popularity_score) AS spread
       FROM fact_song_daily GROUP BY 1""",
    lambda t: summarise(
        _daily(t), ["snapshot_date"], spread=F.max("popularity_score") - F.min("popularity_score")
    ),
)
_agg(
    "a8_having",
    """SELECT daily_rank, COUNT(*) AS n FROM fact_song_daily GROUP BY 1
       HAVING COUNT(*) >= 1000""",
    lambda t: summarise(_daily(t), ["daily_rank"], having=F.col("n") >= 1000, n=rows()),
)
_agg(
    "a9_case_over_aggregate",
    f"""SELECT artist_key AS artist_name, COUNT(DISTINCT song_key) AS songs,
          {oq.reach('COUNT(DISTINCT song_key)', (50, 20, 10), oq.TIERS)} AS tier
        FROM fact_artist_stats GROUP BY 1""",
    lambda t: natural(
        summarise(
            t["fact_artist_stats"], ["artist_key"], songs=F.count_distinct("song_key")
        ).withColumn("tier", k.artist_tier(F.col("songs"))),
        t,
    ),
)
_agg(
    "a10_two_stages",
    """SELECT n AS chart_rows, COUNT(*) AS songs
       FROM (SELECT song_key, COUNT(*) AS n FROM fact_song_daily GROUP BY 1) GROUP BY 1""",
    lambda t: summarise(
        summarise(_daily(t), ["song_key"], chart_rows=rows()), ["chart_rows"], songs=rows()
    ),
)
_agg(
    "a11_global",
    """SELECT COUNT(*) AS n, AVG(popularity_score) AS avg_popularity,
         MAX(popularity_score) AS max_popularity FROM fact_song_daily""",
    lambda t: summarise(
        _daily(t),
        [],
        n=rows(),
        avg_popularity=F.avg("popularity_score"),
        max_popularity=F.max("popularity_score"),
    ),
)
_agg(
    "a12_group_by_derived",
    f"SELECT {oq.DURATION} AS duration_category, COUNT(*) AS n FROM dim_song GROUP BY 1",
    lambda t: summarise(
        t["dim_song"].withColumn("duration_category", k.duration_category(F.col("duration_ms"))),
        ["duration_category"],
        n=rows(),
    ),
)
_agg(
    "a13_avg_of_arithmetic",
    f"SELECT is_explicit, ROUND({oq.MINUTES}, 6) AS minutes FROM dim_song GROUP BY 1",
    lambda t: summarise(
        t["dim_song"],
        ["is_explicit"],
        minutes=F.avg(F.col("duration_ms").cast("double") / 1000 / 60),
    ),
    "minutes",
)
_agg(
    "a14_second_stage",
    """SELECT n // 10 AS tens, COUNT(*) AS size, CAST(SUM(n) AS BIGINT) AS total, AVG(n) AS mean
       FROM (SELECT snapshot_date, COUNT(*) AS n FROM fact_song_daily GROUP BY 1) GROUP BY 1""",
    lambda t: summarise(
        summarise(_daily(t), ["snapshot_date"], n=rows()).withColumn("tens", F.floor(F.col("n") / 10)),
        ["tens"],
        size=rows(),
        total=F.sum("n"),
        mean=F.avg("n"),
    ),
)
_agg(
    "a15_first_day",
    "SELECT MIN(snapshot_date) AS first_day FROM clean",
    lambda t: summarise(t["clean"], [], first_day=F.min("snapshot_date")),
)
_agg(
    "a16_distinct",
    "SELECT DISTINCT album_name, album_release_date FROM clean",
    lambda t: t["clean"].select("album_name", "album_release_date").distinct(),
)

# --- windows --------------------------------------------------------------------

_BY_NAME_AND_DAY = """
    SELECT song_name, snapshot_date AS date, AVG(daily_rank) AS avg_rank
    FROM fact_song_daily JOIN dim_song USING (song_key) GROUP BY 1, 2"""


@CHECKS.on_tables(
    "w1_lag",
    f"""SELECT *, LAG(avg_rank) OVER w AS prev_rank, avg_rank - LAG(avg_rank) OVER w AS rank_change
        FROM ({_BY_NAME_AND_DAY}) WINDOW w AS (PARTITION BY song_name ORDER BY date)""",
)
def w1(t):
    named = _daily(t).join(t["dim_song"].select("song_key", "song_name"), "song_key")
    daily = summarise(
        named.withColumn("date", F.col("snapshot_date")),
        ["song_name", "date"],
        avg_rank=F.avg("daily_rank"),
    )
    return with_previous(daily, ["song_name"], ["date"], "avg_rank", "prev_rank", "rank_change")


@CHECKS.on_tables(
    "w2_top_per_group",
    """SELECT country_key AS country_code, spotify_id, n FROM (
         SELECT country_key, song_key, COUNT(*) AS n FROM fact_song_daily GROUP BY 1, 2)
       JOIN dim_song USING (song_key)
       QUALIFY ROW_NUMBER() OVER (PARTITION BY country_key ORDER BY n DESC, spotify_id) <= 3""",
)
def w2(t):
    found = natural(summarise(_daily(t), ["country_key", "song_key"], n=rows()), t)
    return top_k_per(found, ["country_code"], [down("n"), F.asc("spotify_id")], 3)


@CHECKS.on_tables(
    "w3_monthly_lag",
    """SELECT *, plays - LAG(plays) OVER (PARTITION BY artist_name ORDER BY month) AS growth,
         LAG(plays) OVER (PARTITION BY artist_name ORDER BY month) AS before
       FROM (SELECT artist_key AS artist_name, DATE_TRUNC('month', snapshot_date)::DATE AS month,
               COUNT(*) AS plays FROM fact_artist_stats GROUP BY 1, 2)""",
)
def w3(t):
    monthly = natural(
        summarise(
            t["fact_artist_stats"].withColumn("month", F.col("snapshot_month")),
            ["artist_key", "month"],
            plays=rows(),
        ),
        t,
    )
    return with_previous(monthly, ["artist_name"], ["month"], "plays", "before", "growth")


@CHECKS.on_tables(
    "w4_first_per_key",
    """SELECT spotify_id, snapshot_date, country, popularity FROM clean
       QUALIFY ROW_NUMBER() OVER (
         PARTITION BY spotify_id, snapshot_date, country ORDER BY seq) = 1""",
)
def w4(t):
    keys = ["spotify_id", "snapshot_date", "country"]
    return first_per(t["clean"].select(*keys, "popularity", "_seq"), keys, ["_seq"]).drop("_seq")


@CHECKS.on_folder(
    "w5_rank_in_bins",
    """SELECT o_custkey, o_orderkey, o_totalprice,
         ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place
       FROM orders""",
)
def w5(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_custkey", "o_orderkey", "o_totalprice"
    )
    return ranked_in_group(orders, ["o_custkey"], "o_totalprice", "o_orderkey", "place", width=64)


# --- ordered limits ---------------------------------------------------------------

_SONG_COUNTS = "SELECT song_key AS spotify_id, COUNT(*) AS n FROM fact_song_daily GROUP BY 1"


def _song_counts(t):
    return natural(summarise(_daily(t), ["song_key"], n=rows()), t)


@CHECKS.on_tables("l1_order_by", f"{_SONG_COUNTS} ORDER BY n DESC, spotify_id")
def l1(t):
    return top_k(_song_counts(t), [down("n"), F.asc("spotify_id")], None)


@CHECKS.on_tables("l2_limit", f"{_SONG_COUNTS} ORDER BY n DESC, spotify_id LIMIT 50")
def l2(t):
    return top_k(_song_counts(t), [down("n"), F.asc("spotify_id")], 50)


@CHECKS.on_tables(
    "l3_full_sort",
    "SELECT snapshot_date, COUNT(*) AS n FROM fact_song_daily GROUP BY 1 ORDER BY 1",
)
def l3(t):
    return top_k(summarise(_daily(t), ["snapshot_date"], n=rows()), [F.asc("snapshot_date")], None)


@CHECKS.on_tables("l4_head", f"{_SONG_COUNTS} ORDER BY n DESC, spotify_id LIMIT 10")
def l4(t):
    return top_k(_song_counts(t), [down("n"), F.asc("spotify_id")], 50).limit(10)


@CHECKS.on_tables(
    "l5_largest_groups",
    """SELECT country_key AS country_code, CAST(SUM(popularity_score) AS BIGINT) AS total
       FROM fact_song_daily GROUP BY 1 ORDER BY total DESC, country_code LIMIT 10""",
)
def l5(t):
    totals = natural(summarise(_daily(t), ["country_key"], total=F.sum("popularity_score")), t)
    return top_k(totals, [down("total"), F.asc("country_code")], 10)


# --- unions and membership ----------------------------------------------------------


@CHECKS.on_tables("u1_set_of_list_items", "SELECT DISTINCT artist_name FROM listed")
def u1(t):
    return t["clean"].select(F.explode(split_artists(F.col("artists"))).alias("artist_name")).distinct()


@CHECKS.on_tables(
    "u2_union_default",
    """SELECT country AS country_code, COUNT(*) AS n FROM clean WHERE country IS NOT NULL GROUP BY 1
       UNION ALL SELECT 'GLOBAL', COUNT(*) FROM clean WHERE country IS NULL""",
)
def u2(t):
    named = t["clean"].filter("country IS NOT NULL")
    named = summarise(named.withColumn("country_code", F.col("country")), ["country_code"], n=rows())
    rest = summarise(t["clean"].filter("country IS NULL"), [], n=rows())
    return named.unionByName(rest.withColumn("country_code", F.lit("GLOBAL")))


@CHECKS.on_tables(
    "u3_in_list",
    """SELECT country, COUNT(*) AS n FROM clean WHERE country IN ('N1', 'N2', 'N5') GROUP BY 1""",
)
def u3(t):
    return summarise(t["clean"].filter(F.col("country").isin("N1", "N2", "N5")), ["country"], n=rows())


# --- filters ------------------------------------------------------------------------


def _filter(key: str, table: str, where: str, keep, keys: str) -> None:
    @CHECKS.on_tables(key, f"SELECT {keys}, COUNT(*) AS n FROM {table} WHERE {where} GROUP BY ALL")
    def _(t):
        return summarise(keep(t[table]), keys.split(", "), n=rows())


_filter(
    "p1_recent",
    "fact_song_daily",
    f"snapshot_date >= {oq.AS_OF} - 60",
    lambda df: recent(df, AS_OF, 60),
    "snapshot_date",
)
_filter(
    "p2_popular",
    "fact_song_daily",
    "popularity_score >= 70",
    lambda df: df.filter(F.col("popularity_score") >= 70),
    "snapshot_date",
)
_filter(
    "p3_number_one",
    "fact_song_daily",
    "daily_rank = 1",
    lambda df: df.filter(F.col("daily_rank") == 1),
    "snapshot_date",
)
_filter(
    "p4_year_from",
    "dim_album",
    "release_year IS NOT NULL AND release_year >= 2000",
    lambda df: df.filter(F.col("release_year").isNotNull() & (F.col("release_year") >= 2000)),
    "release_year",
)
_filter(
    "p5_positive",
    "dim_song",
    "duration_ms > 0",
    lambda df: df.filter(F.col("duration_ms") > 0),
    "duration_ms",
)
_filter(
    "p7_all_features",
    "fact_audio_analysis",
    f"{oq.above(wide('energy'), 0.8)} AND {oq.above(wide('danceability'), 0.7)} "
    f"AND {wide('tempo')} > 120",
    lambda df: df.filter(
        (F.col("energy") > 0.8) & (F.col("danceability") > 0.7) & (F.col("tempo") > 120)
    ),
    "key_signature",
)
_filter(
    "p8_flag_and_threshold",
    "fact_chart_position",
    "is_rising AND trend_strength > 5",
    lambda df: df.filter(F.col("is_rising") & (F.col("trend_strength") > 5)),
    "snapshot_date",
)


@CHECKS.on_tables(
    "p6_always_true",
    f"SELECT {oq.MOOD_STRICT} AS mood, COUNT(*) AS n FROM fact_audio_analysis GROUP BY 1",
)
def p6(t):
    moods = t["fact_audio_analysis"].select(
        k.mood_strict(F.col("valence"), F.col("energy")).alias("mood")
    )
    return summarise(moods.filter(F.col("mood").isNotNull()), ["mood"], n=rows())


# --- incremental load -----------------------------------------------------------------

_CSV_COLUMNS = [*FEED_COLUMNS, "seq"]
_PERIODS = (dt.date(1997, 6, 1), dt.date(1999, 10, 1), None)


def _arrive(feed, path: str) -> None:
    """Feed files that arrive in order of time, a few per period; split over tasks, as a batch takes few."""
    day, start = F.to_date("snapshot_date"), dt.date(1990, 1, 1)
    for end in _PERIODS:
        kept = feed.filter(day >= F.lit(start))
        if end is not None:
            kept, start = kept.filter(day < F.lit(end)), end
        write_feed_csv(kept, path, compressed=False)


def _ingest(spark, path: str, run: str = "ckpt", max_files: int = 8) -> None:
    start_ingest(
        spark, f"{path}/in", f"{path}/wh", f"{path}/{run}", _CSV_COLUMNS, max_files=max_files
    ).awaitTermination()


def _loaded(spark, path: str) -> dict:
    return {name: read_table(spark, f"{path}/wh", name) for name in SCHEMAS}


@CHECKS.on_folder(
    "x1_incremental_load",
    """SELECT song_key AS spotify_id, snapshot_date, country_key AS country_code, album_name,
         release_date, daily_rank, popularity_score,
         CAST(performance_index AS DOUBLE) AS performance_index
       FROM fact_song_daily LEFT JOIN dim_album USING (album_key)""",
)
def x1(spark, sf_dir):
    path = fresh_dir(spark, sf_dir, "ingest")
    _arrive(warehouse(spark, sf_dir)["feed"], f"{path}/in")
    _ingest(spark, path)
    t = _loaded(spark, path)
    return natural(t["fact_song_daily"], t).drop("rank_points")


_IN_ORDER: dict[tuple[str, str], str] = {}


def _loaded_in_order(spark, sf_dir: str) -> dict:
    """The tables after two loads of some files, the feed arriving in its order."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _IN_ORDER:
        path = fresh_dir(spark, sf_dir, "ingest-in-order")
        feed = warehouse(spark, sf_dir)["feed"]
        last = feed.agg(F.max("_seq")).first()[0]
        for low, high in ((-1, last // 3), (last // 3, last)):
            part = feed.filter((F.col("_seq") > low) & (F.col("_seq") <= high))
            write_feed_csv(part, f"{path}/in")
            _ingest(spark, path, max_files=1000)
        _IN_ORDER[key] = path
    return _loaded(spark, _IN_ORDER[key])


def _x1(name: str, cols: str, build) -> None:
    @CHECKS.on_folder(f"x1_{name}", f"SELECT {cols} FROM {name}")
    def _(spark, sf_dir):
        t = _loaded_in_order(spark, sf_dir)
        return build(t[name], t)


_GRAIN_KEYS = "song_key AS spotify_id, snapshot_date, country_key AS country_code"
for _name, _cols in {
    "dim_song": "spotify_id, song_name, duration_ms, is_explicit",
    "dim_artist": "artist_name",
    "dim_album": "album_name, release_date, release_year, release_month",
    "dim_date": "* EXCLUDE (date_key)",
    "dim_country": "country_code, country_name",
    "dim_audio_features": "* EXCLUDE (features_key, created_at)",
}.items():
    _x1(_name, _cols, lambda dim, t: dim.drop(dim.columns[0], "created_at"))
for _name, _cols, _reals in (
    (
        "fact_artist_stats",
        "artist_key AS artist_name, " + _GRAIN_KEYS + ", song_rank, song_popularity, artist_position",
        ("artist_score", "contribution_weight"),
    ),
    (
        "fact_chart_position",
        _GRAIN_KEYS + ", current_rank, previous_rank, daily_movement, weekly_movement, is_rising, "
        "is_falling, movement_magnitude",
        ("trend_strength",),
    ),
    (
        "fact_streaming_metrics",
        _GRAIN_KEYS + ", estimated_streams, estimated_listeners",
        ("avg_completion_rate", "engagement_score", "viral_coefficient"),
    ),
    (
        "fact_audio_analysis",
        "song_key AS spotify_id, key_signature, mode, time_signature",
        ("danceability", "energy", "loudness", "speechiness", "acousticness", "instrumentalness",
         "liveness", "valence", "tempo", "energy_dance_score", "mood_score"),
    ),
):
    _wide = "".join(f", {wide(c)} AS {c}" for c in _reals)
    _x1(_name, _cols + _wide, lambda f, t: natural(f.drop("features_key", "created_at"), t))


_WEIGHED = """fact_song_daily s JOIN (
    SELECT d.song_key, d.snapshot_date, GREATEST(COUNT(a.song_key), 1) AS weight,
      COUNT(DISTINCT a.artist_key) AS listed
    FROM (SELECT DISTINCT song_key, snapshot_date FROM fact_song_daily) d
    LEFT JOIN fact_artist_stats a
      ON a.song_key = d.song_key AND a.snapshot_date = d.snapshot_date GROUP BY ALL) w
  ON w.song_key = s.song_key AND w.snapshot_date = s.snapshot_date"""


def _sum(*columns: tuple[str, str]) -> str:
    return ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {name}" for c, name in columns)


_SUMS = _sum(("popularity_score", "sum_popularity_score"), ("daily_rank", "sum_daily_rank"))


def _rolled_up(spark, sf_dir: str, name: str):
    """A rollup after the loads, by natural keys."""
    t = _loaded_in_order(spark, sf_dir)
    path = _IN_ORDER[(spark.sparkContext.applicationId, sf_dir)]
    df = read_table(spark, f"{path}/wh", name).withColumn("month", F.col("snapshot_month"))
    return natural(df, t)


@CHECKS.on_folder(
    "x4_agg_song_day",
    f"""SELECT s.song_key AS spotify_id, s.snapshot_date, COUNT(*) AS n, {_SUMS},
          MAX(popularity_score) AS max_popularity_score, ANY_VALUE(weight) AS weight,
          ANY_VALUE(listed) AS artists, CAST(DATE_TRUNC('month', s.snapshot_date) AS DATE) AS month
        FROM {_WEIGHED} GROUP BY s.song_key, s.snapshot_date""",
)
def x4_song_day(spark, sf_dir):
    df = _rolled_up(spark, sf_dir, "agg_song_day")
    return df.withColumn("artists", F.size("artists").cast("bigint"))


@CHECKS.on_folder(
    "x4_agg_song_month",
    f"""SELECT s.song_key AS spotify_id, s.country_key AS country_code, album_name, release_date,
          CAST(DATE_TRUNC('month', s.snapshot_date) AS DATE) AS month, COUNT(*) AS n, {_SUMS},
          MAX(popularity_score) AS max_popularity_score,
          {_sum(("weight", "fan"), ("weight * popularity_score", "fan_popularity_score"),
                ("weight * daily_rank", "fan_daily_rank"))},
          COUNT(*) FILTER (daily_rank = 1) AS number_one_days,
          CAST(COALESCE(SUM(weight) FILTER (daily_rank = 1), 0) AS BIGINT) AS number_one_fan
        FROM {_WEIGHED} LEFT JOIN dim_album USING (album_key) GROUP BY ALL""",
)
def x4_song_month(spark, sf_dir):
    df = _rolled_up(spark, sf_dir, "agg_song_month").drop("artists", "number_one_artists")
    return df.withColumn("number_one_days", F.size("number_one_days").cast("bigint"))


@CHECKS.on_folder(
    "x4_agg_artist_month",
    f"""SELECT artist_key AS artist_name, song_key AS spotify_id, country_key AS country_code,
          CAST(DATE_TRUNC('month', snapshot_date) AS DATE) AS month, COUNT(*) AS n,
          {_sum(("song_popularity", "sum_song_popularity"))},
          CAST(SUM(artist_score) AS DOUBLE) AS sum_artist_score
        FROM fact_artist_stats GROUP BY ALL""",
)
def x4_artist_month(spark, sf_dir):
    return _rolled_up(spark, sf_dir, "agg_artist_month")


_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {name}" for name in SCHEMAS
)


@CHECKS.on_folder("x2_replay_adds_nothing", _COUNTS)
def x2(spark, sf_dir):
    path = fresh_dir(spark, sf_dir, "replay")
    write_feed_csv(warehouse(spark, sf_dir)["feed"], f"{path}/in")
    _ingest(spark, path, "first", max_files=1000)
    _ingest(spark, path, "second", max_files=1000)
    return table_counts(_loaded(spark, path))


@CHECKS.on_folder("x3_empty_batches", _COUNTS)
def x3(spark, sf_dir):
    path = fresh_dir(spark, sf_dir, "empty")
    feed = warehouse(spark, sf_dir)["feed"]
    nothing = feed.filter("snapshot_date = 'never'")
    write_feed_csv(nothing, f"{path}/in")
    write_feed_csv(feed.filter("name = ''"), f"{path}/in")
    _ingest(spark, path, max_files=1000)
    write_feed_csv(feed, f"{path}/in")
    write_feed_csv(nothing, f"{path}/in")
    _ingest(spark, path, max_files=1000)
    return table_counts(_loaded(spark, path))


# --- table checks -----------------------------------------------------------------------


def _violations(parts: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
        f"COUNT(*) FILTER (WHERE NOT ({test})) AS violations FROM {table}"
        for table, rule, test in parts
    )


_NUM = "{c} IS NULL OR TRY_CAST({c} AS DOUBLE) IS NOT NULL"
_FEED_TESTS = {
    "daily_rank is a number": _NUM.format(c="daily_rank"),
    "daily_movement is a number": _NUM.format(c="daily_movement"),
    "weekly_movement is a number": _NUM.format(c="weekly_movement"),
    "popularity in 0..100": "TRY_CAST(popularity AS DOUBLE) BETWEEN 0 AND 100",
    "energy in 0..1": "TRY_CAST(energy AS DOUBLE) BETWEEN 0 AND 1",
    "tempo in 30..250": "TRY_CAST(tempo AS DOUBLE) BETWEEN 30 AND 250",
    "album_release_date is a date": "album_release_date IS NULL OR album_release_date <> 'bad'",
}
_VALUE_TESTS = {
    "popularity_score in 0..100": "popularity_score BETWEEN 0 AND 100",
    "key_signature in 0..11": "key_signature BETWEEN 0 AND 11",
    "mode in 0, 1": "mode IN (0, 1)",
    "tempo above 0": "tempo > 0",
}


@CHECKS.on_tables(
    "v1_value_rules",
    _violations(
        [
            (table, rule, _VALUE_TESTS.get(rule, f"{rule.split()[0]} BETWEEN 0 AND 1"))
            for table, tests in rules.VALUE_RULES.items()
            for rule in tests
        ]
        + [("feed", rule, test) for rule, test in _FEED_TESTS.items()]
    ),
)
def v1(t):
    return rules.value_violations(t, t["feed"])


@CHECKS.on_tables(
    "v2_required_and_length",
    _violations(
        [
            (table, f"{c} is set", f"{c} IS NOT NULL")
            for table, cols in rules.REQUIRED_COLUMNS.items()
            for c in cols
        ]
        + [
            (table, f"{c} up to {most}", f"LENGTH({c}) <= {most}")
            for table, cols in rules.MAX_LENGTHS.items()
            for c, most in cols.items()
        ]
    ),
)
def v2(t):
    return rules.column_violations(t)


def _repeated(table: str, rule: str, keys: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, COUNT(*) AS violations "
        f"FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING COUNT(*) > 1)"
    )


@CHECKS.on_tables(
    "v3_unique_keys",
    " UNION ALL ".join(
        [
            _repeated(name, "natural key is unique", ", ".join(keys))
            for name, keys in NATURAL_KEYS.items()
        ]
        + [
            _repeated(name, "surrogate key is unique", SCHEMAS[name].split()[0])
            for name in NATURAL_KEYS
            if name.startswith("dim")
        ]
    ),
)
def v3(t):
    return rules.unique_violations(t)


_REFERENCES = [
    (fact, key, dim)
    for fact, schema in FACTS.items()
    for key, dim in rules.FOREIGN_KEYS.items()
    if f"{key} " in schema
]


@CHECKS.on_tables(
    "v4_foreign_keys",
    " UNION ALL ".join(
        f"SELECT '{fact}' AS table_name, '{key} in {dim}' AS rule, COUNT(*) AS violations "
        f"FROM {fact} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {dim})"
        for fact, key, dim in _REFERENCES
    ),
)
def v4(t):
    return rules.reference_violations(t)


def _listing(tables) -> str:
    parts = []
    for name in tables:
        # Commas inside decimal(p,s) do not separate columns.
        columns = [c.split() for c in SCHEMAS[name].split(", ")]
        for i, (col, kind) in enumerate(columns):
            source = "DATE_TRUNC('month', snapshot_date)" if col == "snapshot_month" else col
            parts.append(
                f"SELECT '{name}' AS table_name, {i + 1} AS position, '{col}' AS column_name, "
                f"'{kind}' AS data_type, COUNT({source}) < COUNT(*) AS has_nulls, "
                f"COUNT({source}) AS filled_rows, COUNT(*) AS total_rows FROM {name}"
            )
    return " UNION ALL ".join(parts)


@CHECKS.on_tables("v5_describe_tables", _listing(SCHEMAS))
def v5(t):
    return describe_tables(t)


@CHECKS.on_tables(
    "v6_find_columns",
    f"""SELECT table_name, column_name, data_type, filled_rows FROM ({_listing(SCHEMAS)})
        WHERE table_name LIKE '%song%' AND column_name LIKE '%rank%'""",
)
def v6(t):
    found = find_columns(t, "%song%", "%rank%")
    return found.select("table_name", "column_name", "data_type", "filled_rows")
