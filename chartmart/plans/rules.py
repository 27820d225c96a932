"""The constraints of the warehouse tables, as tests that rows must pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.functions.clean import clean_date, to_number
from chartmart.operators.quality import check_fk, check_rules, check_unique
from chartmart.plans.warehouse import colliding_keys
from chartmart.sources.tables import DIMENSIONS, NATURAL_KEYS, SCHEMAS

Tables = Mapping[str, DataFrame]

_UNIT = ("danceability", "energy", "speechiness", "acousticness", "instrumentalness",
         "liveness", "valence")

# Allowed ranges and text lengths of the stored columns.
VALUE_RULES: dict[str, dict[str, Callable[[], Column]]] = {
    "fact_song_daily": {
        "popularity_score in 0..100": lambda: F.col("popularity_score").between(0, 100)
    },
    "fact_audio_analysis": {
        **{f"{name} in 0..1": (lambda n=name: F.col(n).between(0, 1)) for name in _UNIT},
        "key_signature in 0..11": lambda: F.col("key_signature").between(0, 11),
        "mode in 0, 1": lambda: F.col("mode").isin(0, 1),
        "tempo above 0": lambda: F.col("tempo") > 0,
    },
}
MAX_LENGTHS = {
    "dim_song": {"spotify_id": 255},
    "dim_date": {"month_name": 20, "day_name": 20, "season": 20},
    "dim_country": {"country_code": 10, "country_name": 255},
    "dim_audio_features": {
        "energy_level": 20,
        "danceability_level": 20,
        "valence_level": 20,
        "tempo_category": 20,
        "acousticness_level": 20,
    },
}
REQUIRED_COLUMNS = {
    "dim_song": ("spotify_id", "song_name"),
    "dim_artist": ("artist_name",),
    "dim_album": ("album_name",),
    "dim_date": ("full_date", "year", "quarter", "month", "day", "day_of_week"),
    "dim_country": ("country_code", "country_name"),
    "dim_audio_features": NATURAL_KEYS["dim_audio_features"],
    "fact_song_daily": ("song_key", "date_key"),
    "fact_artist_stats": ("artist_key", "song_key", "date_key"),
    "fact_chart_position": ("song_key", "date_key"),
    "fact_audio_analysis": ("song_key",),
    "fact_streaming_metrics": ("song_key", "date_key"),
}
FOREIGN_KEYS = {
    "song_key": "dim_song",
    "artist_key": "dim_artist",
    "album_key": "dim_album",
    "date_key": "dim_date",
    "country_key": "dim_country",
    "features_key": "dim_audio_features",
}

# What cleaning will replace by defaults or null in a raw feed.
FEED_RULES: dict[str, Callable[[], Column]] = {
    "daily_rank is a number": lambda: F.col("daily_rank").isNull()
    | to_number(F.col("daily_rank")).isNotNull(),
    "daily_movement is a number": lambda: F.col("daily_movement").isNull()
    | to_number(F.col("daily_movement")).isNotNull(),
    "weekly_movement is a number": lambda: F.col("weekly_movement").isNull()
    | to_number(F.col("weekly_movement")).isNotNull(),
    "popularity in 0..100": lambda: to_number(F.col("popularity")).between(0, 100),
    "energy in 0..1": lambda: to_number(F.col("energy")).between(0, 1),
    "tempo in 30..250": lambda: to_number(F.col("tempo")).between(30, 250),
    "album_release_date is a date": lambda: F.col("album_release_date").isNull()
    | clean_date(F.col("album_release_date")).isNotNull(),
}


def _tagged(table: str, violations: DataFrame) -> DataFrame:
    return violations.select(F.lit(table).alias("table_name"), "rule", "violations")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def value_violations(t: Tables, feed: DataFrame | None = None) -> DataFrame:
    """Rows outside the allowed ranges, by table and rule; of a raw feed too, if given."""
    parts = [
        _tagged(name, check_rules(t[name], {rule: test() for rule, test in rules.items()}))
        for name, rules in VALUE_RULES.items()
    ]
    if feed is not None:
        tests = {rule: test() for rule, test in FEED_RULES.items()}
        parts.append(_tagged("feed", check_rules(feed, tests)))
    return _union(parts)


def column_violations(t: Tables) -> DataFrame:
    """Missing values in required columns and texts that are too long."""
    parts = []
    for name in SCHEMAS:
        tests = {f"{c} is set": F.col(c).isNotNull() for c in REQUIRED_COLUMNS[name]}
        for c, most in MAX_LENGTHS.get(name, {}).items():
            tests[f"{c} up to {most}"] = F.length(c) <= most
        parts.append(_tagged(name, check_rules(t[name], tests)))
    return _union(parts)


def unique_violations(t: Tables) -> DataFrame:
    """Keys that occur more than once: natural keys of all tables, surrogate ones of dimensions."""

    def counted(name: str, rule: str, repeated: DataFrame) -> DataFrame:
        total = repeated.agg(F.count(F.lit(1)).alias("violations"))
        return _tagged(name, total.withColumn("rule", F.lit(rule)))

    natural = [
        counted(name, "natural key is unique", check_unique(t[name], list(keys)))
        for name, keys in NATURAL_KEYS.items()
    ]
    surrogate = [
        counted(name, "surrogate key is unique", colliding_keys(t[name], SCHEMAS[name].split()[0]))
        for name in DIMENSIONS
    ]
    return _union(natural + surrogate)


def reference_violations(t: Tables) -> DataFrame:
    """Fact rows whose key has no dimension row, by fact and key."""
    parts = []
    for name in SCHEMAS:
        if not name.startswith("fact"):
            continue
        for key, dim in FOREIGN_KEYS.items():
            if key in t[name].columns:
                missing = check_fk(t[name], t[dim], key)
                total = F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")
                parts.append(
                    _tagged(name, missing.agg(total).withColumn("rule", F.lit(f"{key} in {dim}")))
                )
    return _union(parts)
