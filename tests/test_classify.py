"""Label rules at and around their cut points."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chartmart.functions import classify as k


def test_level5_treats_zero_as_missing(values):
    cells = [0.0, None, 0.19, 0.2, 0.4, 0.6, 0.79, 0.8, 1.0]
    assert values(k.level5, cells, "double") == [
        "Medium", "Medium", "Very Low", "Low", "Medium", "High", "High", "Very High", "Very High",
    ]


def test_valence5_and_tempo5(values):
    assert values(k.valence5, [0.0, 0.1, 0.2, 0.4, 0.6, 0.8], "double") == [
        "Neutral", "Very Negative", "Negative", "Neutral", "Positive", "Very Positive",
    ]
    assert values(k.tempo5, [0.0, 59.9, 60.0, 90.0, 120.0, 140.0], "double") == [
        "Fast", "Very Slow", "Slow", "Moderate", "Fast", "Very Fast",
    ]


def labels(spark, rule, rows, kind="double"):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, v {kind}, e {kind}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"), F.col("e"))).collect()]


def test_mood_etl(spark):
    rows = [(0.6, 0.6), (0.6, 0.59), (0.39, 0.6), (0.39, 0.1), (0.4, 0.9)]
    assert labels(spark, k.mood_etl, rows) == ["Happy", "Calm", "Energetic", "Sad", "Neutral"]


@pytest.mark.parametrize(
    ("rule", "want"),
    [
        (k.mood_trending, ["Energetic", "Happy", "Neutral", "Sad", "Neutral"]),
        (k.mood_regional, ["Happy & Energetic", "Happy", "Energetic", "Melancholic", "Neutral"]),
        (k.mood_popularity, ["Happy", "Calm", "Energetic", "Sad", "Neutral"]),
        (k.mood_strict, ["Happy", "Calm", "Energetic", "Sad", "Neutral"]),
    ],
)
def test_query_moods(spark, rule, want):
    rows = [(0.9, 0.9), (0.9, 0.1), (0.1, 0.9), (0.1, 0.1), (0.5, 0.5)]
    assert labels(spark, rule, rows) == want


def test_moods_differ_in_between(spark):
    rows = [(0.9, 0.5), (0.1, 0.5)]
    assert labels(spark, k.mood_strict, rows) == ["Neutral", "Neutral"]
    assert labels(spark, k.mood_popularity, rows) == ["Calm", "Sad"]
    assert labels(spark, k.mood_trending, rows) == ["Happy", "Neutral"]


def test_float32_cut_points(spark):
    """A stored 0.7 is below 0.7 and a stored 0.6 above 0.6."""
    df = spark.createDataFrame(
        [(0.7, 0.7, 0.1, 0.6), (0.8, 0.8, 0.1, 0.1), (0.1, 0.1, 0.1, 0.5)],
        "e float, d float, a float, v float",
    )
    rule = k.music_category(F.col("e"), F.col("d"), F.col("a"), F.col("v"))
    assert [r[0] for r in df.select(rule).collect()] == ["Positive", "High Energy Dance", "Balanced"]
    levels = df.select(k.level3(F.col("e"))).collect()
    assert [r[0] for r in levels] == ["Medium", "High", "Low"]


def test_music_category_order(spark):
    rows = [(0.9, 0.1, 0.9, 0.9), (0.1, 0.9, 0.9, 0.9), (0.1, 0.1, 0.9, 0.9), (0.1, 0.1, 0.1, 0.1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, e float, d float, a float, v float")
    rule = k.music_category(F.col("e"), F.col("d"), F.col("a"), F.col("v"))
    got = [r[0] for r in df.orderBy("i").select(rule).collect()]
    assert got == ["High Energy", "Dance", "Acoustic", "Melancholic"]


def test_counts_and_durations(values):
    assert values(k.artist_tier, [50, 49, 20, 19, 10, 9, 0], "int") == [
        "Prolific (50+)", "Active (20-50)", "Active (20-50)", "Regular (10-20)",
        "Regular (10-20)", "Emerging (<10)", "Emerging (<10)",
    ]
    assert values(k.album_type, [12, 11, 6, 5, 2, 1], "int") == [
        "Full Album (12+)", "EP (6-12)", "EP (6-12)", "Single/Duo (2-5)", "Single/Duo (2-5)",
        "Single (1)",
    ]
    assert values(k.duration_category, [119_999, 120_000, 180_000, 240_000, 300_000], "int") == [
        "Very Short (<2min)", "Short (2-3min)", "Medium (3-4min)", "Long (4-5min)",
        "Very Long (>5min)",
    ]
    assert values(k.tempo4, [89.9, 90.0, 120.0, 150.0], "double") == [
        "Slow", "Medium", "Fast", "Very Fast",
    ]


def test_season_and_explicit(values):
    assert values(k.season, list(range(1, 13)), "int") == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    )
    assert values(k.explicit_label, [True, False, None], "boolean") == [
        "Explicit", "Non-Explicit", None,
    ]
