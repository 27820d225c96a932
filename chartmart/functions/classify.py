"""Label rules, as Column expressions. First match wins everywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and cut points that stored and reported labels depend on.
LEVEL5 = ("Very High", "High", "Medium", "Low", "Very Low")
VALENCE5 = ("Very Positive", "Positive", "Neutral", "Negative", "Very Negative")
TEMPO5 = ("Very Fast", "Fast", "Moderate", "Slow", "Very Slow")
CUTS5 = (0.8, 0.6, 0.4, 0.2)
TEMPO_CUTS5 = (140.0, 120.0, 90.0, 60.0)
LEVEL3 = ("Low", "Medium", "High")
ENERGY3 = ("Low Energy", "Medium Energy", "High Energy")
DANCE3 = ("Low Dance", "Medium Dance", "High Dance")
VALENCE3 = ("Sad", "Neutral", "Happy")
CUTS3 = (0.3, 0.7)
TEMPO4 = ("Slow", "Medium", "Fast", "Very Fast")
TEMPO_CUTS4 = (90.0, 120.0, 150.0)
ARTIST_TIERS = ("Prolific (50+)", "Active (20-50)", "Regular (10-20)", "Emerging (<10)")
ARTIST_TIER_CUTS = (50, 20, 10)
ALBUM_TYPES = ("Full Album (12+)", "EP (6-12)", "Single/Duo (2-5)", "Single (1)")
ALBUM_TYPE_CUTS = (12, 6, 2)
DURATIONS = (
    "Very Short (<2min)",
    "Short (2-3min)",
    "Medium (3-4min)",
    "Long (4-5min)",
    "Very Long (>5min)",
)
DURATION_CUTS = (120_000, 180_000, 240_000, 300_000)


def _first_match(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    (test, label), *rest = rules
    chain = F.when(test, label)
    for test, label in rest:
        chain = chain.when(test, label)
    return chain.otherwise(otherwise)


def at_least(x: Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the highest cut that ``x`` reaches; cuts run downwards."""
    return _first_match([(x >= cut, label) for cut, label in zip(cuts, labels)], labels[-1])


def below(x: Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the lowest cut that ``x`` stays under; cuts run upwards."""
    return _first_match([(x < cut, label) for cut, label in zip(cuts, labels)], labels[-1])


def _at_least_present(
    x: Column, cuts: Sequence[float], labels: Sequence[str], missing: str
) -> Column:
    # Load-time labels treat 0 as missing.
    rules = [(x >= cut, label) for cut, label in zip(cuts, labels)]
    return _first_match([(x.isNull() | (x == 0), missing), *rules], labels[-1])


# --- labels given while loading, on doubles ---------------------------------


def mood_etl(valence: Column, energy: Column) -> Column:
    strong = energy >= 0.6
    return _first_match(
        [
            ((valence >= 0.6) & strong, "Happy"),
            (valence >= 0.6, "Calm"),
            ((valence < 0.4) & strong, "Energetic"),
            (valence < 0.4, "Sad"),
        ],
        "Neutral",
    )


def level5(x: Column) -> Column:
    return _at_least_present(x, CUTS5, LEVEL5, missing="Medium")


def valence5(x: Column) -> Column:
    return _at_least_present(x, CUTS5, VALENCE5, missing="Neutral")


def tempo5(x: Column) -> Column:
    return _at_least_present(x, TEMPO_CUTS5, TEMPO5, missing="Fast")


FEATURE_LABELS = (
    "energy_level",
    "danceability_level",
    "valence_level",
    "tempo_category",
    "acousticness_level",
)


def feature_labels(
    energy: Column, danceability: Column, valence: Column, acousticness: Column, tempo: Column
) -> Column:
    """Struct of the five load-time labels."""
    labels = (
        level5(energy),
        level5(danceability),
        valence5(valence),
        tempo5(tempo),
        level5(acousticness),
    )
    return F.struct(*[label.alias(name) for label, name in zip(labels, FEATURE_LABELS)])


# --- labels given in queries, on stored float32 values ----------------------
# A comparison with a double literal widens the stored float, so a stored 0.6
# counts as above 0.6 and a stored 0.7 as below 0.7.


def level3(x: Column, labels: Sequence[str] = LEVEL3) -> Column:
    return below(x, CUTS3, labels)


def tempo4(x: Column) -> Column:
    return below(x, TEMPO_CUTS4, TEMPO4)


def music_category(
    energy: Column, danceability: Column, acousticness: Column, valence: Column
) -> Column:
    return _first_match(
        [
            ((energy > 0.7) & (danceability > 0.7), "High Energy Dance"),
            (energy > 0.7, "High Energy"),
            (danceability > 0.7, "Dance"),
            (acousticness > 0.5, "Acoustic"),
            (valence > 0.6, "Positive"),
            (valence < 0.4, "Melancholic"),
        ],
        "Balanced",
    )


def mood_trending(valence: Column, energy: Column) -> Column:
    return _first_match(
        [
            ((valence > 0.6) & (energy > 0.6), "Energetic"),
            (valence > 0.6, "Happy"),
            ((valence < 0.4) & (energy < 0.4), "Sad"),
        ],
        "Neutral",
    )


def mood_regional(valence: Column, energy: Column) -> Column:
    return _first_match(
        [
            ((valence > 0.6) & (energy > 0.6), "Happy & Energetic"),
            (valence > 0.6, "Happy"),
            (energy > 0.6, "Energetic"),
            (valence < 0.4, "Melancholic"),
        ],
        "Neutral",
    )


def mood_popularity(valence: Column, energy: Column) -> Column:
    return _first_match(
        [
            ((valence > 0.6) & (energy > 0.6), "Happy"),
            (valence > 0.6, "Calm"),
            ((valence < 0.4) & (energy > 0.6), "Energetic"),
            (valence < 0.4, "Sad"),
        ],
        "Neutral",
    )


def mood_strict(valence: Column, energy: Column) -> Column:
    return _first_match(
        [
            ((valence > 0.6) & (energy > 0.6), "Happy"),
            ((valence > 0.6) & (energy < 0.4), "Calm"),
            ((valence < 0.4) & (energy > 0.6), "Energetic"),
            ((valence < 0.4) & (energy < 0.4), "Sad"),
        ],
        "Neutral",
    )


def artist_tier(songs: Column) -> Column:
    return at_least(songs, ARTIST_TIER_CUTS, ARTIST_TIERS)


def album_type(songs: Column) -> Column:
    return at_least(songs, ALBUM_TYPE_CUTS, ALBUM_TYPES)


def duration_category(ms: Column) -> Column:
    return below(ms, DURATION_CUTS, DURATIONS)


def season(month: Column) -> Column:
    return _first_match(
        [
            (month.isin(12, 1, 2), "Winter"),
            (month.between(3, 5), "Spring"),
            (month.between(6, 8), "Summer"),
        ],
        "Fall",
    )


def explicit_label(flag: Column) -> Column:
    return F.when(flag, "Explicit").when(~flag, "Non-Explicit")
