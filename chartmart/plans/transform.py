"""From raw feed to clean rows: one projection, two row filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.functions import clean as c
from chartmart.functions.classify import feature_labels, mood_etl
from chartmart.operators.rows import first_per
from chartmart.sources.feed import SEQ

# Whole numbers the parsed double still holds exactly, with room for the measures made of them.
LARGEST = 10**14


@dataclass(frozen=True)
class Number:
    """Range and default of a number column; ``whole`` names the type that drops the fraction."""

    lo: float | None
    hi: float | None
    default: float | None
    whole: str | None = None

    def __call__(self, number: Column) -> Column:
        kept = c.in_range(number, self.lo, self.hi, self.default)
        return kept.cast(self.whole) if self.whole else kept


Rule = Callable[[Column], Column]

# Allowed ranges and defaults of the feed columns.
FEED_RULES: Mapping[str, Rule] = {
    "spotify_id": lambda col: F.nullif(col, F.lit("")),
    "name": c.clean_text,
    "artists": c.clean_text,
    "daily_rank": Number(1, LARGEST, None, whole="bigint"),
    "daily_movement": Number(-LARGEST, LARGEST, 0, whole="bigint"),
    "weekly_movement": Number(-LARGEST, LARGEST, 0, whole="bigint"),
    # Null until facts are keyed: only then the default member stands in.
    "country": c.clean_text,
    "snapshot_date": c.clean_date,
    "popularity": Number(0, 100, 50, whole="int"),
    "is_explicit": c.clean_boolean,
    "duration_ms": Number(0, LARGEST, 180_000, whole="bigint"),
    "album_name": c.clean_text,
    "album_release_date": c.clean_date,
    "danceability": Number(0, 1, 0.5),
    "energy": Number(0, 1, 0.5),
    "key": Number(0, 11, 0, whole="int"),
    "loudness": Number(-60, 0, -7),
    "mode": c.clean_mode,
    "speechiness": Number(0, 1, 0.05),
    "acousticness": Number(0, 1, 0.5),
    "instrumentalness": Number(0, 1, 0),
    "liveness": Number(0, 1, 0.1),
    "valence": Number(0, 1, 0.5),
    "tempo": Number(30, 250, 120),
    "time_signature": Number(3, 7, 4, whole="int"),
}

REQUIRED = ("spotify_id", "name", "snapshot_date")
FEED_KEY = ("spotify_id", "artists", "snapshot_date", "country")


def clean_feed(df: DataFrame, rules: Mapping[str, Rule] = FEED_RULES) -> DataFrame:
    """Every ruled column cleaned; other columns, such as the input order, pass through.

    Numbers are parsed in a projection of their own, so that range tests read
    a parsed number instead of parsing it again.
    """
    numbers = [n for n in df.columns if isinstance(rules.get(n), Number)]
    parsed = df.withColumns({n: c.to_number(F.col(n)) for n in numbers})
    return parsed.withColumns({n: rules[n](F.col(n)) for n in df.columns if n in rules})


def label_feed(df: DataFrame) -> DataFrame:
    """Adds the load-time mood and the five feature labels."""
    features = ("energy", "danceability", "valence", "acousticness", "tempo")
    return df.withColumns(
        {
            "mood_category": mood_etl(F.col("valence"), F.col("energy")),
            "feature_labels": feature_labels(*[F.col(f) for f in features]),
        }
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows with id, name and day."""
    return df.dropna(subset=list(REQUIRED))


def dedupe_feed(df: DataFrame) -> DataFrame:
    """First row per song, artist text, day and country; nulls count as equal."""
    return first_per(df, FEED_KEY, [SEQ])


def clean_rows(feed: DataFrame) -> DataFrame:
    """Cleaned and complete rows, still with repeats and without labels: needs no shuffle."""
    return drop_incomplete(clean_feed(feed))


def transform(feed: DataFrame) -> DataFrame:
    """The whole transform, without repeats.

    Tables are built from ``clean_rows``: each keeps the first row of its own,
    coarser grain, so removing repeats here first would change nothing there.
    """
    return dedupe_feed(label_feed(clean_rows(feed)))
