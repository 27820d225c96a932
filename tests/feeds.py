"""Small hand-written feeds."""

from __future__ import annotations

from chartmart.sources.feed import FEED_COLUMNS, SEQ

DEFAULTS = dict.fromkeys(FEED_COLUMNS) | {
    "spotify_id": "s1",
    "name": "Song",
    "artists": "A, B",
    "daily_rank": "1",
    "country": "VN",
    "snapshot_date": "2024-12-30",
    "popularity": "80",
    "is_explicit": "True",
    "duration_ms": "200000",
    "album_name": "Album",
    "album_release_date": "2024-01-02",
    "energy": "0.7",
    "danceability": "0.6",
    "valence": "0.5",
    "tempo": "100",
    "acousticness": "0.1",
}


def feed(spark, *rows: dict):
    schema = ", ".join(f"{c} string" for c in FEED_COLUMNS) + f", {SEQ} bigint"
    data = [
        tuple({**DEFAULTS, **row}[c] for c in FEED_COLUMNS) + (i,) for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(data, schema)
