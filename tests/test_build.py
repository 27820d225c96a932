"""Transform, dimensions and facts on small feeds."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from chartmart.plans import facts
from chartmart.plans.transform import transform
from chartmart.plans.warehouse import build_warehouse, write_warehouse
from chartmart.plans import rules
from tests.feeds import feed


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_incomplete_rows_go(spark):
    out = transform(
        feed(
            spark,
            {},
            {"spotify_id": None},
            {"spotify_id": ""},
            {"name": "  "},
            {"snapshot_date": "bad"},
        )
    )
    assert out.count() == 1


def test_dedupe_keeps_the_first_and_counts_nulls_as_equal(spark):
    out = transform(
        feed(
            spark,
            {"country": None, "popularity": "10"},
            {"country": None, "popularity": "20"},
            {"country": "", "popularity": "30"},
            {"artists": "C", "popularity": "40"},
        )
    )
    assert rows(out, "artists", "popularity") == [("A, B", 10), ("C", 40)]


def test_defaults_and_truncation(spark):
    out = transform(
        feed(spark, {"daily_rank": "2.9", "popularity": "101", "key": "12", "mode": None, "tempo": "29"})
    ).first()
    assert (out.daily_rank, out.popularity, out.key, out.mode, out.tempo) == (2, 50, 0, 1, 120.0)


def test_first_row_wins_per_grain_but_all_artists_count(spark):
    t = build_warehouse(
        feed(
            spark,
            {"artists": "A, B, A", "popularity": "80"},
            {"artists": "C", "popularity": "10"},
        )
    )
    assert rows(t["fact_song_daily"], "popularity_score") == [(80,)]
    stats = t["fact_artist_stats"].join(t["dim_artist"], "artist_key")
    assert rows(stats, "artist_name", "artist_position", "song_popularity") == [
        ("A", 1, 80), ("B", 2, 80), ("C", 1, 10),
    ]


def test_missing_country_meets_the_default_member(spark):
    t = build_warehouse(feed(spark, {"country": None}, {"country": ""}, {"spotify_id": "s2"}))
    joined = t["fact_song_daily"].join(t["dim_country"], "country_key")
    assert rows(joined, "country_code", "country_name") == [("GLOBAL", "Global"), ("VN", "VN")]


def test_a_country_called_global_keeps_its_name(spark):
    t = build_warehouse(feed(spark, {"country": "GLOBAL"}))
    assert rows(t["dim_country"], "country_code", "country_name") == [("GLOBAL", "GLOBAL")]


def test_dim_date(spark):
    day = build_warehouse(feed(spark, {}))["dim_date"].first()
    assert day.full_date == dt.date(2024, 12, 30)
    assert (day.year, day.quarter, day.month, day.day, day.week_of_year) == (2024, 4, 12, 30, 1)
    assert (day.month_name, day.day_of_week, day.day_name) == ("December", 0, "Monday")
    assert (day.is_weekend, day.season) == (False, "Winter")


def test_albums_without_a_date_are_one_album(spark):
    t = build_warehouse(
        feed(
            spark,
            {"album_release_date": None},
            {"spotify_id": "s2", "album_release_date": "bad"},
            {"spotify_id": "s3", "album_name": None},
        )
    )
    assert rows(t["dim_album"], "album_name", "release_date") == [("Album", None)]
    named = t["fact_song_daily"].join(t["dim_album"], "album_key", "left")
    assert rows(named, "album_name") == [("Album",), ("Album",), (None,)]


def test_song_attributes_stay_as_first_seen(spark):
    t = build_warehouse(
        feed(
            spark,
            {"name": "Old", "energy": "0.1", "snapshot_date": "2024-02-02"},
            {"name": "New", "energy": "0.9", "snapshot_date": "2024-01-01"},
        )
    )
    song = t["dim_song"].first()
    assert (song.song_name, song.created_at.date()) == ("Old", dt.date(2024, 1, 1))
    assert [round(r.energy, 4) for r in t["fact_audio_analysis"].collect()] == [0.1]


def test_zero_energy_is_medium_but_stored_as_zero(spark):
    t = build_warehouse(feed(spark, {"energy": "0.0"}))
    row = t["fact_audio_analysis"].join(t["dim_audio_features"], "features_key").first()
    assert (row.energy, row.energy_level) == (0.0, "Medium")


def test_keys_by_hash_and_by_lookup_agree(spark):
    source = feed(
        spark,
        {},
        {"country": None, "album_release_date": None},
        {"spotify_id": "s2", "album_name": None},
    )
    clean = transform(source)
    t = build_warehouse(source)
    cols = ["song_key", "date_key", "country_key", "album_key", "features_key"]
    assert rows(facts.resolve_keys(clean), *cols) == rows(facts.resolve_keys(clean, t), *cols)


def test_lookup_drops_unknown_songs_and_keeps_unknown_albums(spark):
    source = feed(spark, {}, {"spotify_id": "s2", "album_name": "Other", "country": "XX"})
    t = dict(build_warehouse(source))
    t["dim_song"] = t["dim_song"].filter("spotify_id = 's2'")
    t["dim_album"] = t["dim_album"].filter("album_name = 'Album'")
    t["dim_country"] = t["dim_country"].filter("country_code <> 'XX'")
    got = facts.resolve_keys(transform(source), t).join(t["dim_country"], "country_key")
    assert [(r.spotify_id, r.album_key, r.country_name) for r in got.collect()] == [
        ("s2", None, "Global")
    ]


def test_facts(spark):
    t = build_warehouse(feed(spark, {"daily_rank": "x", "daily_movement": "4", "weekly_movement": None}))
    daily = t["fact_song_daily"].first()
    assert (daily.daily_rank, daily.rank_points, daily.performance_index) == (
        100, Decimal("1.00"), Decimal("40.50"),
    )
    chart = t["fact_chart_position"].first()
    assert (chart.current_rank, chart.previous_rank, chart.is_rising, chart.is_falling) == (
        100, 96, True, False,
    )
    streams = t["fact_streaming_metrics"].first()
    assert (streams.estimated_streams, streams.estimated_listeners) == (10_000, 6_000)


def test_written_tables_equal_the_plans_and_pass_the_rules(spark, tmp_path):
    source = feed(
        spark,
        *[
            {"spotify_id": f"s{i % 4}", "country": ["VN", "KR", None][i % 3], "snapshot_date": f"2024-0{1 + i % 3}-11"}
            for i in range(24)
        ],
    )
    lazy = build_warehouse(source)
    for _ in range(2):
        written = write_warehouse(source, str(tmp_path / "wh"))
    for name, table in lazy.items():
        assert rows(table, *table.columns) == rows(written[name], *table.columns), name
    for check in (
        rules.value_violations,
        rules.column_violations,
        rules.unique_violations,
        rules.reference_violations,
    ):
        assert check(written).agg(F.sum("violations")).first()[0] == 0


def test_large_values_are_kept(spark):
    row = {"daily_rank": "100000000", "daily_movement": "2000000000", "duration_ms": "5000000000"}
    t = build_warehouse(feed(spark, row))
    daily, moved = t["fact_song_daily"].first(), t["fact_chart_position"].first()
    assert daily.daily_rank == 100_000_000 and float(daily.rank_points) == 101 - 100_000_000
    assert moved.daily_movement == 2_000_000_000 and moved.movement_magnitude >= 2_000_000_000
    assert t["dim_song"].first().duration_ms == 5_000_000_000
