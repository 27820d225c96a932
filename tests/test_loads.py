"""Rollups, rejected rows, rebuilds and loads that fail or meet."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from chartmart.plans import dims, marts, rejects, warehouse
from chartmart.plans.transform import clean_rows
from chartmart.plans.warehouse import build_warehouse, open_warehouse, write_warehouse
from chartmart.sources import folders
from chartmart.sources.tables import MARTS, SCHEMAS, create_missing, read_table
from chartmart.streaming.ingest import load_batch
from tests.feeds import feed


def bag(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


def charts(n=80):
    """Songs in several countries on several days, some at number one, some without artists."""
    return [
        {
            "spotify_id": f"s{i % 7}",
            "name": f"Song {i % 3}",
            "artists": ["A", "B, A", "C, D, A", ""][i % 4],
            "country": ["VN", "KR", "", "US", "FR"][i % 5],
            "snapshot_date": f"2024-0{1 + i % 3}-0{1 + i // 20}",
            "daily_rank": str(1 + i % 4),
            "popularity": str(i),
            "album_name": ["X", "Y", ""][i % 3],
        }
        for i in range(n)
    ]


# --- rollups ----------------------------------------------------------------------


def test_rollups_equal_the_joined_rows(spark):
    t = build_warehouse(feed(spark, *charts()))
    for name in ("fact_song_daily", "fact_artist_stats"):
        t[name].createOrReplaceTempView(name)
    day = spark.sql(
        """SELECT s.song_key, s.date_key, count(*) AS n, sum(popularity_score) AS p,
             sum(daily_rank) AS r, max(popularity_score) AS m, any_value(coalesce(w, 1)) AS w,
             any_value(coalesce(l, array())) AS l, any_value(s.snapshot_date) AS d,
             any_value(s.snapshot_month) AS mo
           FROM fact_song_daily s LEFT JOIN (SELECT song_key, date_key, count(*) AS w,
             array_sort(collect_set(artist_key)) AS l FROM fact_artist_stats GROUP BY 1, 2) a
           ON s.song_key = a.song_key AND s.date_key = a.date_key GROUP BY s.song_key, s.date_key"""
    )
    assert bag(marts.rollup(t, "agg_song_day")) == bag(day)
    month = spark.sql(
        """SELECT s.song_key, country_key, album_key, count(*) AS fan, sum(popularity_score) AS p,
             sum(daily_rank) AS r, array_sort(collect_set(artist_key)) AS l,
             count_if(daily_rank = 1) AS firsts,
             array_sort(collect_set(CASE WHEN daily_rank = 1 THEN artist_key END)) AS first_l,
             array_sort(collect_set(CASE WHEN daily_rank = 1 THEN s.snapshot_date END)) AS first_d,
             s.snapshot_month
           FROM fact_song_daily s LEFT JOIN (SELECT song_key, date_key, artist_key
             FROM fact_artist_stats) a ON s.song_key = a.song_key AND s.date_key = a.date_key
           GROUP BY ALL"""
    )
    got = marts.rollup(t, "agg_song_month").select(
        *("song_key", "country_key", "album_key", "fan", "fan_popularity_score", "fan_daily_rank"),
        *("artists", "number_one_fan", "number_one_artists", "number_one_days", "snapshot_month"),
    )
    assert bag(got) == bag(month)


def test_stored_rollups_equal_planned_ones_and_refresh_touches_its_months(spark, tmp_path):
    path, t = str(tmp_path / "wh"), build_warehouse(feed(spark, *charts()))
    written = write_warehouse(feed(spark, *charts()), path)
    for name in MARTS:
        assert bag(written[name]) == bag(marts.rollup(t, name)), name
    files = lambda n: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "wh" / n).rglob("*.parquet")}
    before = files("agg_song_month")
    marts.refresh(spark, path, [dt.date(2024, 2, 1)])
    kept = {p for p, at in files("agg_song_month").items() if before.get(p) == at}
    assert kept == {p for p in before if "2024-02-01" not in p}
    for name in MARTS:
        assert bag(read_table(spark, path, name)) == bag(marts.rollup(t, name)), name


# --- rejected rows ------------------------------------------------------------------


def test_every_dropped_row_and_replaced_value_has_a_reason(spark):
    bad = [
        {},
        {"spotify_id": None},
        {"name": "  ", "popularity": "101"},
        {"snapshot_date": "some day"},
        {"popularity": "x", "tempo": "29", "mode": "major", "album_release_date": "31/31/2020"},
        {"popularity": "50", "key": "0", "daily_rank": "99999999999999999"},
        {"is_explicit": "maybe", "energy": "", "country": None, "liveness": "NaN"},
    ]
    rows = rejects.judged(feed(spark, *bad))
    assert bag(rejects.kept(rows)) == bag(clean_rows(feed(spark, *bad)))
    found = {tuple(r.reasons): r.dropped for r in rejects.quarantine(rows).collect()}
    assert found == {
        ("spotify_id: ",): True,
        ("name:   ", "popularity: 101"): True,
        ("snapshot_date: some day",): True,
        ("popularity: x", "album_release_date: 31/31/2020", "mode: major", "tempo: 29"): False,
        ("daily_rank: 99999999999999999",): False,
        ("is_explicit: maybe", "liveness: NaN"): False,
    }
    assert tuple(rejects.counts(rows).first()) == (7, 4, 3, 3, 7)
    assert tuple(rejects.counts(rows.limit(0)).first()) == (0, 0, 0, 0, 0)


def test_a_repeated_batch_replaces_its_rejects(spark, tmp_path):
    path = str(tmp_path / "wh")
    create_missing(spark, path)
    source = feed(spark, *charts(), {"name": None}, {"popularity": "-1"})
    for batch in ("0", "1", "0"):
        load_batch(source, path, "me", batch)
    loads = rejects.read(spark, path, "loads")
    assert bag(loads) == [(82, 81, 1, 1, 1, "me-0"), (82, 81, 1, 1, 1, "me-1")]
    assert rejects.read(spark, path, "quarantine").count() == 4
    assert not folders.exists(spark, f"{path}/_stage/me-0")
    t = build_warehouse(source)
    for name in SCHEMAS:
        cols = [c for c in t[name].columns if c != "created_at"]
        assert bag(read_table(spark, path, name), *cols) == bag(t[name], *cols), name


# --- loads that fail or meet ----------------------------------------------------------


def _sizes(spark, path):
    return {name: df.count() for name, df in open_warehouse(spark, path).items()}


@pytest.mark.parametrize("failing", ["dim_album", "agg_artist_month"])
def test_a_rebuild_that_fails_leaves_the_old_tables(spark, tmp_path, monkeypatch, failing):
    path = str(tmp_path / "wh")
    write_warehouse(feed(spark, *charts()), path)
    before = _sizes(spark, path)
    broken = lambda *_: spark.range(1).select(F.raise_error(F.lit("broken")))
    for builders in (warehouse._DIM_BUILDERS, warehouse._KEYED_FACTS, marts.BUILDERS):
        if failing in builders:
            monkeypatch.setitem(builders, failing, broken)
    with pytest.raises(Exception, match="broken|snapshot_month"):
        write_warehouse(feed(spark, {"spotify_id": "new"}), path)
    monkeypatch.undo()
    assert _sizes(spark, path) == before and not folders.exists(spark, f"{path}/_build")
    write_warehouse(feed(spark, {"spotify_id": "new"}), path)
    assert _sizes(spark, path)["dim_song"] == 1 and not folders.exists(spark, f"{path}/_old")


def test_a_move_that_fails_goes_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "wh")
    write_warehouse(feed(spark, *charts()), path)
    before, move, calls = _sizes(spark, path), folders.move, []

    def failing(spark, old, new):
        calls.append(new)
        if new == f"{path}/fact_song_daily" and calls.count(new) == 1:
            raise OSError("stuck")
        move(spark, old, new)

    monkeypatch.setattr(folders, "move", failing)
    with pytest.raises(OSError, match="stuck"):
        write_warehouse(feed(spark, {"spotify_id": "new"}), path)
    assert _sizes(spark, path) == before


def _colliding(monkeypatch):
    """Song keys that are the same for all songs."""
    build = dims.dim_song
    same = lambda clean: build(clean).withColumn("song_key", F.lit(1).cast("bigint"))
    monkeypatch.setitem(warehouse._DIM_BUILDERS, "dim_song", same)


def test_colliding_keys_stop_a_batch_before_it_writes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "wh")
    _colliding(monkeypatch)
    write_warehouse(feed(spark, {"spotify_id": "s0"}), path)
    before = _sizes(spark, path)
    with pytest.raises(ValueError, match="dim_song"):
        load_batch(feed(spark, {"spotify_id": "s9", "country": "XX"}), path, "me", "1")
    with pytest.raises(ValueError, match="dim_song"):
        write_warehouse(feed(spark, {"spotify_id": "s8"}, {"spotify_id": "s9"}), path)
    assert _sizes(spark, path) == before
    monkeypatch.undo()


def test_loads_take_turns(spark, tmp_path):
    path = str(tmp_path / "wh")
    create_missing(spark, path)
    source = feed(spark, *charts())
    failed = []

    def load(owner):
        try:
            load_batch(source, path, owner, "0")
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    loads = [threading.Thread(target=load, args=(f"owner{i}",)) for i in range(2)]
    for thread in loads:
        thread.start()
    for thread in loads:
        thread.join()
    t = build_warehouse(source)
    assert not failed
    assert _sizes(spark, path) == {n: marts.rollup(t, n).count() for n in (*SCHEMAS, *MARTS)}


def test_an_owner_finds_its_own_lock_and_others_wait(spark, tmp_path):
    path = str(tmp_path)
    with folders.exclusive(spark, path, "a"):
        with pytest.raises(TimeoutError, match="'a'"):
            with folders.exclusive(spark, path, "b", wait=0.2, pause=0.05):
                pass
        with folders.exclusive(spark, path, "a", wait=0):
            pass
    with folders.exclusive(spark, path, "b", wait=0):
        pass
    assert not folders.exists(spark, f"{path}/_lock")
