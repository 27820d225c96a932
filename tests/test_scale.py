"""Steps that many queries share: what they read and shuffle, and that results stay the same."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from chartmart.functions import clean as c
from chartmart.plans import facts, marts, rejects
from chartmart.plans.transform import clean_rows
from chartmart.plans.warehouse import OnDemandWarehouse, write_warehouse
from chartmart.session import using_conf
from chartmart.sources import folders
from chartmart.sources.feed import file_order, read_feed, with_file_numbers
from chartmart.sources.tables import create_missing, read_table
from chartmart.streaming import ingest
from checks import files
from checks.trade_feed import _sold, chart_feed
from tests.feeds import feed


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _trade(spark, path: str) -> None:
    tables = {
        "customer": ([(1, 5), (2, 7)], "c_custkey long, c_nationkey int"),
        "orders": (
            [(1, 1, dt.date(1995, 1, 3)), (2, 2, dt.date(1995, 1, 9))],
            "o_orderkey long, o_custkey long, o_orderdate date",
        ),
        "lineitem": (
            [(1, 53, 2.0), (1, 53, 3.0), (1, 60, 9.0), (2, 60, 1.0), (None, 53, 1.0)],
            "l_orderkey long, l_partkey long, l_quantity double",
        ),
        "part": (
            [(53, "red", "B1", 1), (60, "blue", None, 2), (61, "unsold", "B2", 3)],
            "p_partkey long, p_name string, p_brand string, p_size int",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")


def test_feed_ranks_staged_quantities(spark, tmp_path):
    _trade(spark, str(tmp_path))
    got = chart_feed(spark, str(tmp_path), str(tmp_path / "stage"))
    assert "lineitem" not in _plan(got)  # joined and summed up once, not once for each use in ranking
    columns = ("spotify_id", "name", "country", "snapshot_date", "daily_rank", "popularity", "album_name")
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == [
        ("T53", "red 53", "N5", "1995-01-01", "2", "7", "B1"),
        ("T53", "red 53", "N5", "1995-01-01", "2", "8", "B1"),
        ("T60", "blue 60", "N5", "1995-01-01", "1", "13", None),
        ("T60", "blue 60", "N7", "1995-01-06", "1", "5", None),
    ]


def test_plain_days_are_cast(spark):
    cells = [
        "2024-02-29", " 2023-11-05 ", "2023-02-29", "2023-13-01", "0001-01-01", "0000-01-01", "1582-10-10",
        "1000-01-01", "9999-12-31", "2024-1-2", "2024-01-02T03:04", "2024-01-02 Z", "2024-00-10", "", "  ", None,
    ]
    df = spark.createDataFrame([(x,) for x in cells], "x string")
    by_pattern = c.clean_date(F.col("x"), list(c.DATE_PATTERNS))  # without the cast
    day, want = (col.cast("string") for col in (c.clean_date(F.col("x")), by_pattern))
    rows = df.select(day.alias("day"), want.alias("want")).collect()
    assert [r.day for r in rows] == [r.want for r in rows]
    assert [r.day for r in rows[:3]] == ["2024-02-29", "2023-11-05", None]
    assert "RLIKE" in str(c.clean_date(F.col("x"))).upper()


def test_first_load_joins_nothing(spark, tmp_path, monkeypatch):
    met = []

    def noted(existing, *args, **kwargs):
        met.append(existing)
        return append(existing, *args, **kwargs)

    append = ingest.append_new
    monkeypatch.setattr(ingest, "append_new", noted)
    path = str(tmp_path / "wh")
    create_missing(spark, path)
    rows = [{"spotify_id": f"s{i}", "snapshot_date": "2024-01-02"} for i in range(3)]
    ingest.load_batch(feed(spark, *rows), path, "o", "1")
    assert met and all(table is None for table in met)
    met.clear()
    rows.append({"spotify_id": "s9", "snapshot_date": "2024-01-05"})
    ingest.load_batch(feed(spark, *rows), path, "o", "2")
    assert all(table is not None for table in met)
    for name in ("fact_song_daily", "fact_chart_position", "fact_streaming_metrics"):
        assert read_table(spark, path, name).count() == 4
    assert read_table(spark, path, "dim_song").count() == 4


def test_song_months_shuffle_once(spark, tmp_path):
    rows = [{"spotify_id": f"s{i % 3}", "country": f"C{i}"} for i in range(9)]
    tables = write_warehouse(feed(spark, *rows), str(tmp_path))
    with using_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):  # as for large tables
        planned = marts.song_months({**tables})
        assert _plan(planned).count("Exchange hashpartitioning") == 1
    kept = tables["agg_song_month"]
    assert sorted(map(str, planned.collect())) == sorted(map(str, kept.select(*planned.columns).collect()))
    assert planned.agg(F.sum("fan")).first()[0] == 9 * 6  # three countries with two artists each per day


def test_rollups_shuffle_their_facts_once(spark, tmp_path):
    rows = [
        {
            "spotify_id": f"s{i % 30}",
            "country": f"C{i % 4}",
            "snapshot_date": ("2024-12-30", "2025-01-01")[i % 2],
            "artists": "A, B" if i % 3 else "",
        }
        for i in range(300)
    ]
    with using_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        tables = write_warehouse(feed(spark, *rows), str(tmp_path))
    for name in ("agg_song_day", "agg_artist_month"):
        planned = marts.BUILDERS[name]({**tables})
        assert _plan(planned).count("Exchange") == 1 and "hashpartitioning(snapshot_month" in _plan(planned)
        assert _cells(planned) == _cells(tables[name].select(*planned.columns))
        # Written where they were grouped, without another shuffle to their months.
        assert 2 < len(tables[name].inputFiles()) <= 2 * facts.SHARES, name
    days = tables["fact_song_daily"].groupBy("song_key", "date_key").agg(F.count("rank_points").alias("n"))
    assert _cells(tables["agg_song_day"].select("song_key", "date_key", "n")) == _cells(days)
    listed = tables["fact_artist_stats"].groupBy("artist_key", "song_key", "country_key", "snapshot_month")
    sums = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("song_popularity"), F.sum("artist_score"))
    kept = tables["agg_artist_month"].select(
        *listed.count().columns[:4], "n", "sum_song_popularity", "sum_artist_score"
    )
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, sums.collect()))


def test_reasons_are_told_in_generated_code(spark):
    # A lambda over the reasons would have every test of every cell interpreted.
    source = feed(spark, {"tempo": "29", "popularity": "x", "album_release_date": "bad"}, {}, {"name": " "})
    for rows in (rejects.cleaned(source), rejects.judged(source)):
        plan = rows._jdf.queryExecution().optimizedPlan()
        assert "ArrayFilter" not in plan.toJSON()
        assert [r[0] for r in rows.select(rejects.REASONS).collect()] == [
            ["popularity: x", "album_release_date: bad", "tempo: 29"],
            [],
            ["name:  "],
        ]


def test_chart_rows_leave_the_input_order(spark):
    rows = facts.chart_rows(facts.resolve_keys(clean_rows(feed(spark, {}, {"popularity": "3"}))))
    assert "_seq" not in rows.columns
    assert [r.popularity for r in rows.collect()] == [80]


def _cells(df):
    return sorted(map(str, df.collect()))


def test_cells_are_parsed_once_for_reasons_and_rules(spark):
    rows = [
        {},
        {"spotify_id": None},
        {"snapshot_date": "some day", "popularity": "1d"},
        {"popularity": "x", "tempo": "29", "mode": "major", "album_release_date": "2/13/2020"},
        {"mode": "0.4", "energy": "Infinity", "liveness": "NaN", "is_explicit": "maybe", "name": "  a \t b "},
        {"popularity": " ", "country": None, "artists": None, "mode": None, "album_release_date": "bad"},
    ]
    source = feed(spark, *rows)
    once, twice = rejects.cleaned(source), rejects.judged(source)
    for part in (rejects.kept, rejects.quarantine, rejects.counts):
        assert part(once).columns == part(twice).columns
        assert _cells(part(once)) == _cells(part(twice))


def test_numbers_with_letters_are_none(values):
    cells = ["1", " 2.5 ", "1e3", "1d", "1F", "0x1p0", "Infinity", "inf", "", "_", "-.5", "x", None]
    old = values(lambda x: F.translate(x, "dDfFxXpP", "________").try_cast("double"), cells)
    assert values(c.to_number, cells) == old == [1, 2.5, 1000, *[None] * 7, -0.5, None, None]


def test_order_keeps_numbers_of_files_for_their_paths(spark):
    at = [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1), None]
    places = [(s, at[i % 3], f"p{i % 2}", i % 5, i) for i in range(30) for s in (i % 2, None)]
    kind = "_seq struct<seq: bigint, arrived: timestamp, path: string, block: bigint, row: bigint>"
    rows = spark.createDataFrame([(p,) for p in places], kind).withColumn("old", F.col("_seq"))
    short = with_file_numbers(rows, file_order(rows))
    assert short.schema["_seq"].dataType.names == ["seq", "file", "block", "row"]
    assert short.count() == len(places)
    first, second = ([r.old for r in short.orderBy(name).collect()] for name in ("_seq", "old"))
    assert first == second
    assert file_order(feed(spark, {})) is None


def test_only_months_with_new_rows_get_new_rollups(spark, tmp_path, monkeypatch):
    made = []

    def noted(session, where, months=None):
        made.append(months)
        if broken:
            raise OSError("broken")
        refresh(session, where, months)

    broken, refresh = False, marts.refresh
    monkeypatch.setattr(marts, "refresh", noted)
    path = str(tmp_path / "wh")
    create_missing(spark, path)
    rows = [{"spotify_id": f"s{i}", "snapshot_date": f"2024-0{1 + i}-02"} for i in range(3)]
    january, february, march = (dt.date(2024, m, 1) for m in (1, 2, 3))
    ingest.load_batch(feed(spark, *rows), path, "o", "1")
    assert made == [[january, february, march]]
    ingest.load_batch(feed(spark, *rows), path, "o", "2")
    assert len(made) == 1
    broken = True
    rows.append({"spotify_id": "s9", "snapshot_date": "2024-02-05"})
    with pytest.raises(OSError, match="broken"):
        ingest.load_batch(feed(spark, *rows), path, "o", "3")
    broken = False
    ingest.load_batch(feed(spark, {"spotify_id": "s9", "snapshot_date": "2024-03-05"}), path, "p", "1")
    assert made[1:] == [[february], [february, march]]
    tables = {name: read_table(spark, path, name) for name in marts.FACTS}
    for name in marts.BUILDERS:
        assert _cells(read_table(spark, path, name)) == _cells(marts.rollup(tables, name)), name


_FAR = {"spark.sql.autoBroadcastJoinThreshold": "-1"}  # as for large tables


def test_lines_travel_once_to_their_orders(spark, tmp_path):
    _trade(spark, str(tmp_path))
    with using_conf(spark, _FAR):
        sold = _sold(spark, str(tmp_path))
        assert _plan(sold).count("hashpartitioning(l_orderkey") == 1
        assert sorted(map(tuple, sold.collect())) == [(53, 5, 0, 5), (60, 5, 0, 9), (60, 7, 5, 1)]


def test_facts_are_grouped_and_written_in_one_shuffle(spark, tmp_path):
    rows = [{"spotify_id": f"s{i % 40}", "country": f"C{i % 3}", "popularity": str(i % 90)} for i in range(240)]
    keyed = facts.resolve_keys(clean_rows(feed(spark, *rows)))
    for build, n in ((facts.chart_rows, 120), (facts.fact_artist_stats, 240)):
        plan = _plan(build(keyed))
        assert plan.count("Exchange") == 1 and "hashpartitioning(snapshot_month" in plan
        assert build(keyed).count() == n
    with using_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        path = str(tmp_path / "wh")
        write_warehouse(feed(spark, *rows), path)
    for name in ("fact_song_daily", "fact_artist_stats", "agg_song_month"):
        files = read_table(spark, path, name).inputFiles()
        assert 1 < len(files) <= facts.SHARES, name  # a month is shared out, and not to every task


def test_song_months_are_made_of_facts_alone(spark, tmp_path):
    rows = [
        {"spotify_id": f"s{i % 5}", "country": f"C{i % 4}", "daily_rank": str(1 + i % 3), "artists": "A, B" if i % 2 else ""}
        for i in range(60)
    ]
    whole = write_warehouse(feed(spark, *rows), str(tmp_path / "whole"))
    asked = []

    def source():
        asked.append(1)
        return feed(spark, *rows)

    lazy = OnDemandWarehouse(spark, str(tmp_path / "lazy"), source)
    months = lazy["agg_song_month"]
    assert _cells(months) == _cells(whole["agg_song_month"])
    assert not (tmp_path / "lazy" / "agg_song_day").exists()
    assert not (tmp_path / "lazy" / "_stage" / "feed").exists()  # clean rows come straight from its plan
    assert asked == [1]
    for name in ("fact_song_daily", "fact_chart_position", "fact_artist_stats", "agg_song_day"):
        assert _cells(lazy[name]) == _cells(whole[name]), name


def test_plain_text_is_kept_without_a_search(spark, values):
    cells = [
        "a", "a b", "a  b", " a", "a ", "", " ", "a\tb", "a\n", "\x1ca", "a\u00a0b", "\u3000", "\u00e9  x", "\u00e9", "a\x00b",
        "a\x7fb", "~!", None,
    ]
    old = values(lambda x: F.nullif(F.trim(F.regexp_replace(x, c._SPACES, " ")), F.lit("")), cells)
    assert values(c.clean_text, cells) == old
    assert "CASEWHEN" in str(c.clean_text(F.col("x"))).upper().replace(" ", "")


def _made(df) -> str:
    """The plan as it was run."""
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


def test_rollups_share_one_shuffle_of_the_facts(spark, tmp_path):
    rows = [
        {"spotify_id": f"s{i % 7}", "country": f"C{i % 4}", "artists": "A, B" if i % 3 else "", "popularity": str(i)}
        for i in range(60)
    ]
    tables = write_warehouse(feed(spark, *rows), str(tmp_path))
    with using_conf(spark, marts.ONE_SHUFFLE):
        made = marts.together(tables)
        plan = _made(made)
    assert plan.count("Exchange hashpartitioning") == 1 + plan.count("ReusedExchange") == 3
    for name in marts.BUILDERS:
        kept = tables[name].drop("_rollup")
        assert _cells(made.filter(F.col("_rollup") == name).select(*kept.columns)) == _cells(kept), name
        assert _cells(marts.rollup({n: tables[n] for n in marts.FACTS}, name).select(*kept.columns)) == _cells(kept)


def test_known_rows_are_met_in_the_shuffle_of_new_ones(spark, tmp_path, monkeypatch):
    joined = []
    append = ingest.append_new
    monkeypatch.setattr(
        ingest, "append_new", lambda old, new, keys, **how: joined.append(tuple(keys)) or append(old, new, keys, **how)
    )
    old = [
        {"spotify_id": f"s{i % 5}", "country": f"C{i % 3}", "artists": "A, B", "popularity": str(i)} for i in range(20)
    ]
    new = [
        {"spotify_id": "s1", "country": "C1", "artists": "C, A", "popularity": "99"},  # a known row, a new artist
        {"spotify_id": "s9", "country": "C1", "artists": "A", "popularity": "7"},
        {"spotify_id": "s9", "country": "C1", "artists": "D", "popularity": "8"},
    ]
    path = str(tmp_path / "wh")
    create_missing(spark, path)
    ingest.load_batch(feed(spark, *old), path, "o", "1")
    joined.clear()
    ingest.load_batch(feed(spark, *new), path, "o", "2")
    assert facts.GRAIN not in joined and facts.ARTIST_GRAIN not in joined and len(joined) == 7
    whole = write_warehouse(feed(spark, *old, *new), str(tmp_path / "whole"))
    names = ("fact_song_daily", "fact_chart_position", "fact_streaming_metrics", "fact_artist_stats", *marts.BUILDERS)
    for name in names:
        assert _cells(read_table(spark, path, name)) == _cells(whole[name]), name
    # Facts that differ are met one by one, until the broken load is made up for.
    folders.remove(spark, f"{path}/fact_chart_position")
    create_missing(spark, path)
    joined.clear()
    ingest.load_batch(feed(spark, *old, *new), path, "o", "3")
    assert facts.GRAIN in joined
    for name in names:
        assert _cells(read_table(spark, path, name)) == _cells(whole[name]), name


def test_feed_files_are_compressed_and_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ROWS_PER_FILE", 4)
    rows = [{"spotify_id": f"s{i}", "name": 'a "b", c', "country": None} for i in range(10)]
    source = feed(spark, *rows).coalesce(1)
    for compressed, n in ((True, 3), (False, 1)):
        path = tmp_path / str(compressed)
        files.write_feed_csv(source, str(path), compressed=compressed)
        assert len(list(path.glob("*.csv.gz" if compressed else "*.csv"))) == n
        got = read_feed(spark, str(path))
        assert _cells(got.drop("_seq")) == _cells(source.drop("_seq"))
        assert sorted(r[0] for r in got.select("_seq.seq").collect()) == list(range(10))


def test_dimensions_of_a_load_are_staged_at_the_same_time(spark, tmp_path, monkeypatch):
    two, stage = threading.Barrier(2), ingest.materialise

    def meeting(rows, where, *args, **kwargs):
        if "/dim_" in where:
            two.wait(timeout=60)  # six dimensions: each finds another one
        return stage(rows, where, *args, **kwargs)

    monkeypatch.setattr(ingest, "materialise", meeting)
    path = str(tmp_path / "wh")
    create_missing(spark, path)
    ingest.load_batch(feed(spark, {}, {"spotify_id": "s2"}), path, "o", "1")
    assert read_table(spark, path, "dim_song").count() == 2
