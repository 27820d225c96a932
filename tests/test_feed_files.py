"""CSV feeds: headers, quoting, input order, streams and incremental loads."""

from __future__ import annotations

import csv
import os

import pytest
from pyspark.sql import functions as F

from chartmart.plans import marts, rejects
from chartmart.plans.warehouse import build_warehouse
from chartmart.session import using_conf
from chartmart.sources.feed import FEED_COLUMNS, PANDAS_NULL_TOKENS, SEQ, read_feed
from chartmart.sources.tables import MARTS, SCHEMAS, export_csv, read_table
from chartmart.streaming.ingest import start_ingest
from tests.feeds import DEFAULTS


def write_csv(path, rows, columns=FEED_COLUMNS):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(columns)
        for row in rows:
            filled = {**DEFAULTS, **row}
            writer.writerow([filled.get(c) for c in columns])


def bag(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_columns_are_taken_by_name(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [{"name": 'say "hi", you\ntwo lines'}], [*reversed(FEED_COLUMNS), "extra"])
    row = read_feed(spark, str(tmp_path), multi_line=True).first()
    assert (row.name, row.spotify_id, row.country) == ('say "hi", you\ntwo lines', "s1", "VN")


def test_missing_columns_are_reported(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [{}], FEED_COLUMNS[1:])
    with pytest.raises(ValueError, match="spotify_id"):
        read_feed(spark, str(tmp_path))


@pytest.mark.parametrize("column", [FEED_COLUMNS[1], FEED_COLUMNS[-1]])
def test_line_breaks_in_quotes_stop_a_scan_by_lines(spark, tmp_path, column):
    write_csv(tmp_path / "broken.csv", [{}, {column: 'say "hi",\nagain'}, {}])
    for action in (lambda df: df.count(), lambda df: df.collect()):
        with pytest.raises(Exception, match="broken.csv"):
            action(read_feed(spark, str(tmp_path)))
    assert read_feed(spark, str(tmp_path), multi_line=True).count() == 3


def test_rows_of_another_length_are_kept(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [{"name": 'say "hi"'}])
    with open(tmp_path / "a.csv", "a") as out:
        out.write("s2,Short\ns3,Long" + ",1" * 40 + "\n")
    feed = read_feed(spark, str(tmp_path))
    assert feed.count() == 3
    assert bag(feed, "spotify_id", "name") == [("s1", 'say "hi"'), ("s2", "Short"), ("s3", "Long")]


def test_a_large_file_is_split(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [{"popularity": str(i % 100)} for i in range(3000)])
    with using_conf(spark, {"spark.sql.files.maxPartitionBytes": "50000"}):
        feed = read_feed(spark, str(tmp_path))
        assert feed.rdd.getNumPartitions() > 3
        assert feed.count() == 3000
        seen = [r.popularity for r in feed.orderBy(SEQ).select("popularity").collect()]
    assert seen == [str(i % 100) for i in range(3000)]


def test_null_tokens(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [{"name": "None", "country": "NA", "artists": ""}])
    kept = read_feed(spark, str(tmp_path)).first()
    assert (kept.name, kept.country, kept.artists) == ("None", "NA", None)
    lost = read_feed(spark, str(tmp_path), null_tokens=PANDAS_NULL_TOKENS).first()
    assert (lost.name, lost.country) == (None, None)


@pytest.mark.parametrize("max_files", [1, 2, 1000])
def test_order_of_arrival_not_of_names_decides(spark, tmp_path, max_files):
    feed = tmp_path / "feed"
    feed.mkdir()
    for at, (name, popularity) in enumerate([("z", "11"), ("a", "22"), ("m", "33")]):
        write_csv(feed / f"{name}.csv", [{"popularity": popularity}])
        os.utime(feed / f"{name}.csv", (1_000_000 + at * 10, 1_000_000 + at * 10))
    built = build_warehouse(read_feed(spark, str(feed)))
    assert bag(built["fact_song_daily"], "popularity_score") == [(11,)]
    path = str(tmp_path / "tables")
    start_ingest(
        spark, str(feed), path, str(tmp_path / "ckpt"), max_files=max_files
    ).awaitTermination()
    assert bag(read_table(spark, path, "fact_song_daily"), "popularity_score") == [(11,)]


def test_input_order_over_files(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [{"popularity": "1"}, {"popularity": "2"}])
    write_csv(tmp_path / "b.csv", [{"popularity": "3"}])
    t = build_warehouse(read_feed(spark, str(tmp_path)))
    assert bag(t["fact_song_daily"], "popularity_score") == [(1,)]


ROWS = [
    {
        "spotify_id": f"s{i % 5}",
        "artists": ["A", "B, A", "C", ""][i % 4],
        "country": ["VN", "KR", "", "US"][i % 4],
        "snapshot_date": f"2024-0{1 + i // 20}-0{1 + i % 3}",
        "popularity": str(i),
        "album_name": ["X", "Y", ""][i % 3],
        "album_release_date": ["2020-01-01", "", "2021-05-05"][i % 3],
    }
    for i in range(60)
]


@pytest.mark.parametrize("cuts", [(7, 33, 60)])
def test_incremental_load_equals_full_build(spark, tmp_path, cuts):
    arrived = tmp_path / "in"
    arrived.mkdir()
    wh = str(tmp_path / "wh")

    def load(run):
        start_ingest(spark, str(arrived), wh, str(tmp_path / run)).awaitTermination()

    start = 0
    for i, end in enumerate(cuts):
        write_csv(arrived / f"part-{i}.csv", ROWS[start:end])
        start = end
        load("ckpt")
    want = build_warehouse(read_feed(spark, str(arrived)))
    sizes = {}
    for name in SCHEMAS:
        got = read_table(spark, wh, name)
        sizes[name] = got.count()
        cols = [c for c in got.columns if c != "created_at"]
        assert bag(got, *cols) == bag(want[name], *cols), name
    for name in MARTS:
        got = read_table(spark, wh, name)
        assert bag(got, *got.columns) == bag(marts.rollup(want, name), *got.columns), name
        sizes[name] = got.count()
    load("another checkpoint: all files again")
    assert {name: read_table(spark, wh, name).count() for name in (*SCHEMAS, *MARTS)} == sizes
    loads = rejects.read(spark, wh, "loads").groupBy().sum().first()
    assert loads["sum(rows_read)"] == 2 * len(ROWS) == loads["sum(rows_kept)"]


def test_export(spark, tmp_path):
    export_csv(spark.range(3).select(F.col("id").alias("x")), str(tmp_path / "out"), single_file=True)
    files = list((tmp_path / "out").glob("*.csv"))
    assert [f.read_text().split() for f in files] == [["x", "0", "1", "2"]]
