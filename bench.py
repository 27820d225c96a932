"""Times the headline queries on one data folder and prints one JSON line.

The warehouse is built first, table by table; its build times are reported
next to the queries. ``BENCH_PLAIN=1`` also times the plain many-to-many join
that the fan queries avoid.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from chartmart.session import get_spark  # noqa: E402
from chartmart.sources.tables import MARTS  # noqa: E402
from checks.spark_queries import QUERIES  # noqa: E402
from checks.warehouse import warehouse  # noqa: E402

HEADLINE = [key for key in QUERIES if key[0] in "qr"]


def plain_fan(spark, sf_dir: str):
    """Songs worldwide by the plain join: the yardstick for the rewritten query."""
    t = warehouse(spark, sf_dir)
    for name in ("fact_song_daily", "fact_artist_stats", "dim_song", "dim_artist", "dim_country"):
        t[name].createOrReplaceTempView(name)
    return spark.sql(
        """SELECT song_name, array_join(sort_array(collect_set(artist_name)), ', ') AS artist_name,
             count(DISTINCT country_name) AS num_countries, avg(popularity_score) AS avg_popularity,
             avg(daily_rank) AS avg_rank, max(popularity_score) AS max_popularity
           FROM fact_song_daily s JOIN dim_song USING (song_key)
           LEFT JOIN fact_artist_stats a ON s.song_key = a.song_key AND s.date_key = a.date_key
           LEFT JOIN dim_artist d ON a.artist_key = d.artist_key
           JOIN dim_country c ON s.country_key = c.country_key
           GROUP BY song_name ORDER BY avg_popularity DESC, num_countries DESC, song_name LIMIT 20"""
    )


def timed(action) -> float:
    start = time.time()
    action()
    return round(time.time() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        app="chartmart-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    t = warehouse(spark, sf_dir)
    build = {name: timed(lambda n=name: t[n]) for name in (*t.STAGES, *t, *MARTS)}
    run = dict(QUERIES)
    keys = list(HEADLINE)
    if os.environ.get("BENCH_PLAIN"):
        run["plain_join_top_songs_global"] = plain_fan
        keys.append("plain_join_top_songs_global")
    queries = {}
    for key in keys:
        queries[key] = timed(
            lambda k=key: run[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    total = round(sum(queries.values()), 3)
    print(
        json.dumps(
            {
                "metric": "chart queries, total",
                "value": total,
                "unit": "sec",
                "queries": queries,
                "build": build,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
