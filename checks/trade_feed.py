"""A chart feed derived from trade tables.

Parts are songs, customer nations are countries, five-day windows of order
dates are chart days, and the ordered quantity decides the rank. The feed has
the same columns and the same kinds of dirty cells as a real one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmart.sources.feed import FEED_COLUMNS, SEQ
from chartmart.sources.tables import materialise
from checks.ranking import ranked_in_group

# Fixed values of the derivation.
FIRST_DAY = "1995-01-01"
DAYS_PER_SNAPSHOT = 5


def _percent(number: Column) -> Column:
    share = number % 101
    return F.concat(
        F.floor(share / 100).cast("string"), F.lit("."), F.lpad((share % 100).cast("string"), 2, "0")
    )


def _text(number: Column) -> Column:
    return number.cast("string")


def _table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def _sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered quantity of each part per nation and day."""
    lines = _table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit(FIRST_DAY).cast("date"))
    orders = (
        _table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
        .withColumn("dn", (F.floor(day / DAYS_PER_SNAPSHOT) * DAYS_PER_SNAPSHOT).cast("int"))
        .join(
            _table(spark, sf_dir, "customer", "c_custkey", "c_nationkey"),
            F.expr("o_custkey = c_custkey"),
        )
        .select("o_orderkey", "dn", F.col("c_nationkey").alias("nk"))
    )
    return (
        lines.join(orders, F.expr("l_orderkey = o_orderkey"))
        .groupBy(F.col("l_partkey").alias("pk"), "nk", "dn")
        .agg(F.sum("l_quantity").cast("bigint").alias("q"))
    )


def _songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells that are the same on every day and in every country: made once per part."""
    pk = F.col("p_partkey")

    def every(n: int) -> Column:
        return pk % n == 0

    number = _text(pk % 400)
    lead = F.concat(F.lit("A"), _text(pk % 50))
    release_year, release_month, release_day = 1998 + pk % 7, 1 + pk % 12, 1 + pk % 28
    iso_release = F.concat_ws(
        "-",
        _text(release_year),
        F.lpad(_text(release_month), 2, "0"),
        F.lpad(_text(release_day), 2, "0"),
    )
    cells = {
        "spotify_id": F.when(~every(101), F.concat(F.lit("T"), _text(pk))),
        "name": F.when(every(103), "")
        .when(every(17), F.concat(F.lit("  "), F.col("p_name"), F.lit("  "), number))
        .otherwise(F.concat(F.col("p_name"), F.lit(" "), number)),
        "artists": F.when(every(19), "")
        .when(every(3), F.concat(lead, F.lit(", A"), _text(pk * 7 % 50)))
        .when(every(23), F.concat(lead, F.lit(", ")))
        .otherwise(lead),
        "is_explicit": F.when(every(5), "True").otherwise("False"),
        "duration_ms": F.when(every(83), "-5").otherwise(_text(90_000 + pk % 60 * 5_000)),
        "album_name": F.when(~every(31), F.col("p_brand")),
        "album_release_date": F.when(every(37), F.lit(None))
        .when(every(41), "bad")
        .when(
            every(13),
            F.concat_ws("/", _text(release_month), _text(release_day), _text(release_year)),
        )
        .otherwise(iso_release),
        "danceability": _percent(pk * 53),
        "energy": F.when(every(43), "-1").otherwise(_percent(pk * 37)),
        "key": _text(pk % 13),
        "loudness": F.when(every(59), "5").otherwise(_text(-(pk * 3 % 60))),
        "mode": F.when(~every(71), _text(pk % 2)),
        "speechiness": _percent(pk * 11),
        "acousticness": _percent(pk * 29),
        "instrumentalness": _percent(pk * 19),
        "liveness": _percent(pk * 23),
        "valence": _percent(pk * 71),
        "tempo": F.when(every(61), "10").otherwise(_text(50 + pk * 13 % 130)),
        "time_signature": _text(pk % 9),
    }
    return _table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size").select(
        pk, "p_size", *[cell.alias(name) for name, cell in cells.items()]
    )


def chart_feed(spark: SparkSession, sf_dir: str, stage: str) -> DataFrame:
    """The feed as text columns plus ``_seq``.

    The sold quantities are staged below ``stage``, as ranking reads them twice. The merge join leaves
    rows ordered by song, so that files repeat the cells of a song in runs.
    """
    pk, nk, dn, rk, cp = (F.col(c) for c in ("pk", "nk", "dn", "rk", "cp"))

    def every(n: int) -> Column:
        return pk % n == 0

    days = {
        "daily_rank": F.when((pk + dn) % 97 == 0, F.lit(None))
        .when((pk + dn) % 98 == 0, "x")
        .otherwise(_text(rk)),
        "daily_movement": F.when(~every(29), _text((pk * 7 + dn) % 101 - 50)),
        "weekly_movement": _text((pk * 11 + dn) % 141 - 70),
        "country": F.when(nk == 24, F.lit(None))
        .when(nk == 23, "")
        .otherwise(F.concat(F.lit("N"), _text(nk))),
        "snapshot_date": _text(F.date_add(F.lit(FIRST_DAY).cast("date"), dn)),
        "popularity": F.when(every(89), "999").otherwise(
            _text((F.col("p_size") * 2 + F.col("q") + cp) % 101)
        ),
    }
    sold = materialise(_sold(spark, sf_dir), f"{stage}/sold")
    ranked = ranked_in_group(sold, ["nk", "dn"], value="q", tie="pk", name="rk")
    copies = F.when(every(53), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # Copies follow all originals; then by day, country and rank. Digits leave
    # room for 100,000 days, 1,000 countries and 10^10 ranks.
    seq = ((cp.cast("bigint") * 100_000 + dn) * 1_000 + nk) * 10_000_000_000 + rk
    return (
        ranked.join(_songs(spark, sf_dir).hint("merge"), F.expr("pk = p_partkey"))
        .withColumn("cp", F.explode(copies))
        .select(*[days[c].alias(c) if c in days else c for c in FEED_COLUMNS], seq.alias(SEQ))
    )
