"""Load-time measures on hand-written rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from chartmart.functions import metrics as m


def one(spark, *cols):
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return list(row)


def L(x):
    return F.lit(x)


def test_rank_measures(spark):
    assert one(spark, m.rank_points(L(1)), m.rank_points(L(120)), m.performance_index(L(30), L(0))) == [
        Decimal("100.00"), Decimal("-19.00"), Decimal("35.50"),
    ]


def test_previous_rank(spark):
    moves = [(5, 2), (5, 0), (5, -3), (5, 5), (1, 50)]
    got = one(spark, *[m.previous_rank(L(r), L(d)) for r, d in moves])
    assert got == [3, 5, 8, 100, 100]
    assert one(spark, m.previous_rank(L(5), L(2), sign=1)) == [7]


def test_flags_and_trend(spark):
    size = m.movement_magnitude(L(2), L(-3))
    got = one(
        spark,
        m.is_rising(L(2), L(-3)),
        m.is_falling(L(2), L(-3)),
        size,
        m.trend_strength(size),
        m.viral_coefficient(size),
        m.trend_strength(L(140)),
        m.viral_coefficient(L(140)),
    )
    assert got == [
        True, True, 5, Decimal("0.50"), Decimal("0.05"), Decimal("10.00"), Decimal("1.00"),
    ]


def test_streaming(spark):
    got = one(
        spark,
        m.estimated_streams(L(1)),
        m.estimated_listeners(m.estimated_streams(L(1))),
        m.estimated_streams(L(120)),
        m.estimated_listeners(m.estimated_streams(L(120))),
        m.estimated_streams(L(300_000)),
    )
    assert got == [1_000_000, 600_000, -190_000, 0, -2_998_990_000]
    assert one(spark, m.completion_rate(), m.engagement_score(L(70)), m.engagement_score(L(99))) == [
        Decimal("85.00"), Decimal("84.00"), Decimal("100.00"),
    ]


def test_artist_score(spark):
    index = F.lit("35.50").cast("decimal(10,2)")
    got = one(
        spark,
        m.artist_score(index, L(0)),
        m.artist_score(index, L(3)),
        m.contribution_weight(L(0)),
        m.contribution_weight(L(1)),
    )
    assert got == [Decimal("35.50"), Decimal("24.85"), Decimal("1.00"), Decimal("0.50")]


def test_scores_are_float32(spark):
    got = one(spark, m.energy_dance_score(L(0.3), L(0.4)), m.mood_score(L(0.5), L(0.25)))
    assert [round(x, 6) for x in got] == [0.35, 0.4]
