"""Operators against plain formulations on random small tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chartmart.operators.aggregate import one_row, text_list
from chartmart.operators.append import append_new
from chartmart.operators.fan import fan_join_agg, with_members, FAN
from chartmart.operators.joins import drop_keys, lookup
from chartmart.operators.quality import check_fk, check_rules, check_unique
from chartmart.operators.rows import down, first_per, top_k, top_k_per
from checks.ranking import ranked_in_group


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_fan_equals_the_plain_join(spark, seed):
    rng = random.Random(seed)
    left = spark.createDataFrame(
        [(rng.randrange(3), rng.randrange(3), rng.choice(["a", "b", None]), rng.choice([None, *range(9)])) for _ in range(30)],
        "k int, d int, g string, x int",
    )
    right = spark.createDataFrame(
        [(rng.randrange(4), rng.randrange(3), rng.randrange(3)) for _ in range(20)],
        "k int, d int, m int",
    )
    joined = left.join(right, ["k", "d"], "left")
    want = joined.groupBy("g").agg(
        F.count(F.lit(1)), F.sum("x"), F.round(F.avg("x"), 9), F.min("x"), F.max("x"), F.count_distinct("m")
    )
    got = fan_join_agg(
        left,
        right,
        ["k", "d"],
        ["g"],
        {
            "n": ("count", None),
            "s": ("sum", "x"),
            "a": ("avg", "x"),
            "lo": ("min", "x"),
            "hi": ("max", "x"),
        },
        distinct={"m": "m"},
    ).withColumn("a", F.round("a", 9))
    assert bag(got) == bag(want)
    members = with_members(left, right, ["k", "d"], "m")
    assert members.agg(F.sum(FAN)).first()[0] == joined.count()


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_rank_in_bins_equals_row_number(spark, width):
    rng = random.Random(width)
    df = spark.createDataFrame(
        [(rng.choice("ab"), rng.randrange(4), i) for i in rng.sample(range(-50, 500), 200)],
        "g string, v int, t long",
    )
    plain = df.withColumn(
        "r", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), F.asc("t")))
    )
    got = ranked_in_group(df, ["g"], "v", "t", "r", width=width)
    assert bag(got.select("g", "v", "t", "r")) == bag(plain)


def test_first_per_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("s"))
    first = first_per(df, ["k"], ["s"])
    assert bag(first) == [(i, i) for i in range(7)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")
    assert "WindowGroupLimit" in plan[plan.index("Exchange") :]


def test_top_k_per_and_null_order(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 3), ("b", 2)], "g string, x int")
    assert bag(top_k_per(df, ["g"], [down("x")], 1)) == [("a", None), ("b", 2)]
    assert [r.x for r in top_k(df, [down("x")], 2).collect()] == [None, 3]


def test_null_safe_lookup_and_append(spark):
    dim = spark.createDataFrame([("x", None, 1), ("x", 5, 2)], "n string, d int, v int")
    df = spark.createDataFrame([("x", None), ("x", 5), ("y", None)], "n string, d int")
    assert bag(lookup(df, dim, ["n", "d"], "left", null_safe=True)) == [
        ("x", 5, 2), ("x", None, 1), ("y", None, None),
    ]
    filled = lookup(df, dim, ["n", "d"], "left", null_safe=True, default={"v": F.lit(0)})
    assert ("y", None, 0) in bag(filled)
    assert bag(append_new(dim, df, ["n", "d"], null_safe=True)) == [("y", None)]
    assert bag(drop_keys(df, dim, ["n"])) == [("y", None)]
    repeated = df.union(df).withColumn("s", F.monotonically_increasing_id())
    assert append_new(None, repeated, ["n", "d"], order=["s"]).count() == 3


def test_text_list_keeps_groups_without_text(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "g int, x string")
    assert bag(text_list(df, ["g"], "x", "l")) == [(1, "a, b"), (2, None)]


def test_one_row(spark):
    a = spark.range(3).agg(F.count("id").alias("a"))
    b = spark.range(5).agg(F.max("id").alias("b"))
    assert bag(one_row(a, b)) == [(3, 4)]


def test_checks_find_what_is_wrong(spark):
    df = spark.createDataFrame([(1, 5), (1, -1), (2, None), (3, 7)], "k int, x int")
    got = check_rules(df, {"x is 0..6": F.col("x").between(0, 6), "k set": F.col("k").isNotNull()})
    assert bag(got) == [("k set", 0), ("x is 0..6", 2)]
    assert bag(check_unique(df, ["k"])) == [(1, 2)]
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    assert bag(check_fk(df, dim, "k")) == [(3, 1)]
