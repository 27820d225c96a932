"""Connected components of a distributed link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.llm.common import settle


def _roots(parents: DataFrame) -> DataFrame:
    """Follows parents (u, p), p <= u, up to the root, doubling the steps each time."""
    while True:
        up = parents.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        doubled = parents.join(up, "p", "left").select(
            "u", F.coalesce("pp", "p").alias("p"), (F.col("pp") < F.col("p")).alias("moved")
        )
        doubled = settle(doubled, "roots")
        if not doubled.where("moved").limit(1).count():
            return doubled.select("u", "p")
        parents = doubled.select("u", "p")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node it can reach.

    Each round hooks every node to its smallest neighbour, follows those hooks to their roots and
    contracts the links to roots. Hooks are minima, summed up before the shuffle, so a node with
    very many links is one row per task. Rounds end when no link joins two roots.
    """
    edges = settle(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b")
        .distinct(),
        "links",
    )
    labels = None
    while edges.limit(1).count():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        roots = _roots(settle(hooks.select("u", F.least("u", "m").alias("p")), "hooks"))
        if labels is None:
            labels = roots
        else:
            moved = roots.select(F.col("u").alias("p"), F.col("p").alias("to"))
            labels = labels.join(moved, "p", "left").select("u", F.coalesce("to", "p").alias("p"))
        a = roots.select(F.col("u").alias("a"), F.col("p").alias("ra"))
        b = roots.select(F.col("u").alias("b"), F.col("p").alias("rb"))
        edges = edges.join(a, "a").join(b, "b").where("ra <> rb")
        edges = edges.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        edges = settle(edges.distinct(), "links")
        labels = settle(labels, "labels")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels.select(F.col("u").alias("node"), F.col("p").alias("root"))
