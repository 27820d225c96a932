"""Mixing documents to target weights by iterative proportional fitting. Built-in functions only.

Tokens are summed up per cell of source, language and topic. Raking scales the cell weights to the
target share of each margin in turn, sweep after sweep, until all margins hold. A document's
probability is in proportion to weight over tokens of its cell, scaled so that the expected sample
has the asked share of all tokens; where that would exceed 1 every document of the cell is taken.
Documents are then drawn by a hash of their doc_id.

Targets are given as ``{margin: {value: share}}``; a margin without one is tempered: shares are
proportional to tokens ** ``TEMPER``, which lifts small sources and languages. A target value without
documents counts for nothing, and a value without a target gets no weight.

Tables of cells and margins stay distributed: their size depends on the number of sources.

Defined cases: null in source, language or topic is the value ``(none)``; null and empty texts have
one token; rows with equal doc_id, also null, are drawn or not together; no rows give no rows; columns of the
input are kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.llm.common import settle, words

TEMPER = 0.7
KEEP = 0.5
TOLERANCE, SWEEPS = 1e-5, 50
MARGINS = ("source", "lang", "topic")
SHORT, LONG = 1000, 4000
_STEPS, _ROUNDS = 64, 4


def topic(text: Column) -> Column:
    """Kind of content by built-in marks: figures, or prose by its length."""
    size = F.char_length(text)
    return (
        F.when(text.rlike("[0-9]"), "figures")
        .when(size < SHORT, "short prose")
        .when(size < LONG, "prose")
        .otherwise("long prose")
    )


def keyed(docs: DataFrame, text: str = "text", counted: bool = True) -> DataFrame:
    """``_row`` with the input's columns, its margins, and the tokens of its text."""
    plain = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    there = set(docs.columns)
    margin = [
        F.coalesce(F.col(f"`{c}`").cast("string") if c in there else F.lit(None), F.lit("(none)"))
        for c in MARGINS[:2]
    ]
    columns = [
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        *[m.alias(c) for m, c in zip(margin, MARGINS[:2], strict=True)],
        topic(plain).alias("topic"),
    ]
    if counted:
        columns.append(F.greatest(F.size(words(plain)), F.lit(1)).cast("long").alias("n_tokens"))
    return docs.select(*columns)


def _targets(cells: DataFrame, targets: dict[str, dict[str, float]] | None) -> dict[str, DataFrame]:
    """Shares of each margin's values that occur, adding up to 1."""
    out = {}
    for margin in MARGINS:
        present = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens"))
        if targets and margin in targets:
            given = list(targets[margin].items())
            table = cells.sparkSession.createDataFrame(given, f"{margin} string, raw double")
            present = present.join(table, margin, "left").na.fill(0.0, ["raw"])
        else:
            present = present.withColumn("raw", F.pow("tokens", F.lit(TEMPER)))
        present = settle(present.select(margin, "raw"), "margin")
        total = present.agg(F.sum("raw")).first()[0] or 1.0
        out[margin] = present.select(margin, (F.col("raw") / F.lit(total)).alias("target"))
    return out


def raked(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Cells (source, lang, topic, tokens) with a ``weight``: shares that meet every target."""
    wanted = _targets(cells, targets)
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    now = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    for _ in range(SWEEPS):
        for margin, table in wanted.items():
            sums = now.groupBy(margin).agg(F.sum("weight").alias("sum"))
            factor = table.join(sums, margin).select(
                margin, F.when(F.col("sum") > 0, F.col("target") / F.col("sum")).otherwise(0.0).alias("factor")
            )
            now = now.join(factor, margin).withColumn("weight", F.col("weight") * F.col("factor"))
            now = now.drop("factor")
        now = settle(now, "raked")
        # The last margin holds now; the others are off by what their factors still have to do.
        off = 0.0
        for margin, table in list(wanted.items())[:-1]:
            sums = now.groupBy(margin).agg(F.sum("weight").alias("sum")).join(table, margin)
            off = max(off, sums.agg(F.max(F.abs(F.col("sum") - F.col("target")))).first()[0] or 0.0)
        if off <= TOLERANCE:
            break
    return now


def _scale(cells: DataFrame, keep: float) -> float:
    """Factor of weight over tokens whose probabilities, 1 at most, take ``keep`` of all tokens.

    The expected sample grows with the factor; each round sums it up for a grid of factors at once
    and goes on between the two that enclose the wanted size.
    """
    ratio = F.col("weight") / F.col("tokens")
    low, high, total = cells.where("weight > 0").agg(
        F.min(1 / ratio), F.max(1 / ratio), F.sum("tokens")
    ).first()
    if not total:
        return 0.0
    all_tokens = cells.agg(F.sum("tokens")).first()[0]
    low = low * 1e-6
    for _ in range(_ROUNDS):
        grid = [low * (high / low) ** (i / _STEPS) for i in range(_STEPS + 1)]
        sums = cells.agg(
            *[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.lit(s) * ratio)) for s in grid]
        ).first()
        k = next((i for i, x in enumerate(sums) if x >= keep * all_tokens), _STEPS)
        low, high = grid[max(k - 1, 0)], grid[k]
    return high


def probabilities(
    held: DataFrame, keep: float = KEEP, targets: dict[str, dict[str, float]] | None = None
) -> DataFrame:
    """Cells of ``keyed`` rows with their weight and the probability of their documents."""
    cells = settle(
        held.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")),
        "cells",
    )
    found = raked(cells, targets)
    scale = _scale(found, keep)
    p = F.least(F.lit(1.0), F.lit(scale) * F.col("weight") / F.col("tokens"))
    return found.withColumn("probability", p)


def drawn(doc_id: Column, probability: Column) -> Column:
    """Whether a document is in the sample: a uniform hash of its doc_id is below its probability."""
    uniform = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit("mixing")), 11) / F.lit(float(2**53))
    return uniform < probability


def weighed(docs: DataFrame, keep: float = KEEP, targets=None, text: str = "text") -> DataFrame:
    """Every document as ``_row`` with margins, tokens, cell weight, probability and ``sampled``."""
    held = keyed(docs, text)
    cells = probabilities(held, keep, targets).select(*MARGINS, "weight", "probability")
    joined = held.join(cells, list(MARGINS))
    return joined.withColumn("sampled", drawn(F.col("_row.doc_id"), F.col("probability")))


def sample(docs: DataFrame, keep: float = KEEP, targets=None, text: str = "text") -> DataFrame:
    """The drawn documents with their own columns."""
    cells = probabilities(keyed(docs, text), keep, targets).select(*MARGINS, "probability")
    joined = keyed(docs, text, counted=False).join(cells, list(MARGINS))
    return joined.where(drawn(F.col("_row.doc_id"), F.col("probability"))).select("_row.*")
