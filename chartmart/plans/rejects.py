"""What a load did not take as it was: dropped rows and replaced values, with reasons.

A reason is ``column: value``: a cell with content that its rule could not use, so that the row got
the default in its place, or a required cell that is missing (then the row is dropped). Rows with
reasons go to the ``quarantine`` table with all their cells as they came, ``loads`` has the counts of
each batch: kept and dropped rows are those read. Both lie in one partition per batch, which a
repeated batch replaces.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmart.functions import clean as c
from chartmart.plans.transform import FEED_RULES, REQUIRED, Number, clean_rows, drop_incomplete
from chartmart.sources.feed import FEED_COLUMNS
from chartmart.sources.tables import CODEC

REASONS = "_reasons"
RAW = "_raw"
FALSE_WORDS = ("false", "0", "no", "f")
QUARANTINE = ", ".join(f"{name} string" for name in FEED_COLUMNS) + (
    ", dropped boolean, reasons array<string>, batch string"
)
LOADS = (
    "rows_read bigint, rows_kept bigint, rows_dropped bigint, rows_mended bigint, "
    "values_replaced bigint, batch string"
)


def _parse(name: str, raw: Column) -> Column | None:
    """What both the test and the rule of a column read, where that is not the raw cell."""
    rule = FEED_RULES[name]
    if isinstance(rule, Number) or rule is c.clean_mode:
        return c.to_number(raw)
    return c.clean_date(raw) if rule is c.clean_date else None


def _unused(name: str, raw: Column, parsed: Column | None) -> Column:
    """Whether the rule of a column cannot use a cell with content."""
    rule = FEED_RULES[name]
    if isinstance(rule, Number):
        low = -c.MAX_DOUBLE if rule.lo is None else float(rule.lo)
        high = c.MAX_DOUBLE if rule.hi is None else float(rule.hi)
        return ~F.coalesce(parsed.between(low, high), F.lit(False))
    if parsed is not None:
        return parsed.isNull()
    if rule is c.clean_boolean:
        return ~F.lower(raw).isin(*c.TRUE_WORDS, *FALSE_WORDS)
    return F.lit(False)


def _reasons(parsed: Mapping[str, Column | None]) -> Column:
    """The list of reasons of a row, from its raw cells and what is parsed of them.

    Joined from lists of at most one reason: a lambda over all of them would keep every test out of
    generated code.
    """
    reasons, none = [], F.array().cast("array<string>")
    for name in FEED_COLUMNS:
        raw = F.col(name)
        has = F.length(F.trim(raw)) > 0
        wrong = has & _unused(name, raw, parsed[name])
        if name in REQUIRED:
            wrong = wrong | ~F.coalesce(has, F.lit(False))
        text = F.concat(F.lit(f"{name}: "), F.coalesce(raw, F.lit("")))
        reasons.append(F.when(wrong, F.array(text)).otherwise(none))
    return F.flatten(F.array(*reasons))


def judged(feed: DataFrame) -> DataFrame:
    """Feed rows with a list of reasons; each test reads its raw cell alone, once."""
    return feed.withColumn(REASONS, _reasons({n: _parse(n, F.col(n)) for n in FEED_COLUMNS}))


def cleaned(feed: DataFrame) -> DataFrame:
    """Clean cells of all feed rows and their reasons, with the raw cells where there are any.

    Each cell is parsed once, for its test and its rule.
    """
    parse = {n: _parse(n, F.col(n)) for n in FEED_COLUMNS}
    names = {n: f"_parsed_{n}" for n, value in parse.items() if value is not None}
    parsed = {n: F.col(names[n]) if n in names else None for n in FEED_COLUMNS}

    def clean(name: str) -> Column:
        rule = FEED_RULES[name]
        if rule is c.clean_date:
            return parsed[name]
        if rule is c.clean_mode:
            return c.mode_of(parsed[name])
        return rule(parsed[name] if name in names else F.col(name))

    rows = feed.withColumns({names[n]: parse[n] for n in names})
    rows = rows.withColumns({REASONS: _reasons(parsed), **{f"_clean_{n}": clean(n) for n in FEED_COLUMNS}})
    return rows.select(
        *[F.col(f"_clean_{n}").alias(n) if n in FEED_COLUMNS else F.col(n) for n in feed.columns],
        REASONS,
        F.when(F.size(REASONS) > 0, F.struct(*FEED_COLUMNS)).alias(RAW),
    )


def kept(rows: DataFrame) -> DataFrame:
    """The clean rows of ``judged`` or ``cleaned`` ones."""
    if RAW in rows.columns:
        return drop_incomplete(rows.drop(REASONS, RAW))
    return clean_rows(rows.drop(REASONS))


def _dropped() -> Column:
    """A required cell is among the reasons."""
    return F.exists(REASONS, lambda reason: F.split_part(reason, F.lit(":"), F.lit(1)).isin(*REQUIRED))


def quarantine(rows: DataFrame) -> DataFrame:
    """Raw cells of the rows with reasons."""
    found = rows.filter(F.size(REASONS) > 0)
    raw = [F.col(f"{RAW}.{n}") for n in FEED_COLUMNS] if RAW in rows.columns else FEED_COLUMNS
    return found.select(*raw, _dropped().alias("dropped"), F.col(REASONS).alias("reasons"))


def counts(rows: DataFrame) -> DataFrame:
    """One row: rows read, kept, dropped and kept with replaced values, and replaced values."""
    dropped, size = _dropped(), F.size(REASONS).cast("bigint")
    return rows.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~dropped).alias("rows_kept"),
        F.count_if(dropped).alias("rows_dropped"),
        F.count_if(~dropped & (size > 0)).alias("rows_mended"),
        F.coalesce(F.sum(F.when(~dropped, size)), F.lit(0).cast("bigint")).alias("values_replaced"),
    )


def write(rows: DataFrame, path: str, batch: str) -> None:
    """Quarantine and counts of a batch, in place of what it wrote before."""
    for name, df in (("quarantine", quarantine(rows)), ("loads", counts(rows))):
        (
            df.withColumn("batch", F.lit(batch))
            .write.mode("overwrite")
            .option("compression", CODEC)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(f"{path}/{name}")
        )


def read(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The ``quarantine`` or ``loads`` table."""
    schema = {"quarantine": QUARANTINE, "loads": LOADS}[name]
    return spark.read.schema(schema).parquet(f"{path}/{name}")
