"""Incremental load: new feed files into an existing warehouse.

Every batch appends only unknown keys, table by table, and makes the rollups of the months that get new
rows anew. A batch that broke off is replayed as a whole under the same name: what it had staged is
replaced, what it had already written is skipped. The months whose rollups are due are noted before any
fact is touched, so whichever batch comes next makes those that a broken one left. New dimension members
are staged and their surrogate keys checked before any table is touched. Loads into one warehouse take
turns; each stages in a folder of its own.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartmart.operators.append import append_new
from chartmart.plans import marts, rejects
from chartmart.plans.warehouse import CHART_FACTS, build_from_clean, check_keys
from chartmart.session import WIDE_ROW_CONF, using_conf
from chartmart.sources import folders
from chartmart.sources.feed import (
    FEED_COLUMNS,
    file_order,
    stream_feed,
    with_file_numbers,
    with_input_order,
)
from chartmart.sources.tables import (
    DIMENSIONS,
    MONTH,
    NATURAL_KEYS,
    by_month,
    create_missing,
    materialise,
    read_table,
    write_tables,
)

# The only natural key with a part that may be null.
_NULL_SAFE = {"dim_album"}
# The months whose rollups are due, below a warehouse.
_DUE = "_due"


def load_batch(
    feed: DataFrame, path: str, owner: str | None = None, batch: str | None = None
) -> None:
    """Adds the rows of one ordered feed batch to the tables under ``path``.

    ``owner`` names who loads, ``batch`` what is loaded; a replay has the same names.
    """
    spark = feed.sparkSession
    owner = owner or uuid.uuid4().hex
    batch = f"{owner}-{batch or 0}"
    stage = f"{path}/_stage/{batch}"
    with using_conf(spark, WIDE_ROW_CONF):
        rows = materialise(rejects.cleaned(feed), f"{stage}/rows")
    clean = rejects.kept(rows)
    files = file_order(rows)
    if files is not None:
        clean = with_file_numbers(clean, materialise(files, f"{stage}/files"))
    with folders.exclusive(spark, path, owner):
        rejects.write(rows, path, batch)
        if not clean.isEmpty():
            _append(spark, clean, path, stage)
    folders.remove(spark, stage)


def _append(spark: SparkSession, clean: DataFrame, path: str, stage: str) -> None:
    """Rows with unknown keys to all tables, and the rollups of the months that get any."""
    # As many as the feed has months.
    months = [
        row[0] for row in clean.select(F.trunc("snapshot_date", "MM")).distinct().collect()
    ]

    def known(name: str) -> DataFrame:
        table = read_table(spark, path, name)
        return table.filter(F.col(MONTH).isin(months)) if by_month(name) else table

    # Nothing has to meet a table that has no rows in these months: no join, no shuffle for it.
    none = _each(NATURAL_KEYS, lambda name: known(name).isEmpty())
    empty = {name for name in NATURAL_KEYS if none[name]}
    # Known facts are met in the shuffle that makes new ones.
    met = {"fact_artist_stats"} - empty
    if not empty & {*CHART_FACTS} and _alike(spark, path, known):
        met |= {*CHART_FACTS}
    new: list[DataFrame] = []

    def stage_rows(rows: DataFrame) -> DataFrame:
        staged = materialise(rows, f"{stage}/chart_rows", month_layout=True, laid_out=True)
        if "fact_song_daily" in met:
            new.append(staged)
        return staged

    incoming = build_from_clean(
        clean,
        stage_rows,
        known("fact_song_daily") if "fact_song_daily" in met else None,
        known("fact_artist_stats") if "fact_artist_stats" in met else None,
    )
    fresh = {
        name: table
        if name in met
        else append_new(
            None if name in empty else known(name),
            table,
            NATURAL_KEYS[name],
            null_safe=name in _NULL_SAFE,
        )
        for name, table in incoming.items()
    }
    fresh |= _each(DIMENSIONS, lambda name: materialise(fresh[name], f"{stage}/{name}"))
    check_keys({n: fresh[n] for n in DIMENSIONS}, {n: known(n) for n in DIMENSIONS})
    # Where rows met known ones, only some months may get any.
    some = [name for name in marts.FACTS if name not in empty]
    for name in some:
        if name not in CHART_FACTS or name not in met:
            fresh[name] = materialise(
                fresh[name], f"{stage}/{name}", month_layout=True, laid_out=name in met
            )
            new.append(fresh[name])
    due = _due(spark, path, months, new, len(some) < len(marts.FACTS))
    if due:
        noted = spark.createDataFrame([(month,) for month in due], f"{MONTH} date").coalesce(1)
        noted.write.mode("append").parquet(f"{path}/{_DUE}")
    laid_out = (empty & {*CHART_FACTS, *marts.LAID_OUT}) | met | set(some)
    write_tables(fresh, path, mode="append", laid_out=laid_out)
    if due:
        marts.refresh(spark, path, due)
        folders.remove(spark, f"{path}/{_DUE}")


def _each(names: Iterable[str], work: Callable[[str], Any], at_once: int = 4) -> dict[str, Any]:
    """What ``work`` gives for each name, a few at a time: short jobs then fill idle executors."""
    names = list(names)
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(names, pool.map(work, names), strict=True))


def _alike(spark: SparkSession, path: str, known: Callable[[str], DataFrame]) -> bool:
    """Whether the facts made of the same chart rows have the same keys: no load broke off between them."""
    if folders.exists(spark, f"{path}/{_DUE}"):
        return False
    return len({*_each(CHART_FACTS, lambda name: known(name).count()).values()}) == 1


def _due(
    spark: SparkSession, path: str, months: list, fresh: list[DataFrame], all_new: bool
) -> list:
    """The months whose rollups are to be made: those of new rows, without rollup, or left by a broken load.

    ``all_new``: a fact had no rows in the ``months`` of the batch, so all of them may get some.
    """

    def of(df: DataFrame) -> set:
        return {row[0] for row in df.select(MONTH).distinct().collect()}

    touched = F.col(MONTH).isin(months)
    due = set(months) if all_new else set(months) - of(read_table(spark, path, "agg_song_day").filter(touched))
    due = due.union(*map(of, fresh))
    if folders.exists(spark, f"{path}/{_DUE}"):
        due |= of(spark.read.schema(f"{MONTH} date").parquet(f"{path}/{_DUE}"))
    return sorted(due)


def start_ingest(
    spark: SparkSession,
    in_dir: str,
    path: str,
    checkpoint: str,
    columns: Sequence[str] = FEED_COLUMNS,
    null_tokens: Sequence[str] = ("",),
    max_files: int = 200,
    multi_line: bool = False,
) -> StreamingQuery:
    """Loads the files that have arrived in ``in_dir`` since the last run, then stops.

    Files are taken in order of arrival, ``max_files`` per batch; how many does not
    change the tables.
    """
    create_missing(spark, path)
    owner = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            load_batch(with_input_order(batch), path, owner, str(batch_id))

    return (
        stream_feed(spark, in_dir, columns, null_tokens, max_files, multi_line)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
