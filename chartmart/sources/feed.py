"""The raw chart feed: CSV scan, as a batch and as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chartmart.operators.joins import lookup

# The column names of the feed.
FEED_COLUMNS = (
    "spotify_id",
    "name",
    "artists",
    "daily_rank",
    "daily_movement",
    "weekly_movement",
    "country",
    "snapshot_date",
    "popularity",
    "is_explicit",
    "duration_ms",
    "album_name",
    "album_release_date",
    "danceability",
    "energy",
    "key",
    "loudness",
    "mode",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "valence",
    "tempo",
    "time_signature",
)

# Input order of a row. Everywhere "first" means lowest in this column.
SEQ = "_seq"
# File, split offset and, if given, sequence number of a row just read.
PLACE = "_place"

# The cell texts a pandas CSV reader takes for null by default.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


# Lines that do not have the columns of the header.
BROKEN = "_broken"


def _options(multi_line: bool) -> dict[str, str]:
    return {
        "columnNameOfCorruptRecord": BROKEN,
        # With only some columns parsed, lines of the wrong length would go unseen.
        "columnPruning": str(multi_line).lower(),
        "header": "true",
        "multiLine": str(multi_line).lower(),
        "quote": '"',
        "escape": '"',
        # Checks each file's header instead of trusting column positions.
        "enforceSchema": "false",
    }


def _text_schema(columns: Sequence[str], multi_line: bool) -> StructType:
    guard = [] if multi_line else [BROKEN]
    return StructType([StructField(c, StringType()) for c in (*columns, *guard)])


def _unbroken(df: DataFrame) -> DataFrame:
    """Stops at a line that ends inside quotes: its row goes on in the next line.

    Read line by line such a row would fall apart. It lacks columns, or has too many, and an odd
    number of quotes; other lines of the wrong length are rows with missing or surplus cells.
    """
    if BROKEN not in df.columns:
        return df
    line = F.col(BROKEN)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"')))
    whole = line.isNull() | (quotes % 2 == 0)
    said = F.concat(
        F.lit("line break inside quotes, read this file with multi_line=True: "),
        F.col("_metadata.file_path"),
        F.lit(", near "),
        F.coalesce(df.columns[0], F.lit("")),
    )
    return df.filter(F.assert_true(whole, said).isNull()).drop(BROKEN)


def _cells(df: DataFrame, null_tokens: Sequence[str]) -> DataFrame:
    """The feed columns with null tokens nulled, and where each row came from."""
    df, tokens = _unbroken(df), list(null_tokens)
    cells = [
        (F.when(~F.col(c).isin(tokens), F.col(c)) if tokens else F.col(c)).alias(c)
        for c in FEED_COLUMNS
    ]
    place = [
        F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    ]
    if "seq" in df.columns:
        place.insert(0, F.col("seq").try_cast("bigint").alias("seq"))
    return df.select(*cells, F.struct(*place).alias(PLACE))


def with_input_order(cells: DataFrame) -> DataFrame:
    """Turns the place of each row into the input order ``_seq``.

    Files count in order of arrival, those of one moment by path. Row ids only
    order rows inside one split; file and split offset order the splits. So the
    order depends neither on how splits are spread over tasks nor on how many
    files a batch takes.
    """
    order = F.struct(f"{PLACE}.*", F.monotonically_increasing_id().alias("row"))
    return cells.withColumn(SEQ, order).drop(PLACE)


def file_order(rows: DataFrame) -> DataFrame | None:
    """The files of rows with an order by ``with_input_order``, numbered in that order; else nothing."""
    order = rows.schema[SEQ].dataType
    if not isinstance(order, StructType) or not {"arrived", "path"} <= set(order.names):
        return None
    files = rows.select(f"{SEQ}.arrived", f"{SEQ}.path").distinct()
    number = F.row_number().over(Window.orderBy("arrived", "path"))
    return files.withColumn("file", number)


def with_file_numbers(rows: DataFrame, files: DataFrame) -> DataFrame:
    """The same order in fewer bytes: the number of each row's file for its time and path."""
    names = rows.schema[SEQ].dataType.names
    plain = rows.withColumns({name: F.col(f"{SEQ}.{name}") for name in ("arrived", "path")})
    found = lookup(plain, files, ["arrived", "path"], "left", null_safe=True)
    order = ["file" if n == "arrived" else f"{SEQ}.{n}" for n in names if n != "path"]
    return found.withColumn(SEQ, F.struct(*order)).select(*rows.columns)


def read_feed(
    spark: SparkSession,
    path: str | Sequence[str],
    null_tokens: Sequence[str] = ("",),
    multi_line: bool = False,
) -> DataFrame:
    """Feed files as text columns plus the input order ``_seq``.

    Columns are taken by header name, in any order; a ``seq`` column, if there
    is one, decides the input order. Give ``PANDAS_NULL_TOKENS`` to treat the
    same cells as null as a pandas reader does. A large file is split over
    tasks. Quoted line breaks need ``multi_line``, which keeps each file in one
    task; without it a file that has some stops the job with its name.
    """
    paths = [path] if isinstance(path, str) else list(path)
    header = spark.read.option("header", "true").csv(paths).columns
    missing = [c for c in FEED_COLUMNS if c not in header]
    if missing:
        raise ValueError(f"feed lacks columns {missing}")
    df = spark.read.schema(_text_schema(header, multi_line)).options(**_options(multi_line)).csv(paths)
    return with_input_order(_cells(df, null_tokens))


def stream_feed(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = FEED_COLUMNS,
    null_tokens: Sequence[str] = ("",),
    max_files: int = 200,
    multi_line: bool = False,
) -> DataFrame:
    """The same as a stream over arriving files; ``columns`` is their header order.

    Row ids do not exist in a stream: apply ``with_input_order`` to its batches.
    """
    df = (
        spark.readStream.schema(_text_schema(columns, multi_line))
        .options(**_options(multi_line))
        .option("maxFilesPerTrigger", max_files)
        .csv(path)
    )
    return _cells(df, null_tokens)
