"""Document fingerprints from content-defined chunks.

A rolling gear hash over the UTF-8 bytes cuts a text where its own content says so, so an insertion
moves only the cuts beside it. Cutting is normalised: below the normal chunk size a cut needs more
zero bits of the hash than above it. A fingerprint is the set of chunk digests with chunk lengths;
likeness is the share of a text's chunked bytes whose chunks the other text holds too (containment).

Defined cases: null is the empty text, whose fingerprint is the empty string; two empty texts are
alike (1), an empty and another are not (0); equal texts have equal fingerprints; of repeated
doc_ids each row counts as a document of its own, ordered by text; null doc_ids come first; an only
document is its own next one. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BYTES, NORMAL_BYTES, MAX_BYTES = 16, 64, 256
STRICT_BITS, LOOSE_BITS = 7, 4
WINDOW = 32  # bytes that one 32-bit gear hash looks back


def _gear() -> np.ndarray:
    """256 well-mixed 32-bit values, one per byte."""
    x = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()
# High bits depend on the whole window.
STRICT = np.uint32(((1 << STRICT_BITS) - 1) << (32 - STRICT_BITS))
LOOSE = np.uint32(((1 << LOOSE_BITS) - 1) << (32 - LOOSE_BITS))


def gear_hashes(data: bytes) -> np.ndarray:
    """Gear hash after each byte: the sum of GEAR[b] << age over the last 32 bytes."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    step = 1
    while step < WINDOW and step < len(h):
        longer = h.copy()
        longer[step:] += h[:-step] << np.uint32(step)
        h = longer
        step *= 2
    return h


def cuts(data: bytes) -> list[int]:
    """End of each chunk."""
    n = len(data)
    if n == 0:
        return []
    h = gear_hashes(data)
    at = np.flatnonzero((h & LOOSE) == 0)
    strict = (at[(h[at] & STRICT) == 0] + 1).tolist()
    loose = (at + 1).tolist()
    ends, start = [], 0
    while n - start > MIN_BYTES:
        normal, last = min(start + NORMAL_BYTES, n), min(start + MAX_BYTES, n)
        k = bisect_left(strict, start + MIN_BYTES)
        if k < len(strict) and strict[k] < normal:
            end = strict[k]
        else:
            k = bisect_left(loose, normal)
            end = loose[k] if k < len(loose) and loose[k] < last else last
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def chunk_set(text: str) -> dict[str, int]:
    """Digest and length of each distinct chunk."""
    data, found, start = text.encode("utf-8", "surrogatepass"), {}, 0
    for end in cuts(data):
        found[xxhash.xxh3_64_hexdigest(data[start:end])[:12]] = end - start
        start = end
    return found


def written(chunks: dict[str, int]) -> str:
    return ",".join(f"{digest}:{chunks[digest]}" for digest in sorted(chunks))


def containment(own: dict[str, int], other: dict[str, int]) -> float:
    """Share of the bytes of ``own`` chunks that ``other`` holds."""
    if not own:
        return float(not other)
    return sum(n for digest, n in own.items() if digest in other) / sum(own.values())


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def splitters(ids: DataFrame, parts: int) -> list[int]:
    """Up to ``parts - 1`` values that cut the ids into ranges of about equal size."""
    at = [i / parts for i in range(1, parts)]
    found = ids.agg(F.percentile_approx("doc_id", at, 50 * parts)).first()[0] if at else None
    return sorted(set(found or []))


def with_next(docs: DataFrame, found_by) -> DataFrame:
    """``found_by(rows)`` over ranges of doc_id in order, each with the row after its last one.

    Only ids decide the ranges. Every text moves once; the first document of a range also goes to
    the range before it (of the first, to the last) as a guest.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = splitters(rows.select("doc_id"), parts)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        known = np.searchsorted(bounds, ids.fillna(0).to_numpy(np.int64), side="right")
        return pd.Series(np.where(ids.isna(), 0, known).astype(np.int32))

    # One row per range: bounded by the number of partitions.
    first = (
        rows.select("doc_id")
        .withColumn("part", range_of("doc_id"))
        .groupBy("part")
        .agg(F.min("doc_id").alias("first"), F.count_if(F.isnull("doc_id")).alias("nulls"))
        .collect()
    )
    first.sort(key=lambda r: r["part"])
    before = {r["first"]: first[i - 1]["part"] for i, r in enumerate(first) if not r["nulls"]}
    null_before = [first[i - 1]["part"] for i, r in enumerate(first) if r["nulls"]]
    to = F.lit(null_before[0] if null_before else None).cast("int")
    guest_of = F.when(F.isnull("doc_id"), to)
    if before:
        pairs = F.create_map(
            *[x for k, v in before.items() for x in (F.lit(k).cast("long"), F.lit(v))]
        )
        heads = F.col("doc_id").isin(list(before))
        guest_of = guest_of.when(heads, F.element_at(pairs, F.col("doc_id").cast("long")))
    placed = rows.withColumn("part", range_of("doc_id")).withColumn(
        "to",
        F.explode(
            F.when(
                guest_of.isNotNull(),
                F.array(
                    F.struct(F.col("part").alias("part"), F.lit(0).alias("guest")),
                    F.struct(guest_of.alias("part"), F.lit(1).alias("guest")),
                ),
            ).otherwise(F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("guest"))))
        ),
    )
    dealt = placed.select("to.part", "to.guest", "doc_id", "text").repartitionById(parts, "part")
    return found_by(dealt.sortWithinPartitions("guest", F.asc_nulls_first("doc_id"), "text"))


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; a row is finished when the next one comes. Guests only finish the last row."""
    held, guest_seen = None, False
    for batch in batches:
        out = []
        columns = (batch.column(n).to_pylist() for n in ("doc_id", "text", "guest"))
        for doc_id, text, guest in zip(*columns, strict=True):
            if guest and (guest_seen or held is None):
                continue
            chunks = chunk_set(text)
            if held is not None:
                h_id, h_text, h_chunks = held
                new = edited(h_text, text)
                new_chunks = chunk_set(new)
                out.append(
                    (
                        h_id,
                        len(h_text),
                        hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                        written(h_chunks),
                        written(new_chunks),
                        containment(h_chunks, new_chunks),
                        containment(h_chunks, chunks),
                    )
                )
            held, guest_seen = (doc_id, text, chunks), bool(guest)
        if out:
            names = [field.split()[0] for field in SCHEMA.split(", ")]
            columns = [list(c) for c in zip(*out, strict=True)]
            types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how alike they are."""
    return with_next(docs, lambda rows: rows.mapInArrow(_compare, SCHEMA))
