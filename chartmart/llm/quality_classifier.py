"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text becomes counts of hashed byte trigrams and of a few marks of style (share of distinct words,
of symbols, of capitals, word length, number of words). Counts are damped, weighted by inverse
document frequency and projected on the leading singular vectors of the labelled sample. The sample's
vectors go to every task; each document is compared with all of them in blocks, exactly, and the
labels of its ``NEIGHBOURS`` nearest ones vote with their cosine to the power ``SHARPEN``.

The sample is the classifier's fit: at most ``LABELLED`` labelled documents outside the held-out fold,
chosen by a hash of their doc_id. Everything sent to tasks has a size fixed by these parameters.

Defined cases: null and empty texts, which are like nothing, get the sample's share of good labels;
without any labelled document the score is 0.5; of several labels of one doc_id the lowest counts,
null labels none; repeated rows get equal scores. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABELLED = 4000
BUCKETS = 2048
LATENT = 48
NEIGHBOURS = 25
SHARPEN = 4
STYLE_WEIGHT = 12.0  # a style mark counts as so many trigrams
THRESHOLD = 0.7
BLOCK = 1000
HELD_OUT = 2  # remainder of crc32(doc_id) by 4

_SYMBOL = re.compile(rb"[^\w\s.,;:'\"()?\x80-\xff-]")
_CAPITAL = re.compile(rb"[A-Z]")
_STEPS = {
    "distinct": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8),
    "symbols": (0.01, 0.03, 0.1, 0.3, 0.7, 1.5, 3.0),
    "capitals": (0.01, 0.03, 0.06, 0.12, 0.25, 0.5, 0.8),
    "length": (2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 12.0),
    "words": (5, 20, 50, 100, 200, 500, 2000),
}
_OFFSETS = np.cumsum([BUCKETS] + [len(s) + 1 for s in _STEPS.values()])
TERMS = int(_OFFSETS[-1])


def counts(text: str | None) -> np.ndarray:
    """Term counts of a text; all zero without words."""
    out = np.zeros(TERMS, np.float32)
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return out
    b = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    h = (b[:-2] * 0x9E3779B1 + b[1:-1] * 0x85EBCA77 + b[2:] * 0xC2B2AE3D) & 0xFFFFFFFF
    out[:BUCKETS] = np.bincount((h >> np.uint32(21)).astype(np.int64), minlength=BUCKETS)
    n, size = len(words), len(data)
    marks = (
        len(set(words)) / n,
        len(_SYMBOL.findall(data)) / n,
        len(_CAPITAL.findall(data)) / size,
        sum(map(len, words)) / n,
        n,
    )
    for value, steps, start in zip(marks, _STEPS.values(), _OFFSETS, strict=False):
        out[start + int(np.searchsorted(steps, value, side="right"))] = STYLE_WEIGHT
    return out


@dataclass
class Model:
    """Term weights and axes of the latent space, labelled unit vectors and their labels."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, rows: np.ndarray) -> np.ndarray:
        weighted = np.log1p(rows) * self.idf
        latent = weighted @ self.axes
        norm = np.linalg.norm(latent, axis=1, keepdims=True)
        return np.divide(latent, norm, out=np.zeros_like(latent), where=norm > 0)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled vectors for label 1, for counts of one block."""
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        cosine = self.project(rows) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPEN
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        share = float(self.labels.mean())
        return np.clip(np.where(total > 0, votes / np.where(total > 0, total, 1), share), 0, 1)


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Latent space and labelled vectors of sampled counts."""
    if not len(rows):
        empty = np.zeros((0, LATENT), np.float32)
        axes = np.zeros((TERMS, LATENT), np.float32)
        return Model(np.ones(TERMS, np.float32), axes, empty, labels)
    there = (rows > 0).sum(axis=0)
    idf = np.log((1 + len(rows)) / (1 + there)).astype(np.float32) + np.float32(0.1)
    weighted = (np.log1p(rows) * idf).astype(np.float64)
    norm = np.linalg.norm(weighted, axis=1, keepdims=True)
    unit = np.divide(weighted, norm, out=np.zeros_like(weighted), where=norm > 0)
    _, vectors = np.linalg.eigh(unit.T @ unit)
    axes = np.ascontiguousarray(vectors[:, ::-1][:, :LATENT]).astype(np.float32)
    model = Model(idf, axes, np.zeros((0, LATENT), np.float32), labels)
    model.vectors = model.project(rows).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    remainder = F.crc32(doc_id.cast("string")) % 4
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on at most ``LABELLED`` labelled documents that are not held out."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counts(t).tobytes() for t in batch.column("text").to_pylist()]
            names = ["doc_id", "quality", "terms"]
            columns = [batch.column("doc_id"), batch.column("quality"), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, quality long, terms binary"
    texts = texts.select("doc_id", F.col("quality").cast("long").alias("quality"), "text")
    # Bounded by LABELLED; a doc_id that repeats is taken once.
    found = {r["doc_id"]: r for r in texts.mapInArrow(count, schema).limit(2 * LABELLED).collect()}
    rows = [found[k] for k in sorted(found)]
    matrix = np.frombuffer(b"".join(r["terms"] for r in rows), np.float32).reshape(-1, TERMS)
    return fit(matrix, np.array([float(r["quality"]) for r in rows]))


SCHEMA = "doc_id long, score double"


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            scores = [
                known.score(np.array([counts(t) for t in texts[i : i + BLOCK]]))
                for i in range(0, len(texts), BLOCK)
            ]
            values = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(values, pa.float64())],
                ["doc_id", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    found = scored(docs, train(docs, labels))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
