"""Near-duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

Texts with equal shingle sets form one class and go on as one row, so copies cost nothing further.
Each class has ``TREES`` short signatures. Per tree the classes are sorted by signature; classes whose
signatures share a prefix lie side by side. Candidates are

- the next ``NEIGHBOURS`` classes in each sorted order that share a prefix of ``LEAST_DEPTH`` values
  or more: the longest common prefixes of a class are with its neighbours, so dense regions compare
  at great depth and sparse ones at small depth, each as deep as it needs;
- the pivot of every region of equal prefix, at the least and at the full depth: the class whose
  signatures recur most over all trees. Edited copies of one text differ from each other twice as much
  as from that text, and it is the pivot of nearly every region it is in.

Both are linear in the number of classes: a group of any size gives a few candidates per member and
tree. Candidates that signatures show to be far below the threshold go, with a margin of five
standard errors; the others are confirmed on their whole texts. Links then form components.

That settles most regions; the rest is searched in full. Regions of the least depth with the same
pivot are one crowd, so the trees do not repeat each other. A crowd whose members lie in two or more
components is dealt to blocks of bounded size, by hash; pairs of blocks compare whole shingle sets of
members of different components. The largest component of a crowd is not compared with itself, so one
that holds nearly the whole crowd costs a row per member. Every two classes that share
``LEAST_DEPTH`` values in a tree are thus either compared or in one component already, whatever the
size of the group and the number of partitions. A pair at a similarity of 0.85 shares them in one of
the 16 trees but for a chance of 3e-7 (0.80: 1e-5).

Defined cases: words are runs of other than ASCII white space, A-Z in lower case; fewer words than a
shingle form one shingle; null, empty and blank texts have none and are linked with nothing, also not
with each other; repeated rows each get a row, and their doc_id counts as one document.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.llm.common import settle
from chartmart.llm.components import components

SHINGLE = 5
LINK_PERCENT = 85
TREES, DEPTH, LEAST_DEPTH = 16, 6, 3
NEIGHBOURS = 4
MARGIN = 5.0
# Shingles of a searched block; a document counts as BLOCK_DOC more, which bounds its documents.
BLOCK, BLOCK_DOC = 400_000, 200
_BLOCK = 4096  # shingles hashed at once

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    h = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        h = h * _MULTIPLY + words[i : i + len(h)]
    return np.unique(_mix(h + np.uint64(width)))


_FACTORS = _mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * _MULTIPLY) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least 32-bit values of TREES * DEPTH hash functions over the set."""
    least = np.full(TREES * DEPTH, 2**32 - 1, np.uint32)
    for start in range(0, len(shingles), _BLOCK):
        block = shingles[start : start + _BLOCK]
        hashed = ((block[None, :] * _FACTORS[:, None]) >> np.uint64(32)).astype(np.uint32)
        least = np.minimum(least, hashed.min(axis=1))
    return least.astype(">u4")  # byte order is number order


# ``sketch`` is the lowest byte of each value: enough to tell pairs far below the threshold.
_SIGNED = "doc_id long, n_shingles long, set_id string, signature binary, sketch binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, ids, signatures, sketches = [], [], [], []
        for text in batch.column("text").to_pylist():
            found = shingle_set(text)
            sizes.append(len(found))
            ids.append(xxhash.xxh3_128_hexdigest(found.tobytes()) if len(found) else None)
            values = signature(found) if len(found) else None
            signatures.append(values.tobytes() if len(found) else None)
            sketches.append(values.astype(np.uint8).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(ids, pa.string()),
                pa.array(signatures, pa.binary()),
                pa.array(sketches, pa.binary()),
            ],
            ["doc_id", "n_shingles", "set_id", "signature", "sketch"],
        )


def signed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_sign, _SIGNED)


def _forest(classes: DataFrame) -> DataFrame:
    """(tree, key, doc, n) of every class and tree, where another class shares the least depth.

    Most classes share no prefix with any other: they go before anything is sorted or compared.
    """
    width = 4 * DEPTH
    keys = [
        F.struct(F.lit(t).alias("tree"), F.substring("signature", t * width + 1, width).alias("key"))
        for t in range(TREES)
    ]
    trees = classes.select("doc", "n", F.explode(F.array(*keys)).alias("at"))
    prefix = F.substring("at.key", 1, 4 * LEAST_DEPTH)
    trees = trees.select("at.tree", "at.key", "doc", "n", F.xxhash64("at.tree", prefix).alias("r"))
    shared = trees.groupBy("r").agg(F.count("*").alias("size")).where("size > 1").select("r")
    return settle(trees.join(shared.hint("merge"), "r", "left_semi").drop("r"), "forest")


_PAIR = "a long, b long"


def _similar_size(n: int, m: int, percent: int) -> bool:
    return 100 * min(n, m) >= percent * max(n, m)


def _neighbours(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of each row with the last few rows of its tree that share enough of the prefix."""
    near: deque = deque(maxlen=NEIGHBOURS)
    for batch in batches:
        left, right = [], []
        columns = (batch.column(c).to_pylist() for c in ("tree", "key", "doc", "n"))
        for tree, key, doc, n in zip(*columns, strict=True):
            prefix = key[: 4 * LEAST_DEPTH]
            for other_tree, other_prefix, other, m in near:
                if other_tree == tree and other_prefix == prefix and _similar_size(n, m, percent):
                    left.append(min(doc, other))
                    right.append(max(doc, other))
            near.append((tree, prefix, doc, n))
        if left:
            arrays = [pa.array(left, pa.int64()), pa.array(right, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b"])


def _pivots(trees: DataFrame, depth: int) -> DataFrame:
    """(pivot, m, doc, n) for each class and each pivot of its regions at ``depth``."""
    leaves = trees.groupBy("tree", "key").agg(F.count("*").alias("size"))
    shared = leaves.where("size > 1")
    recur = trees.join(shared, ["tree", "key"]).groupBy("doc").agg(F.sum("size").alias("recurs"))
    held = trees.join(recur, "doc", "left").withColumn("recurs", F.coalesce("recurs", F.lit(0)))
    part = held.withColumn("key", F.substring("key", 1, 4 * depth))
    best = F.max(F.struct("recurs", (-F.col("doc")).alias("doc"), F.col("n").alias("m")))
    top = part.groupBy("tree", "key").agg(best.alias("top"), F.count("*").alias("size"))
    top = top.where("size > 1").select("tree", "key", (-F.col("top.doc")).alias("pivot"), "top.m")
    own = part.join(top, ["tree", "key"]).where("doc <> pivot")
    return own.select("pivot", "m", "doc", "n").distinct()


def crowded(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sorted trees of the classes (doc, n, signature) and the crowds (pivot, m, doc, n)."""
    trees = _forest(classes)
    return trees, settle(_pivots(trees, LEAST_DEPTH), "crowds")


def candidates(
    classes: DataFrame, trees: DataFrame, crowds: DataFrame, percent: int = LINK_PERCENT
) -> DataFrame:
    """Distinct pairs (a, b) of classes with neighbours in a tree and with pivots."""
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = trees.repartitionByRange(parts, "tree", "key", "doc")
    ordered = ordered.sortWithinPartitions("tree", "key", "doc")
    pairs = ordered.mapInArrow(partial(_neighbours, percent=percent), _PAIR)
    low, high = F.least("n", "m"), F.greatest("n", "m")
    pivots = crowds.union(_pivots(trees, DEPTH)).where(100 * low >= percent * high)
    pivots = pivots.select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b"))
    pairs = pairs.union(pivots).distinct()
    s = classes.select("doc", "sketch")
    pairs = pairs.join(s.withColumnsRenamed({"doc": "a", "sketch": "sa"}), "a")
    pairs = pairs.join(s.withColumnsRenamed({"doc": "b", "sketch": "sb"}), "b")
    return pairs.mapInArrow(partial(_plausible, percent=percent), _PAIR)


def _plausible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    share = percent / 100
    n = TREES * DEPTH
    least = n * (share - MARGIN * (share * (1 - share) / n) ** 0.5)
    for batch in batches:
        if not batch.num_rows:
            continue
        sa, sb = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, n)
            for c in ("sa", "sb")
        )
        keep = pa.array((sa == sb).sum(axis=1) >= least)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"]
        )


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole shingle sets are similar enough; repeated neighbours are hashed once."""
    last: tuple[int | None, np.ndarray | None] = (None, None)
    for batch in batches:
        left, right = [], []
        columns = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
        for a, b, text_a, text_b in zip(*columns, strict=True):
            if last[0] != a:
                last = (a, shingle_set(text_a))
            one, other = last[1], shingle_set(text_b)
            both = len(np.intersect1d(one, other, assume_unique=True))
            if 100 * both >= percent * (len(one) + len(other) - both):
                left.append(a)
                right.append(b)
        arrays = [pa.array(left, pa.int64()), pa.array(right, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["a", "b"])


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """The pairs that hold the threshold on whole texts."""
    texts = docs.select("doc_id", "text")
    a = texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"})
    b = texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"})
    both = pairs.join(b, "b").join(a, "a")
    return both.mapInArrow(partial(_confirm, percent=percent), _PAIR)


def _cells(crowds: DataFrame, roots: DataFrame) -> DataFrame:
    """(pivot, lo, hi, at, doc, root): members of unsettled crowds in each pair of blocks to compare.

    Blocks ``0 … few - 1`` hold the members outside the crowd's largest component, the following ones
    that component; those are compared with the former only.
    """
    named = crowds.join(roots.withColumnRenamed("node", "doc"), "doc", "left")
    named = named.select("pivot", "doc", F.coalesce("root", "doc").alias("root"), "n")
    weight = F.sum(F.col("n") + BLOCK_DOC).alias("weight")
    parts = named.groupBy("pivot", "root").agg(weight)
    whole = parts.groupBy("pivot").agg(
        F.max(F.struct("weight", "root")).alias("main"),
        F.sum("weight").alias("weight"),
        F.count("*").alias("roots"),
    )
    blocks = lambda w: F.ceil(w / BLOCK)
    whole = whole.where("roots > 1").select(
        "pivot",
        F.col("main.root").alias("main"),
        blocks(F.col("weight") - F.col("main.weight")).alias("few"),
        blocks(F.col("main.weight")).alias("many"),
    )
    dealt = named.join(whole, "pivot").withColumn("is_main", F.expr("root = main"))
    at = F.expr("if(is_main, few + pmod(xxhash64(doc), many), pmod(xxhash64(doc), few))")
    others = F.expr("sequence(0L, if(is_main, few, few + many) - 1)")
    dealt = dealt.select("pivot", "doc", "root", at.alias("at"), F.explode(others).alias("other"))
    return dealt.select(
        "pivot", F.least("at", "other").alias("lo"), F.greatest("at", "other").alias("hi"), "at", "doc", "root"
    )


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at ``left`` with other ones at ``right``."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    met = count[column] > 1  # by two sets or more: others add to no intersection
    number = np.cumsum(count > 1) - 1
    owner, column = owner[met], number[column[met]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    found = np.zeros((len(left), len(right)))
    width = 1024
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        low, high = np.searchsorted(column, [start, start + width])
        held = np.zeros((len(sets), width), np.float32)
        held[owner[low:high], column[low:high] - start] = 1
        found += held[left] @ held[right].T
    return found


def _search(cell: pa.Table, percent: int) -> pa.Table:
    """Links (a, b) of components that similar members of two blocks join, as a spanning forest."""
    at, lo, hi = (cell.column(c).to_numpy() for c in ("at", "lo", "hi"))
    root = cell.column("root").to_numpy()
    sets = [shingle_set(t) for t in cell.column("text").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    left, right = np.flatnonzero(at == lo), np.flatnonzero(at == hi)
    both = _common(sets, left, right)
    either = sizes[left][:, None] + sizes[right][None, :] - both
    alike = (100 * both >= percent * either) & (both > 0)
    alike &= root[left][:, None] != root[right][None, :]
    i, j = np.nonzero(alike)
    joined = np.unique(np.sort(np.stack([root[left[i]], root[right[j]]], 1), axis=1), axis=0)
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    links = []
    for a, b in joined.tolist():
        low, high = sorted((top(a), top(b)))
        if low != high:
            parent[high] = low
            links.append((a, b))
    return pa.table(
        {"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())}
    )


def searched(
    crowds: DataFrame, roots: DataFrame, docs: DataFrame, percent: int = LINK_PERCENT
) -> DataFrame:
    """Links (a, b) between components (node, root) that the first candidates left apart."""
    texts = docs.select(F.col("doc_id").alias("doc"), "text")
    cells = _cells(crowds, roots).join(texts.hint("merge"), "doc")

    def search(cell: pa.Table) -> pa.Table:
        return _search(cell, percent)

    return cells.groupBy("pivot", "lo", "hi").applyInArrow(search, _PAIR)


def classified(docs: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """Every row's (doc_id, n_shingles, component_id); links need ``percent`` of equal shingles."""
    rows = settle(signed(docs), "signed")
    sets = rows.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
    classes = sets.groupBy("set_id").agg(
        F.min("doc_id").alias("doc"),
        F.first("n_shingles").alias("n"),
        F.first("signature").alias("signature"),
        F.first("sketch").alias("sketch"),
    )
    classes = settle(classes, "classes")
    trees, crowds = crowded(classes)
    pairs = settle(candidates(classes, trees, crowds, percent), "candidates")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).union(crowds.select("doc"))
    # The ids grow with the documents, so they are never broadcast, also where they would fit.
    one = docs.select("doc_id", "text").join(ids.distinct().hint("merge"), "doc_id", "left_semi")
    one = settle(one, "texts")
    roots = components(confirmed(pairs, one, percent))
    moved = components(searched(crowds, roots, one, percent))
    moved = moved.select(F.col("node").alias("component_id"), F.col("root").alias("to"))
    of_class = classes.join(roots, classes["doc"] == roots["node"], "left").select(
        "set_id", F.coalesce("root", "doc").alias("component_id")
    )
    of_class = of_class.join(moved, "component_id", "left").select(
        "set_id", F.coalesce("to", "component_id").alias("component_id")
    )
    return rows.join(of_class, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def kept(docs: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """One document of each component: the first one, with the input's columns.

    Of rows that repeat a doc_id one stays; rows without doc_id all stay.
    """
    stays = classified(docs, percent).where("doc_id = component_id").select("doc_id").distinct()
    first = docs.join(stays.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return first.select(*docs.columns).union(docs.where("doc_id IS NULL"))
