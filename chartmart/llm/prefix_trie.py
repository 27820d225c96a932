"""Prefix trie of conversations over minimal-perfect-hash node tables.

A node stands for the first d turns that some conversations share; its digest is chained from its
parent's digest and the turn's. Conversations in order of their ids are cut into shards of ``BLOCK``
turns. Per shard the distinct prefix digests get the slots 0 to n - 1 of a minimal perfect hash (levels
of bit tables; a digest settles on the first level where no other one wants its place); the slot's own
digest is compared at every look-up. Counts are scattered into flat arrays by slot and added up through
the array of parent slots, deepest nodes first. Shards overlap in the upper part of the trie only; what
they found is summed by node.

This is done twice. First with one member at the last turn of each conversation, which gives members and
least conversation of every node. Then with what each node adds to its ancestors (its saved tokens, and
one where it has no children), placed on the path of its least conversation, so that each node counts
once although its ancestors lie in many shards. No step goes through the trie level by level over the
cluster, and no node gathers its members or children. A conversation longer than a shard goes on in
further shards of its own, the sum below carried along.

Lists of conversations that end at a node are digested in order: ids are ranged over tasks by node and
id, joined to texts of up to ``PIECE`` ids, and these are read one after another.

Defined cases: a null role or text is the empty one; turns are ordered by turn, null first, then by
digest; repeated rows are turns each; rows without conv_id belong to no conversation; an empty table
gives no nodes; the remainder of a negative id has its sign. Only ``conv_id``, ``turn``, ``role`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.llm.common import settle, words

BLOCK = 1 << 16  # turns of a shard
PIECE = 1 << 16  # conversation ids joined to one text
FAMILY, HEADS = 20, 4  # conversations that take their first turns from one; fewer turns than HEADS
HOT = 1000  # parents with more than one in HOT of all nodes as children are looked up by broadcast

Arrays = dict[str, np.ndarray]


# --- node tables ----------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class NodeTable:
    """Slots 0 to n - 1 for n distinct digests of two 64-bit halves."""

    LEVELS, ROOM = 40, 1.5

    def __init__(self, high: np.ndarray, low: np.ndarray):
        one = np.lexsort((low, high))
        new = np.ones(len(one), bool)
        new[1:] = (high[one[1:]] != high[one[:-1]]) | (low[one[1:]] != low[one[:-1]])
        high, low = high[one[new]], low[one[new]]
        self.size = len(high)
        self.ranks: list[np.ndarray] = []  # per level: slot of each place, -1 where nobody settled
        slots = np.full(self.size, -1)
        left, done = np.arange(self.size), 0
        while len(left) and len(self.ranks) < self.LEVELS:
            width = int(self.ROOM * len(left)) + 1
            place = self._place(high[left], low[left], len(self.ranks), width)
            alone = np.bincount(place, minlength=width) == 1
            rank = np.where(alone, done + np.cumsum(alone) - 1, -1)
            self.ranks.append(rank)
            slots[left] = rank[place]
            done += int(alone.sum())
            left = left[~alone[place]]
        slots[left] = done + np.arange(len(left))
        self.rest = {(int(high[i]), int(low[i])): int(slots[i]) for i in left.tolist()}
        self.high, self.low = np.empty_like(high), np.empty_like(low)
        self.high[slots], self.low[slots] = high, low

    @staticmethod
    def _place(high: np.ndarray, low: np.ndarray, level: int, width: int) -> np.ndarray:
        h, g = high.astype(np.uint64), low.astype(np.uint64)
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
        return (_mix(_mix(h + seed) ^ g) % np.uint64(width)).astype(np.int64)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 for one that is not in the table."""
        slots = np.full(len(high), -1)
        left = np.arange(len(high))
        for level, rank in enumerate(self.ranks):
            if not len(left):
                break
            slots[left] = rank[self._place(high[left], low[left], level, len(rank))]
            left = left[slots[left] < 0]
        for i in left.tolist() if self.rest else ():
            slots[i] = self.rest.get((int(high[i]), int(low[i])), -1)
        held = np.flatnonzero(slots >= 0)
        same = (self.high[slots[held]] == high[held]) & (self.low[slots[held]] == low[held])
        slots[held[~same]] = -1
        return slots


def accumulate(depth: np.ndarray, parent: np.ndarray, *values: np.ndarray) -> None:
    """Adds to every slot the values of all slots below it; ``parent`` is -1 outside the table."""
    order = np.argsort(-depth, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(depth[order])) + 1, len(order))
    start = 0
    for end in edges.tolist():
        level = order[start:end]
        level = level[parent[level] >= 0]
        for value in values:
            np.add.at(value, parent[level], value[level])
        start = end


# --- shards -----------------------------------------------------------------------


def _joined(parts: list[Arrays]) -> Arrays:
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _cut(rows: Arrays, start: int, end: int) -> Arrays:
    return {k: v[start:end] for k, v in rows.items()}


def shards(batches: Iterator[Arrays], block: int) -> Iterator[tuple[Arrays, bool]]:
    """Rows in order cut into shards, and whether a shard's conversation goes on in the next one.

    A shard holds whole conversations, or a piece of one that is longer than a shard. Rows of one turn
    stay together.
    """

    def cut(rows: Arrays, going: bool, final: bool):
        while len(rows["conv_id"]):
            conv, n = rows["conv_id"], len(rows["conv_id"])
            new = np.flatnonzero(conv[1:] != conv[:-1]) + 1
            if going and len(new):
                yield _cut(rows, 0, int(new[0])), False
                rows, going = _cut(rows, int(new[0]), n), False
            elif final:
                yield rows, False
                return
            elif n < block:
                break
            elif len(new):
                yield _cut(rows, 0, int(new[-1])), False
                rows = _cut(rows, int(new[-1]), n)
            else:
                turns = np.flatnonzero(rows["depth"][1:] != rows["depth"][:-1]) + 1
                if not len(turns):
                    break
                yield _cut(rows, 0, int(turns[-1])), True
                rows, going = _cut(rows, int(turns[-1]), n), True
        return rows, going

    held, going = [], False
    for rows in batches:
        held.append(rows)
        if sum(len(part["conv_id"]) for part in held) >= block:
            rest, going = yield from cut(_joined(held), going, False)
            held = [rest]
    if held:
        yield from cut(_joined(held), going, True)


# --- first pass: paths, members ---------------------------------------------------


def shared_turns(conv_id: int) -> int:
    """How many turns a conversation takes from the first one of its family."""
    return zlib.crc32(str(conv_id).encode()) % HEADS


def _turns(conversations: DataFrame) -> DataFrame:
    """(family, conv_id, turn, digest, n_words) of every turn."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    conv_id = F.col("conv_id").cast("long")
    return conversations.where("conv_id IS NOT NULL").select(
        (conv_id - conv_id % FAMILY).alias("family"),
        conv_id.alias("conv_id"),
        "turn",
        F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.size(words(text)).cast("long").alias("n_words"),
    )


_ROOT = bytes(16)
_PATH = np.dtype(
    [("conv_id", "<i8"), ("depth", "<i8"), ("p", "<i8", 2), ("n", "<i8", 2), ("n_words", "<i8")]
)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[Arrays]:
    """A row per turn of each rebuilt conversation and one for its root, in order of depth."""
    family = conv = None
    heads: list[tuple[bytes, int]] = []
    skip = depth = 0
    node = _ROOT
    out: list[tuple] = []

    def add(digest: bytes, n_words: int) -> None:
        nonlocal depth, node
        before, depth = node, depth + 1
        node = hashlib.blake2b(before + digest, digest_size=16).digest()
        out.append((conv, depth, before, node, n_words))

    def arrays() -> Arrays:
        ints = np.array([(r[0], r[1], r[4]) for r in out], np.int64).reshape(-1, 3)
        p, n = (np.frombuffer(b"".join(r[i] for r in out), "<i8").reshape(-1, 2) for i in (2, 3))
        return {
            **{"conv_id": ints[:, 0], "depth": ints[:, 1], "n_words": ints[:, 2]},
            **{"p1": p[:, 0], "p2": p[:, 1], "n1": n[:, 0], "n2": n[:, 1]},
        }

    for batch in batches:
        names = ("family", "conv_id", "digest", "n_words")
        for of, conv_id, digest, n_words in zip(
            *(batch.column(c).to_pylist() for c in names), strict=True
        ):
            if of != family:
                family, heads = of, []
            if conv_id != conv:
                conv, depth, node = conv_id, 0, _ROOT
                out.append((conv, 0, _ROOT, _ROOT, 0))
                skip = 0
                if conv != family:
                    skip = shared_turns(conv)
                    for head in heads[:skip]:
                        add(*head)
            if skip:
                skip -= 1
            else:
                add(digest, n_words)
            if conv == family and len(heads) < HEADS - 1:
                heads.append((digest, n_words))
        if out:
            yield arrays()
            out.clear()


def _slots(rows: Arrays) -> tuple[NodeTable, np.ndarray]:
    table = NodeTable(rows["n1"], rows["n2"])
    return table, table.find(rows["n1"], rows["n2"])


_FIRST = (
    "is_node boolean, conv_id long, depth long, n1 long, n2 long, p1 long, p2 long, "
    "n_words long, n_convs long"
)


def _members(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Path rows (n_convs: 1 at the last turn) and the nodes of each shard with their members in it."""
    for rows, goes_on in shards(_paths(batches), block):
        conv, depth = rows["conv_id"], rows["depth"]
        table, slot = _slots(rows)
        n = len(conv)
        deepest = np.append(conv[1:] != conv[:-1], True)
        parent = np.full(table.size, -1)
        inside = np.flatnonzero(~deepest)
        parent[slot[inside + 1]] = slot[inside]
        of = {k: np.empty(table.size, np.int64) for k in ("depth", "p1", "p2", "n_words")}
        for k, values in of.items():
            values[slot] = rows[k]
        members, least = np.zeros(table.size, np.int64), np.full(table.size, np.iinfo(np.int64).max)
        np.add.at(members, slot[deepest], 1)
        np.minimum.at(least, slot, conv)
        accumulate(of["depth"], parent, members)
        ends = deepest.astype(np.int64)
        if goes_on:
            ends[-1] = 0
        path = [conv, depth, rows["n1"], rows["n2"], None, None, None, ends]
        node = [least, of["depth"], table.high, table.low, of["p1"], of["p2"], of["n_words"], members]
        names = [field.split()[0] for field in _FIRST.split(", ")]
        for is_node, columns, size in ((False, path, n), (True, node, table.size)):
            arrays = [pa.array(np.full(size, is_node))]
            arrays += [pa.nulls(size, pa.int64()) if c is None else pa.array(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names)


# --- second pass: leaves and saved tokens -----------------------------------------

_SECOND = "n1 long, n2 long, n_leaves long, saved_tokens long"


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[Arrays]:
    for batch in batches:
        if batch.num_rows:
            columns = zip(batch.schema.names, batch.columns, strict=True)
            yield {name: c.to_numpy(zero_copy_only=False) for name, c in columns}


def _sums(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """What each shard adds to its nodes, from paths upwards; the values of a turn come before it."""
    carried = None  # what the piece before adds to the conversation that goes on
    for rows, goes_on in shards(_arrays(batches), block):
        at = np.flatnonzero(~rows["is_value"])
        leaves, saved = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        value = np.flatnonzero(rows["is_value"])
        place = np.searchsorted(at, value)
        leaves[place], saved[place] = rows["leaf"][value], rows["saved"][value]
        conv, depth = rows["conv_id"][at], rows["depth"][at]
        paths = {k: rows[k][at] for k in ("n1", "n2")}
        table, slot = _slots(paths)
        if carried is not None:
            leaves[0] += carried[0]
            saved[0] += carried[1]
        carried = (int(leaves.sum()), int(saved.sum())) if goes_on else None
        all_leaves, all_saved = np.zeros(table.size, np.int64), np.zeros(table.size, np.int64)
        np.add.at(all_leaves, slot, leaves)
        np.add.at(all_saved, slot, saved)
        parent, of_depth = np.full(table.size, -1), np.empty(table.size, np.int64)
        of_depth[slot] = depth
        inside = np.flatnonzero(conv[1:] == conv[:-1])
        parent[slot[inside]] = slot[inside + 1]
        accumulate(of_depth, parent, all_leaves, all_saved)
        some = (all_leaves > 0) | (all_saved > 0)
        columns = (table.high, table.low, all_leaves, all_saved)
        arrays = [pa.array(c[some]) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, ["n1", "n2", "n_leaves", "saved_tokens"])


def _in_order(run: Callable, schema: str, rows: DataFrame, key: str, *order) -> DataFrame:
    return rows.repartition(key).sortWithinPartitions(*order).mapInArrow(run, schema)


# --- conversations that end at a node -----------------------------------------------

_PIECES = "n1 long, n2 long, first long, ids string"
_ENDS = "n1 long, n2 long, ends_sha256 string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order, joined per node."""
    node, ids = None, []

    def piece() -> tuple:
        return (*node, ids[0], ",".join(map(str, ids)))

    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("n1", "n2", "conv_id"))
        for n1, n2, conv_id in zip(*columns, strict=True):
            if ids and (node != (n1, n2) or len(ids) >= PIECE):
                out.append(piece())
                ids = []
            node = (n1, n2)
            ids.append(conv_id)
        yield _rows(out, _PIECES)
    if ids:
        yield _rows([piece()], _PIECES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest = None, None
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("n1", "n2", "ids"))
        for n1, n2, ids in zip(*columns, strict=True):
            if node == (n1, n2):
                digest.update(b",")
            else:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (n1, n2), hashlib.sha256()
            digest.update(ids.encode())
        yield _rows(out, _ENDS)
    if node:
        yield _rows([(*node, digest.hexdigest())], _ENDS)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    types = [pa.string() if kind == "string" else pa.int64() for _, kind in fields]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _ends(paths: DataFrame) -> DataFrame:
    """(n1, n2, ends_sha256) of every node at which conversations end."""
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = paths.where("n_convs = 1").select("n1", "n2", "conv_id")
    order = ("n1", "n2", "conv_id")
    pieces = ids.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    pieces = pieces.mapInArrow(_pieces, _PIECES).repartition("n1", "n2")
    return pieces.sortWithinPartitions("n1", "n2", "first").mapInArrow(_digests, _ENDS)


# --- the whole trie -----------------------------------------------------------------


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the least conversation of the parent, null for the root.

    The few parents with a large share of all children are broadcast, fewer than ``HOT`` rows; the
    others are joined.
    """
    total = nodes.count()
    parents = nodes.where("n_children > 0").select(
        F.col("n1").alias("p1"),
        F.col("n2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
        (HOT * F.col("n_children") > total).alias("hot"),
    )
    known = F.broadcast(parents.where("hot").drop("hot"))
    below = nodes.where("depth > 0")
    hot = below.join(known, ["p1", "p2"])
    other = below.join(known, ["p1", "p2"], "left_anti").join(
        parents.where("NOT hot").drop("hot").hint("merge"), ["p1", "p2"]
    )
    root = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return root.unionByName(hot).unionByName(other)


def trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with members, children, leaves and savings.

    A conversation is rebuilt from the first turns of its family's first one (``shared_turns``) and its
    own turns after them.
    """
    base_first = (F.col("conv_id") != F.col("family")).alias("_other")
    order = ("family", base_first, "conv_id", F.asc_nulls_first("turn"), "digest")
    first = settle(
        _in_order(partial(_members, block=block), _FIRST, _turns(conversations), "family", *order),
        "trie-paths",
    )
    paths = first.where("NOT is_node")
    merged = (
        first.where("is_node")
        .groupBy("n1", "n2")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.first("depth").alias("depth"),
            F.first("p1").alias("p1"),
            F.first("p2").alias("p2"),
            F.first("n_words").alias("n_words"),
            F.sum("n_convs").alias("n_convs"),
        )
    )
    merged = settle(merged, "trie-nodes")
    children = (
        merged.where("depth > 0")
        .groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2"))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = merged.join(children.hint("merge"), ["n1", "n2"], "left").fillna(0, "n_children")
    nodes = settle(nodes, "trie-children")

    none = F.lit(0).cast("long")
    values = nodes.select(
        "conv_id",
        "depth",
        F.lit(True).alias("is_value"),
        *(none.alias("n1"), none.alias("n2")),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"),
    )
    on_path = paths.select(
        "conv_id", "depth", F.lit(False).alias("is_value"), "n1", "n2", none.alias("leaf"), none.alias("saved")
    )
    order = ("conv_id", F.desc("depth"), F.desc("is_value"))
    sums = _in_order(
        partial(_sums, block=block), _SECOND, values.unionByName(on_path), "conv_id", *order
    )
    sums = sums.groupBy("n1", "n2").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    found = _with_parents(nodes).join(sums.hint("merge"), ["n1", "n2"])
    found = found.join(_ends(paths).hint("merge"), ["n1", "n2"], "left")
    return found.select(
        *("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
