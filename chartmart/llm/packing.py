"""Packing token sequences: dominance reduction, then best fit.

Documents are tokenised, cut where they are longer than a sequence, and packed by length alone. The
lengths form a histogram with at most ``capacity`` entries whatever the number of documents, so the
packing is decided on it: first sets of pieces that provably dominate every alternative are fixed
(one piece that fits with nothing, two pieces that fill a sequence exactly, the largest partner where
no two pieces fit beside the given one) until nothing more is fixed, then best fit, long pieces
first, packs the rest. The plan says which run of each length goes where; Spark numbers the pieces
of each length and looks their places up.

Defined cases: null is the empty text, which is one piece holding id 0; repeated rows are packed
each; the longest documents give full pieces, the first of a document may be shorter; no rows give no
rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chartmart.llm.common import settle

CAPACITY = 2048
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"  # one vocabulary, two forms
SPECIAL = "<|endoftext|>"
END_ID = 0
CACHE_WORDS = 600_000

_NO_SPACE = "\x00"  # marks a word without a space before it


class Encoder:
    """Ids of a text as little-endian 32-bit bytes, through a cache of words.

    The tokenizer never joins across a space or a line end except where several white space
    characters meet; there, and where a text holds the mark or the special token, it gets the whole
    text. Everywhere else each distinct word is merged once, from the same vocabulary read as ranks,
    which is ten times as fast for single words.
    """

    def __init__(self, path: str, ranks: str):
        self._path, self._tokenizer = path, None
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._merge = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        ).encode_to_numpy
        self._end_id = table[b"\n"]
        self._end = np.array([self._end_id], "<u4").tobytes()
        self._words: dict[str, bytes] = {"\n": self._end}

    def _whole(self, text: str) -> bytes:
        if self._tokenizer is None:
            self._tokenizer = Tokenizer.from_file(self._path)
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, keys: set[str]) -> None:
        """Encodes new words in one go, each ended by a line end, whose id no word contains."""
        if len(self._words) + len(keys) > CACHE_WORDS:
            self._words.clear()
            self._words["\n"] = self._end
        found, lines = [], []
        for key in keys:
            bare = key[0] == _NO_SPACE
            word = key[1:] if bare else key
            if word and not word[0].isspace() and not word[-1].isspace():
                found.append(key)  # others stay unknown: their texts are encoded whole
                lines.append(word if bare else " " + word)
        lines.append("")
        ids = self._merge("\n".join(lines), disallowed_special=()).astype("<u4", copy=False)
        data, start = ids.tobytes(), 0
        for key, end in zip(found, np.flatnonzero(ids == self._end_id).tolist(), strict=True):
            self._words[key] = data[4 * start : 4 * end]
            start = end + 1

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if _NO_SPACE in text or SPECIAL in text:
            return self._whole(text)
        keys = (_NO_SPACE + text.replace("\n", f" \n {_NO_SPACE}")).split(" ")
        try:
            return b"".join([self._words[k] for k in keys])
        except KeyError:
            pass
        if "" in keys or _NO_SPACE in keys:
            return self._whole(text)
        self._learn(set(keys).difference(self._words))
        try:
            return b"".join([self._words[k] for k in keys])
        except KeyError:  # white space of another kind, or more words than the cache holds
            return self._whole(text)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, ranks: str | None = None
) -> DataFrame:
    """Pieces of every document: its ids and an end id, cut into runs of ``capacity``."""
    path = path or public_tokenizers.path(VOCABULARY)
    ranks = ranks or public_tokenizers.path(RANKS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = Encoder(path, ranks), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = encode(text or "") + end
                n = len(data) // 4
                start, stop, k = 0, (n - 1) % capacity + 1, 0
                while start < n:
                    crc = zlib.crc32(data[4 * start : 4 * stop])
                    out.append((doc_id, k, start, stop - start, crc))
                    start, stop, k = stop, stop + capacity, k + 1
            if out:
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = zip(zip(*out, strict=True), types, strict=True)
                names = [field.split()[0] for field in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


class _Lengths:
    """Counts by length, with the lengths in use in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {k: v for k, v in counts.items() if v > 0}
        self.order = sorted(self.n)

    def take(self, length: int, n: int) -> None:
        self.n[length] -= n
        if not self.n[length]:
            del self.n[length]
            self.order.pop(bisect_left(self.order, length))

    def largest_up_to(self, length: int) -> int | None:
        k = bisect_left(self.order, length + 1)
        return self.order[k - 1] if k else None

    def two_smallest(self) -> int | None:
        """Sum of the two shortest pieces, None where fewer are left."""
        if not self.order:
            return None
        first = self.order[0]
        if self.n[first] > 1:
            return 2 * first
        return first + self.order[1] if len(self.order) > 1 else None


def reduce(left: _Lengths, capacity: int) -> list[tuple[int, list[int]]]:
    """Takes dominating sets out of ``left``: (how many sequences, lengths in each)."""
    fixed: list[tuple[int, list[int]]] = []
    changed = True
    while changed:
        changed = False
        for length in reversed(list(left.order)):
            while length in left.n:
                room = capacity - length
                own = left.n[length]
                left.n[length] -= 1  # the partner must be another piece
                partner = left.largest_up_to(room)
                if partner == length and not left.n[length]:
                    k = bisect_left(left.order, length)
                    partner = left.order[k - 1] if k else None
                pair = None
                if partner is not None:
                    exact = length + partner == capacity
                    hidden = not left.n[length]
                    if hidden:
                        del left.n[length]
                        left.order.pop(bisect_left(left.order, length))
                    two = left.two_smallest()
                    if hidden:
                        left.n[length] = 0
                        insort(left.order, length)
                    pair = exact or two is None or two > room
                left.n[length] += 1
                if partner is None:
                    fixed.append((own, [length]))
                    left.take(length, own)
                elif pair:
                    n = own // 2 if partner == length else min(own, left.n[partner])
                    if not n:
                        break
                    fixed.append((n, [length, partner]))
                    left.take(length, n)
                    left.take(partner, n)
                else:
                    break
                changed = True
    return fixed


def best_fit(left: _Lengths, capacity: int) -> list[tuple[int, list[int]]]:
    """Packs the rest, long pieces first, each into the fullest sequence that still takes it."""
    open_: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    rooms: list[int] = []
    done: list[tuple[int, list[int]]] = []

    def put(n: int, items: list[int], room: int) -> None:
        if not n:
            return
        if not room:
            done.append((n, items))
            return
        if not open_[room]:
            insort(rooms, room)
        open_[room].append((n, items))

    while left.order:
        length = left.order[-1]
        n = left.n[length]
        left.take(length, n)
        while n:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                bins, items = open_[room].pop()
                if not open_[room]:
                    rooms.pop(k)
            else:
                room, bins, items = capacity, n, []
            each = min(room // length, n)
            full = min(bins, n // each)
            put(bins - full, items, room) if items else None
            put(full, items + [length] * each, room - each * length)
            n -= full * each
            if 0 < n < each and full == bins and not items:
                put(1, [length] * n, capacity - n * length)
                n = 0
    return done + [x for group in open_.values() for x in group]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(how many sequences, lengths in each) that hold all pieces.

    Longest first within a sequence; the number of entries depends on the distinct lengths only.
    """
    left = _Lengths(counts)
    return reduce(left, capacity) + best_fit(left, capacity)


def places(entries: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length the runs of its pieces: first rank, first sequence, slots each, offset."""
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    first = 0
    for n, items in entries:
        offset, i = 0, 0
        while i < len(items):
            length, each = items[i], 1
            while i + each < len(items) and items[i + each] == length:
                each += 1
            runs[length].append((used[length], first, each, offset))
            used[length] += n * each
            offset += length * each
            i += each
        first += n
    return {k: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for k, v in runs.items()}


def ranked(cut: DataFrame) -> DataFrame:
    """Adds ``rank``: a number from 0 within each length, without bringing a length together.

    Pieces are dealt by hash into shares of each length, numbered there, and moved up by the sizes
    of the shares before.
    """
    parts = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    sizes = dealt.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        "length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = dealt.withColumn("rank", F.row_number().over(within) - 1)
    joined = numbered.join(offsets, ["length", "share"])
    return joined.withColumn("rank", F.col("rank") + F.col("before")).drop("share", "before")


PACKED = f"{PIECES}, sequence_id long, offset long"


def pack(
    docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, ranks: str | None = None
) -> DataFrame:
    """Every piece with its sequence and its place there."""
    cut = settle(pieces(docs, capacity, path, ranks), "pieces")
    # At most one row per length up to the capacity.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    known = places(plan(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                start, first, each, place_ = known[int(n)]
                k = np.searchsorted(start, rank[at], side="right") - 1
                rel = rank[at] - start[k]
                sequence[at] = first[k] + rel // each[k]
                offset[at] = place_[k] + rel % each[k] * n
            kept = [batch.column(f.split()[0]) for f in PIECES.split(", ")]
            names = [f.split()[0] for f in PACKED.split(", ")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)

    return ranked(cut).mapInArrow(place, PACKED)
