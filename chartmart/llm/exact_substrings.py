"""Removal of repeated byte strings by a bucketed suffix array with two-stage sorting.

A byte goes when a string of ``LENGTH`` bytes that covers it starts anywhere else too.

1. Buckets. Every window of ``LENGTH`` bytes belongs to its anchor: the leftmost of its ``GRAM``-byte
   strings with the least hash. Equal windows have equal anchors at equal places, so only anchors
   whose gram occurs twice matter, and windows of different grams need not be compared. A bucket is
   the text around all occurrences of some such grams. Grams with very many occurrences are split
   into shares of ``SHARE`` and their windows are matched across shares by hash afterwards.
2. Suffix array of a bucket by two-stage sorting: suffixes smaller than their successors are sorted
   directly, word by word, as far as the window length; a scan of the buckets of first bytes in
   ascending order then places every other suffix by the place of its successor.
3. Common prefixes of adjacent suffixes: windows with a neighbour of ``LENGTH`` equal bytes repeat.

Defined cases: null and empty texts have no bytes and lose none, nor do texts shorter than a window;
matches never cross documents; equal rows, also those that repeat a doc_id, are copies of each other;
overlapping occurrences count. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.llm.common import settle

LENGTH = 200
GRAM = 32
SHARE = 8_000  # occurrences of one gram that are sorted together
BLOCK_BYTES = 1_500_000  # a block's arrays stay in the processor's cache

_GRAMS = LENGTH - GRAM + 1  # grams in a window
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_COUNT_BITS, _BACK_BITS, _SHARE_BITS = 8, 8, 16


def _words(b: np.ndarray, order: str = "<u8") -> np.ndarray:
    """The eight bytes from each place on, zeros after the end."""
    padded = np.zeros(len(b) + 8, np.uint8)
    padded[: len(b)] = b
    view = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(b)]
    return np.ascontiguousarray(view).view(order).ravel()


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of each ``GRAM`` bytes."""
    n = len(b) - GRAM + 1
    w = _words(b)
    h = w[:n].copy()
    for at in range(8, GRAM, 8):
        h = (h ^ (h >> np.uint64(29))) * _M1 + w[at : at + n]
    h = (h ^ (h >> np.uint64(32))) * _M2
    return h ^ (h >> np.uint64(29))


def _least_in_windows(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value (of its high half) in each window, by doubling.

    Value and place share a word, so a plain minimum finds both.
    """
    low = np.uint64(0xFFFFFFFF)
    least, span = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return (least & low).astype(np.int64)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text: gram hash, place, first window and number of windows of each."""
    b = np.frombuffer(data, np.uint8)
    if len(b) < LENGTH:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    h = gram_hashes(b)
    of = _least_in_windows(h, _GRAMS)
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    count = np.diff(np.concatenate([first, [len(of)]]))
    return h[of[first]], of[first], first, count


def _packed(place: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (place << (_BACK_BITS + _COUNT_BITS)) | ((place - first) << _COUNT_BITS) | (count - 1)


def _unpacked(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Place, first window, number of windows and shares."""
    place = (x >> (_BACK_BITS + _COUNT_BITS)) & ((1 << 31) - 1)
    back = (x >> _COUNT_BITS) & ((1 << _BACK_BITS) - 1)
    shares = (x >> (31 + _BACK_BITS + _COUNT_BITS)) + 1
    return place, place - back, (x & ((1 << _COUNT_BITS) - 1)) + 1, shares


def _bytes_of(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams, rids, packed = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("rid", "text"))
        for rid, text in zip(*columns, strict=True):
            h, place, first, count = anchors(_bytes_of(text))
            grams.append(h.view(np.int64))
            rids.append(np.full(len(h), rid, np.int64))
            packed.append(_packed(place, first, count))
        if grams:
            arrays = [pa.array(np.concatenate(x)) for x in (grams, rids, packed)]
            yield pa.RecordBatch.from_arrays(arrays, ["gram", "rid", "packed"])


_CONTEXT = "gram long, share int, shares int, rid long, start long, n int, context binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text around each shared anchor: its windows from first to last."""
    names = [f.split()[0] for f in _CONTEXT.split(", ")]
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    for batch in batches:
        out: list[list] = [[] for _ in names]
        columns = (batch.column(c).to_pylist() for c in ("rid", "text", "anchors"))
        for rid, text, packed in zip(*columns, strict=True):
            data = _bytes_of(text)
            place, first, count, shares = _unpacked(np.unique(np.array(packed, np.int64)))
            b = np.frombuffer(data, np.uint8)
            grams = gram_hashes(b)[place].view(np.int64)
            # Which share an occurrence is in need not be the same for equal rows.
            share = ((place * 31 + rid) & 0x7FFFFFFF) % shares
            out[0] += grams.tolist()
            out[1] += share.tolist()
            out[2] += shares.tolist()
            out[3] += [rid] * len(place)
            out[4] += first.tolist()
            out[5] += count.tolist()
            out[6] += [
                data[s : s + n + LENGTH - 1]
                for s, n in zip(first.tolist(), count.tolist(), strict=True)
            ]
        arrays = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names)


# ---- the suffix array of a bucket ---------------------------------------------------------------


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last one counts as greater."""
    n = len(t)
    up = np.zeros(n, bool)
    up[:-1] = t[:-1] < t[1:]
    differs = np.ones(n, bool)
    differs[:-1] = t[:-1] != t[1:]
    # Within a run of equal bytes the byte after the run decides.
    at = np.where(differs, np.arange(n), n)
    decisive = np.minimum.accumulate(at[::-1])[::-1]
    return up[decisive]


def _sort_directly(places: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places ordered by their suffixes as far as ``LENGTH`` bytes, eight at a time.

    Words are compared within the groups that are still tied; groups that agree need no sorting.
    """
    last = len(words) - 1
    order = places[np.argsort(words[places], kind="stable")]
    tied = np.zeros(len(order), bool)  # tied with the one before
    key = words[order]
    tied[1:] = key[1:] == key[:-1]
    for at in range(8, LENGTH, 8):
        member = tied.copy()
        member[:-1] |= tied[1:]
        index = np.flatnonzero(member)
        if not len(index):
            break
        word = words[np.minimum(order[index] + at, last)]
        follows = tied[index]
        differs = np.zeros(len(index), bool)
        differs[1:] = follows[1:] & (word[1:] != word[:-1])
        if differs.any():
            group = np.cumsum(~follows)
            mixed = np.zeros(group[-1] + 1, bool)
            mixed[group[differs]] = True
            some = np.flatnonzero(mixed[group])
            new = some[np.lexsort((word[some], group[some]))]
            order[index[some]] = order[index[new]]
            word[some] = word[new]
            differs = np.zeros(len(index), bool)
            differs[1:] = follows[1:] & (word[1:] != word[:-1])
            tied[index[differs]] = False
    return order


def suffix_order(t: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places where ``wanted`` is set, ordered by their suffixes as far as ``LENGTH`` bytes."""
    n = len(t)
    up = smaller_than_next(t)
    # A place that is induced needs its successor, as far as the next directly sorted one.
    member = wanted.copy()
    edge = np.flatnonzero(wanted[:-1] & ~up[:-1] & ~wanted[1:]) + 1
    while len(edge):
        member[edge] = True
        edge = edge[(~up[edge]) & (edge + 1 < n)] + 1
        edge = edge[~member[edge]] if len(edge) else edge
    direct = _sort_directly(np.flatnonzero(member & up), _words(t, ">u8"))
    induced = np.flatnonzero(member & ~up)
    by_byte = induced[np.argsort(t[induced], kind="stable")]
    cut_direct = np.searchsorted(t[direct], np.arange(257))
    cut_induced = np.searchsorted(t[by_byte], np.arange(257))
    rank = np.full(n + 1, -1, np.int64)  # the empty suffix after the end is the least
    next_byte = np.full(n, -1, np.int64)
    next_byte[:-1] = t[1:]
    parts, done = [], 0

    def place(found: np.ndarray) -> None:
        nonlocal done
        rank[found] = np.arange(done, done + len(found))
        done += len(found)
        parts.append(found)

    for byte in range(256):
        here = by_byte[cut_induced[byte] : cut_induced[byte + 1]]
        level = here[next_byte[here] < byte]
        level = level[np.argsort(rank[level + 1], kind="stable")]
        while len(level):  # then those that only a run of this byte parts from these
            place(level)
            level = level[level > 0] - 1
            level = level[member[level] & (t[level] == byte)]
        place(direct[cut_direct[byte] : cut_direct[byte + 1]])
    order = np.concatenate(parts) if parts else induced
    return order[wanted[order]]


def repeated(t: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted wanted places, and whether each shares ``LENGTH`` bytes with the one before."""
    order = suffix_order(t, wanted)
    words = _words(t)
    same = np.zeros(len(order), bool)
    pair = np.arange(1, len(order))
    for at in range(0, LENGTH, 8):
        a, b = order[pair - 1] + at, order[pair] + at
        pair = pair[words[a] == words[b]]
    same[pair] = True
    return order, same


_FOUND = "key long, rid long, first long, last long, open boolean"


def _window_hashes(data: bytes, places: np.ndarray) -> np.ndarray:
    return np.array(
        [
            int.from_bytes(hashlib.blake2b(data[p : p + LENGTH], digest_size=8).digest(), "little", signed=True)
            for p in places.tolist()
        ],
        np.int64,
    )


def _sort_block(rows: list[tuple]) -> pa.RecordBatch:
    """Runs of repeated windows of a bucket; for split grams also one of each window, still open."""
    data = b"".join(r[5] for r in rows)
    t = np.frombuffer(data, np.uint8)
    n = np.array([r[4] for r in rows], np.int64)
    length = np.array([len(r[5]) for r in rows], np.int64)
    begin = np.cumsum(length) - length
    wanted = np.zeros(len(t), bool)
    owner = np.repeat(np.arange(len(rows)), n)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    place = begin[owner] + within
    wanted[place] = True
    order, same = repeated(t, wanted)
    twice = same.copy()
    twice[:-1] |= same[1:]
    hit = np.zeros(len(t), bool)
    hit[order[twice]] = True
    flag = hit[place]
    starts = flag & np.concatenate([[True], ~flag[:-1] | (owner[1:] != owner[:-1])])
    ends = flag & np.concatenate([~flag[1:] | (owner[1:] != owner[:-1]), [True]])
    rid = np.array([r[2] for r in rows], np.int64)
    start = np.array([r[3] for r in rows], np.int64)
    a, b = np.flatnonzero(starts), np.flatnonzero(ends)
    out_rid, first = rid[owner[a]], start[owner[a]] + within[a]
    last = start[owner[b]] + within[b]
    key, is_open = out_rid.copy(), np.zeros(len(a), bool)
    split = np.array([r[1] > 1 for r in rows])
    if split.any():
        row_of = np.full(len(t), -1, np.int64)
        row_of[place] = owner
        one = order[~same]
        one = one[split[row_of[one]]]
        at = start[row_of[one]] + one - begin[row_of[one]]
        key = np.concatenate([key, _window_hashes(data, one)])
        out_rid = np.concatenate([out_rid, rid[row_of[one]]])
        first, last = np.concatenate([first, at]), np.concatenate([last, at])
        is_open = np.concatenate([is_open, np.ones(len(one), bool)])
    names = [f.split()[0] for f in _FOUND.split(", ")]
    arrays = [pa.array(x) for x in (key, out_rid, first, last, is_open)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by gram and share; a block ends between two of them."""
    rows: list[tuple] = []
    held, now = 0, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("gram", "share", "shares", "rid", "start", "n", "context")]
        for gram, share, shares, rid, start, n, context in zip(*columns, strict=True):
            if (gram, share) != now:
                if held >= BLOCK_BYTES:
                    yield _sort_block(rows)
                    rows, held = [], 0
                now = (gram, share)
            rows.append((gram, shares, rid, start, n, context))
            held += len(context)
    if rows:
        yield _sort_block(rows)


def _settle_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Closed runs as they are; open windows where another share of their gram holds them too.

    Rows come ordered with open windows of one hash together: at most one per share.
    """
    same: list[tuple] = []
    for batch in batches:
        out: list[tuple] = []
        columns = (batch.column(f.split()[0]).to_pylist() for f in _FOUND.split(", "))
        for key, rid, first, last, is_open in zip(*columns, strict=True):
            if not is_open:
                out.append((rid, first, last))
                continue
            if same and same[0][0] != key:
                out += [s[1:] for s in same] if len(same) > 1 else []
                same = []
            same.append((key, rid, first, last))
        yield _spans(out)
    yield _spans([s[1:] for s in same] if len(same) > 1 else [])


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["rid", "first", "last"]
    )


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def without(data: bytes, runs: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside all windows that start in the given runs, and the number of removed runs."""
    kept, at, n, end = [], 0, 0, -1
    for first, last in sorted(runs):
        if first > end or end < 0:
            n += 1
        if first > at:
            kept.append(data[at:first])
        at = end = max(at, last + LENGTH)
    kept.append(data[at:])
    return b"".join(kept), n


def removed(docs: DataFrame) -> DataFrame:
    """Every document with its byte counts, digest of the kept bytes, and those bytes."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # A row is known by a hash of its content: equal rows are alike anyway. Both joins with the
    # texts use this one relation, so Spark moves the texts once.
    rows = rows.select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")
    found = rows.select("rid", "text").mapInArrow(_anchor_rows, "gram long, rid long, packed long")
    shared = found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    shares = F.least(F.ceil(F.col("n") / SHARE), F.lit(1 << _SHARE_BITS)) - 1
    shift = 31 + _BACK_BITS + _COUNT_BITS
    shared = shared.select("gram", F.shiftleft(shares.cast("long"), shift).alias("shares"))
    # Written, so that Spark can split the occurrences of a frequent gram in the join.
    shared = settle(shared, "grams")
    near = found.join(shared.hint("merge"), "gram").select(
        "rid", F.col("packed").bitwiseOR(F.col("shares")).alias("packed")
    )
    near = near.groupBy("rid").agg(F.collect_list("packed").alias("anchors"))
    # All columns stay, also doc_id: a narrower relation would be moved on its own.
    around = rows.join(near.hint("merge"), "rid").mapInArrow(_contexts, _CONTEXT)
    buckets = around.repartition(parts, "gram", "share").sortWithinPartitions("gram", "share")
    runs = buckets.mapInArrow(_sort_buckets, _FOUND)
    runs = runs.repartition(parts, "key").sortWithinPartitions("open", "key")
    runs = runs.mapInArrow(_settle_open, "rid long, first long, last long")
    runs = runs.groupBy("rid").agg(F.collect_list(F.struct("first", "last")).alias("runs"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _RESULT.split(", ")]
        types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "runs"))
            for doc_id, text, own in zip(*columns, strict=True):
                data = _bytes_of(text)
                left, n = without(data, [(r["first"], r["last"]) for r in own or ()])
                digest = hashlib.sha256(left).hexdigest()
                out.append((doc_id, len(data), len(data) - len(left), n, digest, left))
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.join(runs.hint("merge"), "rid", "left").mapInArrow(finish, _RESULT)
