r"""Periodic runs of words: maximal stretches that repeat with a period, found by multi-scale minimizers.

A run is a stretch of words with smallest period q and at least ``max(LEAST, FOLD * q)`` words that no
neighbouring word extends. For periods from P to 2P - 1 (a scale; P doubles) every position has the hash
of the 2P words from it, and the leftmost least hash of every P neighbouring positions is a minimizer.
Inside a run of period q the windows at i and i + q hold the same words, so a minimizer recurs q words
on. As the hashed words are more than a period, two equal ones inside a run lie a multiple of q apart
(else the run had a smaller period), so the next equal minimizer is exactly q words on: each minimizer
is paired with the next equal one of its scale and no other, and a pair at a distance that belongs to
the scale seeds a comparison of words at that lag in both directions. A window and its copy take 3P + q
words at most, fewer than four periods, so no run is missed. Periods below ``SHORT`` are found by
comparing all words with those q on. Hashes only choose; words are compared by exact numbers.

Many short texts are searched as one sequence, with a number of its own between two texts. Time is in
proportion to the words times the logarithm of the longest text, also in texts that are one long run.

Defined cases: words are runs of other than ASCII white space; null, empty and blank texts have no words
and no runs; every row gets a result, repeated ones too; a null doc_id is kept and its text is never
rewritten. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST, FOLD = 6, 4
SHORT = 16  # scales begin here, a power of two
_BLOCK = 1 << 20  # bytes of text searched at once

Runs = list[tuple[int, int, int]]  # (start, length, period)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _least(period: int) -> int:
    return max(LEAST, FOLD * period)


def _equal_ahead(ids: np.ndarray, a: int, b: int) -> int:
    """How many words from ``a`` on equal those from ``b`` on (a < b)."""
    done, step = 0, 32
    while b + done < len(ids):
        size = min(step, len(ids) - b - done)
        other = ids[a + done : a + done + size] != ids[b + done : b + done + size]
        if other.any():
            return done + int(other.argmax())
        done, step = done + size, step * 2
    return done


def _equal_behind(ids: np.ndarray, a: int, b: int) -> int:
    """How many words before ``a`` equal those before ``b`` (a < b)."""
    done, step = 0, 32
    while a - done > 0:
        size = min(step, a - done)
        other = ids[a - done - size : a - done] != ids[b - done - size : b - done]
        if other.any():
            return done + int(other[::-1].argmax())
        done, step = done + size, step * 2
    return done


def _divisors(q: int) -> list[int]:
    """q divided by each of its primes."""
    found, rest, p = [], q, 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            found.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return found


def _smallest(ids: np.ndarray, start: int, q: int) -> bool:
    """Whether a stretch of period q, twice as long or more, has no smaller period."""
    one = ids[start : start + q]
    return not any(np.array_equal(one, ids[start + d : start + d + q]) for d in _divisors(q))


def _short_runs(ids: np.ndarray, q: int) -> Runs:
    """Runs of period q by comparing all words with those q on."""
    same = np.flatnonzero(ids[q:] == ids[:-q])
    if not len(same):
        return []
    ends = np.append(np.flatnonzero(np.diff(same) != 1), len(same) - 1)
    first = np.append(0, ends[:-1] + 1)
    long = ends - first + 1 + q >= _least(q)
    found = zip(same[first[long]].tolist(), (ends - first + 1)[long].tolist(), strict=True)
    return [(start, n + q, q) for start, n in found if _smallest(ids, start, q)]


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions of the leftmost least value of every ``width`` neighbours, a power of two."""
    at, step = np.arange(len(hashes)), 1
    while step < width:
        left, right = at[:-step], at[step:]
        at = np.where(hashes[right] < hashes[left], right, left)
        step *= 2
    keep = np.ones(len(at), bool)
    keep[1:] = at[1:] != at[:-1]
    return at[keep]


def _scale_runs(ids: np.ndarray, hashes: np.ndarray, scale: int) -> Runs:
    """Runs of periods from ``scale`` to twice as much; ``hashes`` are of 2 * scale words each."""
    at = minimizers(hashes, scale)
    order = np.argsort(hashes[at], kind="stable")
    at = at[order]
    lag = at[1:] - at[:-1]
    pair = (hashes[at[1:]] == hashes[at[:-1]]) & (lag >= scale) & (lag < 2 * scale)
    lags, seeds = lag[pair], at[:-1][pair]
    order = np.lexsort((seeds, lags))
    found, known, until = [], 0, 0
    for q, seed in zip(lags[order].tolist(), seeds[order].tolist(), strict=True):
        if q == known and seed < until:
            continue
        start = seed - _equal_behind(ids, seed, seed + q)
        end = seed + q + _equal_ahead(ids, seed, seed + q)
        known, until = q, end - q
        if end - start >= _least(q) and _smallest(ids, start, q):
            found.append((start, end - start, q))
    return found


def _searched(ids: np.ndarray, longest: int) -> Runs:
    """All runs of a sequence whose texts have up to ``longest`` words."""
    found = []
    for q in range(1, min(SHORT, longest // FOLD + 1)):
        found += _short_runs(ids, q)
    hashes, words, scale = _mix(ids.astype(np.uint64) + np.uint64(1)), 1, SHORT
    while FOLD * scale <= longest:
        while words < 2 * scale:
            if words >= len(hashes):
                return found
            hashes = _mix(hashes[:-words] * np.uint64(0x9E3779B97F4A7C15) + hashes[words:])
            words *= 2
        found += _scale_runs(ids, hashes, scale)
        scale *= 2
    return found


def runs_of(texts: list[np.ndarray]) -> list[Runs]:
    """Runs of every text, by start and period; texts are arrays of word numbers."""
    out: list[Runs] = [[] for _ in texts]
    # Long texts first: a scale is searched only where a text is long enough for it.
    order = sorted((i for i in range(len(texts)) if len(texts[i]) >= LEAST), key=lambda i: -len(texts[i]))
    group = 0
    while group < len(order):
        longest = len(texts[order[group]])
        size = group
        while size < len(order) and 2 * len(texts[order[size]]) > longest:
            size += 1
        members = order[group:size]
        lengths = np.array([len(texts[i]) for i in members])
        starts = np.append(0, np.cumsum(lengths + 1)[:-1])
        ids = np.empty(int(lengths.sum()) + len(members), np.int64)
        ids[starts + lengths] = -1 - np.arange(len(members))
        for start, i in zip(starts.tolist(), members, strict=True):
            ids[start : start + len(texts[i])] = texts[i]
        for start, length, q in _searched(ids, longest):
            k = int(np.searchsorted(starts, start, side="right")) - 1
            out[members[k]].append((start - int(starts[k]), length, q))
        group = size
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_places(n: int, runs: Runs) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def strongest(runs: Runs) -> tuple[int, int, int, int] | None:
    """The run with most repetitions and its length by its period, in thousandths."""
    best = None
    for start, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (start, length, q)
    return (*best, 1000 * best[1] // best[2]) if best else None


def unchanged(doc_id: int | None, n: int) -> np.ndarray:
    return np.arange(n)


def looped(doc_id: int | None, n: int) -> np.ndarray:
    """Which word stands at each place: in a tenth of the documents a stretch is repeated to the end."""
    places = np.arange(n)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        places[a:] = a + (places[a:] - a) % p
    return places


SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")]
    + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
)


def _results(ids: list, texts: list[str | None], placed: Callable) -> pa.RecordBatch:
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    words, places, coded = [], [], []
    for doc_id, text in zip(ids, texts, strict=True):
        found = (text or "").encode("utf-8", "surrogatepass").split()
        at = placed(doc_id, len(found))
        code = np.fromiter(map(numbers.__getitem__, found), np.int64, len(found))
        words.append(found)
        places.append(at)
        coded.append(code[at])
    rows = []
    for doc_id, found, at, runs in zip(ids, words, places, runs_of(coded), strict=True):
        if runs:
            at = at[kept_places(len(at), runs)]
        kept = map(found.__getitem__, at.tolist())
        listed = "".join(f"{start},{length},{q}\n" for start, length, q in runs)
        rows.append(
            (
                doc_id,
                len(runs),
                *(strongest(runs) or (None,) * 4),
                hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(b" ".join(kept)).hexdigest(),
            )
        )
    columns = zip(*rows, strict=True) if rows else [[] for _ in _SCHEMA]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def _search(batches: Iterator[pa.RecordBatch], placed: Callable) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))
        first = size = 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size >= _BLOCK or i + 1 == len(texts):
                yield _results(ids[first : i + 1], texts[first : i + 1], placed)
                first, size = i + 1, 0


def collapsed(docs: DataFrame, placed: Callable = unchanged) -> DataFrame:
    """Runs of every document: their number, the strongest, and digests of all and of the words left.

    ``placed(doc_id, n)`` may give another order of the n words of a text before it is searched.
    """
    rows = docs.selectExpr("cast(doc_id AS long) AS doc_id", "text")
    return rows.mapInArrow(partial(_search, placed=placed), SCHEMA)
