from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from chartmart.llm import periodic_runs as p
from tests.llm.conftest import prose


def brute(ids):
    """Every maximal stretch of each period, those with a smaller period left out."""
    found = []
    for q in range(1, len(ids) // 4 + 1):
        i = 0
        while i + q < len(ids):
            j = i
            while j + q < len(ids) and ids[j] == ids[j + q]:
                j += 1
            n = j - i + q
            if n >= max(6, 4 * q) and not any(
                all(ids[k] == ids[k + d] for k in range(i, i + n - d)) for d in range(1, q)
            ):
                found.append((i, n, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def _loops(rng):
    """Repeated stretches of few or many different words, side by side, cut anywhere."""
    kinds, ids = rng.choice([1, 2, 3, 5, 50]), []
    for _ in range(rng.randint(0, 5)):
        size = rng.choice([1, 2, 3, 5, 15, 16, 17, 20, 31, 32, 33, 40, 64, 70])
        loop = [rng.randrange(kinds) for _ in range(size)]
        ids += loop * rng.randint(1, 6) + loop[: rng.randint(0, size)]
        ids += [rng.randrange(kinds) for _ in range(rng.randint(0, 10))]
    return ids


def test_runs_match_brute_force():
    rng, found = random.Random(1), 0
    for _ in range(250):
        texts = [_loops(rng) for _ in range(rng.randint(1, 6))]
        got = p.runs_of([np.array(t, np.int64) for t in texts])
        assert got == [brute(t) for t in texts]
        found += sum(map(len, got))
    assert found > 1000


@given(st.lists(st.integers(0, 2), max_size=120))
@settings(max_examples=300, deadline=None)
def test_runs_of_few_different_words(ids):
    assert p.runs_of([np.array(ids, np.int64)]) == [brute(ids)]


def test_one_long_run_takes_no_longer_than_prose():
    for loop in ([0], [0, 1, 2], list(range(1000)), list(range(49_999))):
        ids = np.array((loop * (200_000 // len(loop) + 1))[:200_000])
        assert p.runs_of([ids]) == [[(0, 200_000, len(loop))]]


def test_leftmost_least_of_each_window():
    rng = np.random.default_rng(2)
    for width in (1, 2, 8, 16):
        h = rng.integers(0, 5, 200).astype(np.uint64)
        want = sorted({i + int(h[i : i + width].argmin()) for i in range(len(h) - width + 1)})
        assert p.minimizers(h, width).tolist() == want


def _want(doc_id, text, looped):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if looped and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0 and n:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a, q = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % q] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, *digests)


def test_rows_match_brute_force(spark, clash, odd_rows, empty):
    found = [tuple(r) for r in p.collapsed(clash).collect()]
    rows = [(d, t) for d, t, *_ in odd_rows if len(t or "") < 20_000]
    want = [_want(d, t, False) for d, t in rows]
    assert set(map(str, want)) <= set(map(str, found)) and len(found) == len(odd_rows)
    assert p.collapsed(empty).collect() == []
    texts = [" ".join(prose(i, i % 130)) + "\n" * (i % 3) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = sorted(tuple(r) for r in p.collapsed(docs, p.looped).collect())
    assert found == [_want(i, t, True) for i, t in enumerate(texts)]
    assert sum(r[1] > 0 for r in found) >= 15
