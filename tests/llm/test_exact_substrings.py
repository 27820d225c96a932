from __future__ import annotations

import hashlib
import random

import numpy as np

from chartmart.llm import exact_substrings as x
from tests.llm.conftest import prose


def brute(texts: list[str | None]) -> list[tuple]:
    from collections import Counter

    data = [(t or "").encode() for t in texts]
    windows = [[d[i : i + 200] for i in range(len(d) - 199)] for d in data]
    counts = Counter(w for ws in windows for w in ws)
    out = []
    for d, ws in zip(data, windows, strict=True):
        covered = np.zeros(len(d), bool)
        for i, w in enumerate(ws):
            if counts[w] > 1:
                covered[i : i + 200] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~covered])
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out.append((len(d), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def texts() -> list[str | None]:
    rng = random.Random(8)
    shared = [" ".join(prose(50 + i, 70)) for i in range(4)]
    out: list[str | None] = [None, "", "short", "a" * 700, "ab" * 300, "é😀" * 90]
    for i in range(40):
        words = prose(200 + i, rng.randint(5, 150))
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(shared)
            a = rng.randint(0, 120)
            words.insert(rng.randint(0, len(words)), part[a : a + rng.randint(150, 330)])
        out.append(" ".join(words))
    return [*out, out[10], out[11] + out[11]]


def check(spark) -> None:
    rows = texts()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    found = sorted(x.removed(docs).drop("kept").collect())
    assert [tuple(r)[1:] for r in found] == brute(rows)


def test_matches_brute_force(spark):
    check(spark)


def test_split_grams_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(x, "SHARE", 2)
    check(spark)


def test_two_stage_order_is_the_suffix_order():
    rng = random.Random(4)
    for _ in range(40):
        n = rng.randint(450, 900)
        alphabet = rng.choice([b"ab", b"abcdefgh", b"a"])
        data = bytes(rng.choice(alphabet) for _ in range(n))
        wanted = np.zeros(n, bool)
        for _ in range(5):
            at = rng.randint(0, n - 220)
            wanted[at : at + rng.randint(1, 15)] = True
        order = x.suffix_order(np.frombuffer(data, np.uint8), wanted)
        want = sorted(np.flatnonzero(wanted).tolist(), key=lambda i: data[i : i + 200])
        assert [data[i : i + 200] for i in order] == [data[i : i + 200] for i in want]


def test_odd_rows(clash, odd_rows, empty):
    found = x.removed(clash).drop("kept").collect()
    want = [(r[0], *b) for r, b in zip(odd_rows, brute([r[1] for r in odd_rows]), strict=True)]
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, want))
    assert x.removed(empty).collect() == []
