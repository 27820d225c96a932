from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chartmart.llm import packing as p

JSON = public_tokenizers.path(p.VOCABULARY)
ODD = [
    "a  b", "a\n\nb", " a", "a ", " \n", "\n", "a\n", "it's don't 'll x 's", "a b   c",
    "tab\tx\ty z", "", "a\r\nb \r", "é\n12 345abc, ...?!  ", "nul\x00 here", "x <|endoftext|> y",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(JSON)


def ids(tokenizer, text: str | None) -> np.ndarray:
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_cached_words_give_the_tokenizer_s_ids(tokenizer):
    rng = random.Random(1)
    parts = ["the", "The", "naïve", "12", "a1", "x's", "...", "\n", " ", "日本", "#$%", "\t", "-"]
    texts = [*ODD, *(" ".join(rng.choices(parts, k=30)) for _ in range(200))]
    texts += ["".join(rng.choices([*parts, " "], k=40)) for _ in range(200)]
    encode = p.Encoder(JSON, public_tokenizers.path(p.RANKS))
    for text in texts:
        assert encode(text) == ids(tokenizer, text)[:-1].tobytes(), repr(text)


def test_plan_holds_every_piece_once():
    rng = random.Random(2)
    for _ in range(150):
        capacity = rng.choice([10, 50, 2048])
        sizes = [rng.choice([rng.randint(1, capacity), capacity, 1 + rng.randint(0, capacity // 5)]) for _ in range(rng.randint(0, 300))]
        got: Counter = Counter()
        for n, items in p.plan(dict(Counter(sizes)), capacity):
            assert n > 0 and sum(items) <= capacity
            for item in items:
                got[item] += n
        assert got == Counter(sizes)


def test_reduction_fixes_only_what_an_optimal_packing_may_hold():
    def fewest(sizes: tuple[int, ...], capacity: int) -> int:
        best = len(sizes)

        def place(k: int, bins: list[int]) -> None:
            nonlocal best
            if len(bins) >= best:
                return
            if k == len(sizes):
                best = len(bins)
                return
            for i, room in enumerate(bins):
                if room >= sizes[k]:
                    bins[i] -= sizes[k]
                    place(k + 1, bins)
                    bins[i] += sizes[k]
            place(k + 1, [*bins, capacity - sizes[k]])

        place(0, [])
        return best

    rng = random.Random(3)
    for _ in range(80):
        sizes = tuple(sorted((rng.randint(1, 12) for _ in range(7)), reverse=True))
        left = p._Lengths(dict(Counter(sizes)))
        fixed = sum(n for n, _ in p.reduce(left, 12))
        rest = tuple(sorted((x for x, n in left.n.items() for _ in range(n)), reverse=True))
        assert fixed + fewest(rest, 12) == fewest(sizes, 12), sizes


def test_pieces_and_places(spark, clash, odd_rows, tokenizer, empty):
    rows = p.pack(clash).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for doc_id, text in {(r[0], r[1]) for r in odd_rows}:
        want = ids(tokenizer, text)
        copies = sum(r[0] == doc_id for r in odd_rows)
        found = sorted(pieces[doc_id], key=lambda r: r["piece"])
        assert sum(r["length"] for r in found) == copies * len(want)
        for r in found:
            part = want[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
            assert r["length"] == 2048 or r["piece"] == 0
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in places.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    assert p.pack(empty).collect() == []
