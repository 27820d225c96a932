from __future__ import annotations

import random

import numpy as np
import pytest

from chartmart.llm import near_duplicates as n
from chartmart.llm.components import components
from chartmart.session import using_conf
from tests.llm.conftest import prose


def brute(rows) -> dict:
    def shingles(text):
        w = (text or "").encode().lower().split()
        k = min(5, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    ids = sorted({i for i, _ in rows if i is not None})
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in ids}
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 85 * len(x | y):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    return root


def edited(words: list[str], edits: int, seed: int) -> str:
    rng = random.Random(seed)
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"edit{seed}x{at}"
    return " ".join(words)


def test_components_match_brute_force(spark):
    rows = []
    for group in range(12):
        base = prose(100 + group, 150)
        rows += [(group * 20 + k, edited(base, k % 4, group * 50 + k)) for k in range(12)]
    rows += [(900 + i, " ".join(prose(900 + i, 100))) for i in range(40)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, "A b"), (1004, "a B"), (1005, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["component_id"] for r in n.classified(docs).collect()}
    assert found == brute(rows)


def test_hub_of_a_large_group_joins_it(spark):
    # Copies differ from each other by twice as much as from the first text: only it links them.
    base = prose(7, 200)
    rows = [(500, " ".join(base))] + [(i, edited(base, 2, i)) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in n.classified(docs).collect()} == {0}


def apart(base: list[str], copies: int) -> list[tuple[int, str]]:
    """Copies of a text that is not among them: heavily edited ones, and one in forty lightly."""
    return [(i, edited(base, 1 if i % 40 == 0 else 3 + i % 3, i)) for i in range(copies)]


@pytest.mark.parametrize("parts", [1, 50])
def test_large_group_without_its_base_text(spark, parts, monkeypatch):
    # No member is a pivot for the others, and most links join one pair only.
    rows = apart(prose(8, 200), 400) + [(9_000 + i, t) for i, t in apart(prose(9, 90), 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(n, "BLOCK", 20_000)  # many blocks
    with using_conf(spark, {"spark.sql.shuffle.partitions": str(parts)}):
        found = {r["doc_id"]: r["component_id"] for r in n.classified(docs).collect()}
    assert found == brute(rows)
    assert 50 < len(set(found.values())) < 440


def test_common_counts_every_intersection():
    rng = random.Random(4)
    sets = [np.unique(np.array([rng.randrange(3000) for _ in range(k * 90)], np.uint64)) for k in range(1, 9)]
    left, right = np.array([0, 2, 4]), np.array([1, 3, 7])
    want = [[len(np.intersect1d(sets[a], sets[b])) for b in right] for a in left]
    assert n._common(sets, left, right).tolist() == want
    assert n._common([sets[0][:3], sets[1][:0]], np.array([0]), np.array([1])).tolist() == [[0]]


def test_odd_rows_and_kept(clash, odd_rows, empty):
    found = n.classified(clash).collect()
    assert len(found) == len(odd_rows)
    by = {r["doc_id"]: r["component_id"] for r in found}
    assert by[0] == 0 and by[1] == 1 and by[2] == 2 and by[4] == by[5] == by[20] == 4
    kept = n.kept(clash)
    assert kept.columns == clash.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 4 in ids and 5 not in ids and 20 not in ids and None in ids
    assert n.classified(empty).collect() == [] and n.kept(empty).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)]
    pairs += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    root: dict[int, int] = {x: x for p in pairs for x in p}
    for a, b in pairs:
        low, high = sorted((root[a], root[b]))
        root = {k: low if v == high else v for k, v in root.items()}
    found = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert {r["node"]: r["root"] for r in found} == {k: v for k, v in root.items() if k in linked}
