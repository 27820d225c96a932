from __future__ import annotations

import random
from collections import defaultdict

import pytest

from chartmart.llm import mixing as m


def corpus(spark, n: int = 600):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 4)}"
        text = " ".join(["word"] * rng.choice([5, 50, 300, 900])) + (" 7" if rng.random() < 0.2 else "")
        rows.append((i, text, rng.choice(["en", "en", "de"]), source))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def shares(rows, margin: str, value) -> dict:
    out: dict = defaultdict(float)
    for r in rows:
        out[r[margin]] += value(r)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def test_weights_meet_given_and_tempered_targets(spark):
    wanted = {"lang": {"en": 0.25, "de": 0.75, "xx": 0.5}}
    rows = m.weighed(corpus(spark), targets=wanted).collect()
    cells = {(r["source"], r["lang"], r["topic"]): r for r in rows}.values()
    lang = shares(cells, "lang", lambda r: r["weight"])
    assert lang["en"] == pytest.approx(0.25, abs=1e-4) and lang["de"] == pytest.approx(0.75, abs=1e-4)
    tokens = shares(rows, "source", lambda r: r["n_tokens"])
    total = sum(v**m.TEMPER for v in tokens.values())
    found = shares(cells, "source", lambda r: r["weight"])
    assert found == pytest.approx({k: v**m.TEMPER / total for k, v in tokens.items()}, abs=1e-4)


def test_weights_match_raking_by_hand(spark):
    rows = m.weighed(corpus(spark)).collect()
    cells: dict = defaultdict(float)
    for r in rows:
        cells[(r["source"], r["lang"], r["topic"])] += r["n_tokens"]
    total = sum(cells.values())
    weight = {k: v / total for k, v in cells.items()}
    goals = []
    for at in range(3):
        part: dict = defaultdict(float)
        for k, v in cells.items():
            part[k[at]] += v
        raw = {k: v**m.TEMPER for k, v in part.items()}
        goals.append({k: v / sum(raw.values()) for k, v in raw.items()})
    for _ in range(200):
        for at, goal in enumerate(goals):
            now: dict = defaultdict(float)
            for k, v in weight.items():
                now[k[at]] += v
            weight = {k: v * goal[k[at]] / now[k[at]] for k, v in weight.items()}
    for r in rows:
        assert r["weight"] == pytest.approx(weight[(r["source"], r["lang"], r["topic"])], rel=1e-3)


def test_sample_has_the_asked_size_and_agrees_with_probabilities(spark):
    docs = corpus(spark)
    rows = m.weighed(docs).collect()
    total = sum(r["n_tokens"] for r in rows)
    assert sum(r["n_tokens"] * r["probability"] for r in rows) == pytest.approx(0.5 * total, rel=1e-3)
    drawn = {r["_row"]["doc_id"] for r in rows if r["sampled"]}
    assert {r["doc_id"] for r in m.sample(docs).collect()} == drawn
    assert len(drawn) == pytest.approx(sum(r["probability"] for r in rows), abs=60)


def test_odd_rows(clash, odd_rows, empty):
    assert m.weighed(clash).count() == len(odd_rows)
    assert m.sample(clash).columns == clash.columns
    assert m.sample(clash, keep=1.0).count() == len(odd_rows)
    assert m.sample(empty).collect() == [] and m.weighed(empty).collect() == []
