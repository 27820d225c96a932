from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from chartmart.llm import prefix_trie as p

SCHEMA = "conv_id long, turn long, role string, text string"


def test_slots_are_a_perfect_hash_and_others_are_told_apart():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        high, low = rng.integers(-(2**63), 2**63 - 1, (2, n))
        high[: n // 2] = 7  # halves alone do not tell digests apart
        table = p.NodeTable(np.append(high, high), np.append(low, low))
        slots = table.find(high, low)
        assert sorted(slots.tolist()) == list(range(n)) and table.size == n
        assert (table.high[slots] == high).all() and (table.low[slots] == low).all()
        assert (table.find(high + 1, low) == -1).all()


def test_slots_without_free_places_in_any_level(monkeypatch):
    monkeypatch.setattr(p.NodeTable, "LEVELS", 1)
    ids = np.arange(500)
    table = p.NodeTable(ids, ids)
    assert sorted(table.find(ids, ids).tolist()) == list(range(500)) and table.rest
    assert (table.find(ids, ids + 1) == -1).all()


def test_values_add_up_through_parent_slots():
    parent, depth = np.array([-1, 0, 0, 1, 3]), np.array([0, 1, 1, 2, 3])
    values = np.array([1, 10, 100, 1000, 10000])
    p.accumulate(depth, parent, values)
    assert values.tolist() == [11111, 11010, 100, 11000, 10000]


def test_shards_hold_whole_conversations_or_pieces_of_one():
    rng = random.Random(3)
    lengths = [rng.choice([1, 2, 3, 30]) for _ in range(60)]
    conv = np.repeat(np.arange(60), lengths)
    depth = np.concatenate([np.arange(n) for n in lengths])
    for size in (1, 7, 1000):
        batches = [
            {"conv_id": conv[i : i + size], "depth": depth[i : i + size]}
            for i in range(0, len(conv), size)
        ]
        found = list(p.shards(iter(batches), 8))
        assert np.concatenate([rows["conv_id"] for rows, _ in found]).tolist() == conv.tolist()
        assert np.concatenate([rows["depth"] for rows, _ in found]).tolist() == depth.tolist()
        for (rows, goes_on), (after, _) in zip(found, found[1:]):
            same = rows["conv_id"][-1] == after["conv_id"][0]
            assert same == goes_on and (not goes_on or len(set(rows["conv_id"])) == 1)
    assert list(p.shards(iter([]), 8)) == []


def brute(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        if conv_id is None:
            continue
        role, text = role or "", text or ""
        whole = f"{len(role.encode())}:{role}{text}".encode()
        key = (turn is not None, turn or 0, hashlib.sha256(whole).digest())
        convs.setdefault(conv_id, []).append((key, (role, text)))
    convs = {c: [turn for _, turn in sorted(turns)] for c, turns in convs.items()}
    members, ends = {}, {}
    for c, own in convs.items():
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 4
        turns = own if base == c else convs.get(base, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        deeper = {n[:-1] for n in below if n}
        saved = sum((len(members[n]) - 1) * len(n[-1][1].split()) for n in below if n)
        listed = ",".join(map(str, sorted(ends.get(node, []))))
        out.append(
            (
                min(inside),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(inside),
                sum(n[:-1] == node for n in below if n),
                sum(n not in deeper for n in below),
                saved,
                hashlib.sha256(listed.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def _rows():
    rng = random.Random(4)
    texts = ["", "a", "a b", "c  d\te", "f"]
    rows = [
        (i, t, rng.choice(["user", "assistant", None]), rng.choice(texts))
        for i in [*range(0, 45), *range(60, 75), 81, 85, 119, -1, -20, -25]
        for t in range(rng.choice([1, 2, 4, 6]))
    ]
    rows += [(i, t, "user", "same") for i in range(200, 230) for t in range(5)]
    rows += [(4, None, "user", None), (4, None, None, "x"), (None, 0, "user", "no id")]
    return rows + [(5, 1, "user", "twice")] * 2 + [(300, t, "user", f"long {t % 7}") for t in range(90)]


def test_nodes_match_brute_force_in_shards_of_any_size(spark):
    rows = _rows()
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    table = table.withColumns({n: F.lit(1) for n in ("family", "depth", "n1", "digest", "n_words")})
    for block in (8, 64, p.BLOCK):
        found = sorted((tuple(r) for r in p.trie(table, block).collect()), key=str)
        assert found == brute(rows)


def test_lists_of_many_conversations_are_digested_in_order(spark, monkeypatch):
    rows = [(i, 0, "user", "hello") for i in range(0, 4000, 20)]
    found = p.trie(spark.createDataFrame(rows, SCHEMA)).where("depth = 1").collect()
    listed = ",".join(str(i) for i in range(0, 4000, 20))
    assert [r.ends_sha256 for r in found] == [hashlib.sha256(listed.encode()).hexdigest()]
    batch = [(1, 2, i) for i in range(10)] + [(1, 3, 5), (2, 0, 1), (2, 0, 4)]
    monkeypatch.setattr(p, "PIECE", 4)
    pieces = list(p._pieces(iter([p._rows(batch, "n1 long, n2 long, conv_id long")])))
    digests = [r for b in p._digests(iter(pieces)) for r in b.to_pylist()]
    want = {(1, 2): "0,1,2,3,4,5,6,7,8,9", (1, 3): "5", (2, 0): "1,4"}
    assert {(r["n1"], r["n2"]): r["ends_sha256"] for r in digests} == {
        k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()
    }


def test_empty_table(spark):
    assert p.trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert p.trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []
