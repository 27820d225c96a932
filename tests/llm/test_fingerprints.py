from __future__ import annotations

import hashlib

from chartmart.llm import fingerprints as f
from tests.llm.conftest import prose


def test_insertions_move_only_cuts_beside_them():
    text = " ".join(prose(3, 1500))
    ends = f.cuts(text.encode())
    assert ends[-1] == len(text) and max(b - a for a, b in zip([0, *ends], ends)) <= f.MAX_BYTES
    other = text[:3000] + "inserted words" + text[3000:]
    assert f.containment(f.chunk_set(text), f.chunk_set(other)) > 0.9
    assert f.cuts(b"") == [] and f.cuts(b"abc") == [3]
    assert f.containment({}, {}) == 1 and f.containment({}, {"a": 1}) == 0


def test_gear_hash_looks_back_its_window():
    data = " ".join(prose(4, 60)).encode()
    found = f.gear_hashes(data)
    for i in (0, 5, 31, 32, 100):
        back = range(max(0, i - f.WINDOW + 1), i + 1)
        want = sum(int(f.GEAR[data[j]]) << (i - j) for j in back) & 0xFFFFFFFF
        assert int(found[i]) == want


def test_rows_match_brute_force(spark, clash, odd_rows, empty):
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for i, row in enumerate(rows):
        text, following = row[1] or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        own = f.chunk_set(text)
        want.append(
            (
                row[0],
                len(text),
                hashlib.sha256(new.encode()).hexdigest(),
                f.written(own),
                f.written(f.chunk_set(new)),
                f.containment(own, f.chunk_set(new)),
                f.containment(own, f.chunk_set(following)),
            )
        )
    found = [tuple(r) for r in f.fingerprints(clash).collect()]
    assert sorted(map(str, found)) == sorted(map(str, want))
    assert f.fingerprints(empty).collect() == []


def test_many_ranges(spark):
    rows = [(i * 7, f"text number {i} " * (i % 5)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = {r["doc_id"]: r for r in f.fingerprints(docs).collect()}
    assert len(found) == 300
    for i, (doc_id, text) in enumerate(rows):
        new = f.edited(text, rows[(i + 1) % 300][1])
        assert found[doc_id]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
