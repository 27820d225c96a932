from __future__ import annotations

import hashlib
import random
import re

from chartmart.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "mail a.b@c.example.com, x@y and @z.com a@b.c@d.e f@g.h_i@j.k ..@a.b@c.d",
    "at 10.20.30.40 not 300.1.1.1 or 1.2.3 but 1.2.3.4.5.6.7.8 and 0.0.0.0255",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 4111111111111111",
    "call +1 (743) 555-3824 or +12 or +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7",
    "é😀 a@b.cc +49 30 1234567 " * 3,
    "",
    "1" * 3000 + "." + "2" * 3000,
    "a" * 3000 + "@" + "b" * 3000,
]


def brute(text: str) -> str:
    def valid(kind: str, found: str) -> bool:
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "phone":
            return 8 <= len(digits) <= 15
        if kind == "card":
            odd = [int(c) for c in digits[-1::-2]]
            even = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
            return 16 <= len(digits) <= 19 and (sum(odd) + sum(even)) % 10 == 0
        return True

    return ",".join(
        f"{k}:{m.start()}:{m.end()}"
        for k, p in BASE.items()
        for m in re.finditer(p, text)
        if valid(k, m[0])
    )


def test_base_spans_match_the_patterns():
    for text in TEXTS:
        assert pii.written(pii.base_spans(text)) == brute(text), text[:60]


def test_shortened_repeats_are_found_and_others_left():
    texts = [
        f"Call +1 (7{i:02d}) 555-38{i:02d} today or write k.fslg{i}@mail{i}.example.com in {1990 + i}."
        for i in range(10, 90)
    ]
    model = pii.fit(texts)
    text = "She has +1 (743) 555-3824 and no other. Later 555-3824 again, in 2019 at 7.30, lot 555-9991."
    base, every = pii.spans_of([text], model)[0]
    added = {text[a:b] for k, a, b in every if (k, a, b) not in base}
    assert "555-3824" in added and "555-9991" not in added and "2019" not in added
    assert set(base) <= set(every)
    assert pii.spans_of(["Nothing here. It is 1999, page 12."], model)[0][1] == []


def test_all_repeats_of_one_mention_are_found():
    texts = [
        f"Call +1 (7{i:02d}) 555-38{i:02d} today or write k.fslg{i}@mail{i}.example.com in {1990 + i}."
        for i in range(10, 90)
    ]
    # Repeats of numbers that belong to nobody: a word is not personal for being repeated.
    texts += [" ".join([f"Lot 5{i}1-38{i} of {1900 + i}."] * 4) for i in range(10, 90)]
    model = pii.fit(texts)
    full, repeats = "+1 (743) 555-0123", [f"then 555-0123 and lot 555-99{k}." for k in range(10, 40)]
    for at in (0, 15, 30):
        text = " ".join([*repeats[:at], f"She has {full} now.", *repeats[at:]])
        base, every = pii.spans_of([text], model)[0]
        added = [text[a:b] for k, a, b in every if (k, a, b) not in base]
        assert added == ["555-0123"] * 30


def test_rare_and_late_kinds_are_in_the_sample(spark):
    rows = [(i, f"Item {i} of {i * 7919}.") for i in range(3000)]
    rows += [(5000, "Write to a.b@mail.example.com now."), (5001, "Call +1 (743) 555-0123 now.")]
    rows += [(5002, "word " * 6000 + "host 10.20.30.40 " + "word " * 6000), (5003, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = pii.training_texts(docs.coalesce(1))
    assert len(texts) == len(set(texts)) == pii.TRAIN_DOCS
    assert {k for t in texts for k, _, _ in pii.base_spans(t)} == {0, 1, 3}
    assert max(map(len, texts)) <= pii.TRAIN_CHARS
    assert texts == pii.training_texts(docs.repartition(7).orderBy("doc_id", ascending=False))


def test_query_columns_and_odd_rows(clash, odd_rows, empty):
    rows = pii.find(clash).collect()
    assert len(rows) == len(odd_rows)
    none = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == none and r["spans"] == "" for r in rows)
    assert pii.find(empty).collect() == []


def test_messages_reach_along_skip_edges():
    part = pii.nodes("alpha1 beta2 gamma3 alpha1")
    assert part.skip == [(0, 3)] and (0, 1) in part.chain


def test_spans_apart_from_overlapping_base_spans():
    rng = random.Random(6)
    for _ in range(300):
        draw = lambda n: [
            (rng.randrange(4), a, a + rng.randint(1, 9)) for a in (rng.randrange(80) for _ in range(n))
        ]
        spans, base = draw(12), draw(rng.randrange(8))
        want = [s for s in spans if not any(a < s[2] and s[1] < b for _, a, b in base)]
        assert pii._apart(spans, base) == want
    many = [(0, i * 10, i * 10 + 5) for i in range(100_000)]
    assert pii._apart([(1, a + 5, a + 9) for _, a, _ in many], many) == [
        (1, a + 5, a + 9) for _, a, _ in many
    ]
