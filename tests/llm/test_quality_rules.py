from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from chartmart.llm import quality_rules as q


def brute(text: str | None) -> tuple:
    text = text or ""
    ws = [w for w in re.split("[ \t-\r]+", text) if w]
    windows = Counter(zip(ws, ws[1:], ws[2:], strict=False))
    covered = {
        i + k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(3)
    }
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    symbols = sum(c in q.SYMBOLS for c in text)
    return len(ws), sum(map(len, ws)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_match_brute_force(odd, odd_rows):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = q.judged(odd).select("_row.doc_id", *names).collect()
    want = sorted((str(r[0]), *brute(r[1])) for r in odd_rows)
    assert sorted((str(r[0]), *r[1:]) for r in found) == want


def test_cascade_agrees_with_judged_and_keeps_columns(clash):
    kept = q.cascade(clash)
    assert kept.columns == clash.columns
    want = q.judged(clash).where(F.col("rejected_by").isNull()).select("_row.*")
    assert sorted(map(str, kept.collect())) == sorted(map(str, want.collect()))
    assert q.cascade(clash).where(F.col("doc_id").isin(0, 1, 2, 3)).count() == 0


def test_repeats_symbols_and_lines_are_rejected(spark):
    plain = " ".join(f"word{i}" for i in range(80))
    rows = [
        (1, plain),
        (2, "one two three " * 40),
        (3, " ".join(f"w{i}#$" for i in range(80))),
        (4, plain.upper()),
        (5, "\n".join(["some line of words here"] * 9 + [plain])),
    ]
    found = q.judged(spark.createDataFrame(rows, "doc_id long, text string"))
    by = {r[0]: r[1] for r in found.select("_row.doc_id", "rejected_by").collect()}
    assert by[1] is None and by[2] == "repeats" and by[3] == "symbols" and by[4] == "capitals"
    assert by[5] is not None


def test_order_puts_rejections_per_cost_first(odd):
    order = q.estimate(odd)
    assert [x["gain"] for x in order] == sorted((x["gain"] for x in order), reverse=True)
    assert {x["rule"].name for x in order} == {r.name for r in q.RULES}


def test_no_rows(empty):
    assert q.cascade(empty).collect() == [] and q.judged(empty).collect() == []
