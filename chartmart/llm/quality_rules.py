"""Quality rules run as a short-circuit cascade.

Each rule rejects or passes a document. What a rule costs and how much it rejects is estimated on a
sample; rules then run in the order of rejections per cost, and a document leaves the cascade at its
first rejection. The order changes how long it takes, never the verdict. Built-in functions only.

Defined cases: a null or empty text has no words and is rejected as too short; equal rows get equal
verdicts; no rows give no rows; columns of the input are kept as they are, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.llm.common import let, settle, words

SAMPLE_ROWS = 2000
SAMPLE_SHARE = 0.05

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 20
MAX_DUP_LINE_PERCENT = 60
MAX_CAPITAL_PERCENT = 50
MIN_WORD_LENGTH, MAX_WORD_LENGTH = 2, 20


def _word_chars(ws: Column) -> Column:
    return F.char_length(F.array_join(ws, "")).cast("long")


def _n_symbols(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _n_dup_lines(text: Column) -> Column:
    return let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _covered(starts: Column) -> Column:
    """Words covered by the 3-word windows at these ascending starts."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, p: F.struct(
            (p + 3).alias("end"), (s["n"] + p + 3 - F.greatest(p, s["end"])).alias("n")
        ),
        lambda s: s["n"],
    )


def _repeated_starts(hashes: Column) -> Column:
    """Ascending indexes of the items that occur twice or more."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = lambda at: F.filter(
        at,
        lambda x, i: F.get(at, i - 1)["h"].eqNullSafe(x["h"])
        | F.get(at, i + 1)["h"].eqNullSafe(x["h"]),
    )
    return F.sort_array(let(pairs, lambda at: F.transform(twice(at), lambda x: x["i"])))


def _n_repeat_words(ws: Column) -> Column:
    """Words inside any 3-word window that the text holds twice; windows compare by 64-bit hash."""
    hashes = lambda w: F.when(
        F.size(w) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    covered = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
        _covered(_repeated_starts(h))
    )
    # The optimiser may put the words' own expression in place of ``ws``: it must stand once.
    return let(ws, lambda w: let(hashes(w), covered)).cast("long")


def _letters(text: Column, kind: str) -> Column:
    return F.char_length(F.regexp_replace(text, rf"[^\p{{{kind}}}]+", ""))


@dataclass(frozen=True)
class Measures:
    """Measures of a document as expressions, computed only where a rule asks for them."""

    text: Column
    ws: Column

    n_words = property(lambda m: F.size(m.ws).cast("long"))
    word_chars = property(lambda m: _word_chars(m.ws))
    n_symbols = property(lambda m: _n_symbols(m.text))
    n_dup_lines = property(lambda m: _n_dup_lines(m.text))
    n_lines = property(lambda m: F.size(_lines(m.text)).cast("long"))
    n_repeat_words = property(lambda m: _n_repeat_words(m.ws))
    n_capitals = property(lambda m: _letters(m.text, "Lu").cast("long"))
    n_letters = property(lambda m: _letters(m.text, "L").cast("long"))


class Columns:
    """The same measures where they are columns already."""

    def __init__(self, prefix: str = ""):
        self._prefix = prefix

    def __getattr__(self, name: str) -> Column:
        return F.col(self._prefix + name)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], Column]


RULES = (
    Rule("few_words", lambda m: m.n_words < MIN_WORDS),
    Rule("repeats", lambda m: 100 * m.n_repeat_words > MAX_REPEAT_PERCENT * m.n_words),
    Rule("symbols", lambda m: 100 * m.n_symbols > MAX_SYMBOL_PERCENT * m.n_words),
    Rule("same_lines", lambda m: 100 * m.n_dup_lines > MAX_DUP_LINE_PERCENT * m.n_lines),
    Rule("capitals", lambda m: 100 * m.n_capitals > MAX_CAPITAL_PERCENT * m.n_letters),
    Rule(
        "word_length",
        lambda m: (m.word_chars < MIN_WORD_LENGTH * m.n_words)
        | (m.word_chars > MAX_WORD_LENGTH * m.n_words),
    ),
)


def with_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row`` with the input's columns and ``_text`` without nulls."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    plain = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(row.alias("_row"), plain.alias("_text"))


def measured(rule_body) -> Column:
    """``rule_body(measures)`` with the words of ``_text`` split once."""
    text = F.col("_text")
    return let(words(text), lambda ws: rule_body(Measures(text, ws)))


def estimate(docs: DataFrame, rules=RULES, text: str = "text") -> list[dict]:
    """Cost in seconds and share rejected of every rule on a bounded sample, best rule first.

    At most ``SAMPLE_ROWS`` rows are measured; a rule that no sampled row meets counts as rejecting
    half a row, so cheap rules go before dear ones.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text"))
    held = with_text(settle(rows.sample(SAMPLE_SHARE, seed=17).limit(SAMPLE_ROWS), "rules-sample"))
    found = []
    for rule in rules:
        job = held.agg(F.count_if(measured(rule.rejects)).alias("n"), F.count("*").alias("of"))
        job.collect()  # compiles; the second run is measured
        start = time.perf_counter()
        n, of = job.first()
        cost = time.perf_counter() - start
        share = max(n, 0.5) / max(of, 1)
        found.append({"rule": rule, "cost": cost, "rejects": share, "gain": share / cost})
    return sorted(found, key=lambda x: -x["gain"])


def first_rejection(rules, measures) -> Column:
    """Name of the first rule in this order that rejects, null for a document that passes all."""
    out = None
    for rule in rules:
        hit = rule.rejects(measures)
        out = F.when(hit, rule.name) if out is None else out.when(hit, rule.name)
    return out if out is not None else F.lit(None).cast("string")


def cascade(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """The documents that pass all rules, with their own columns."""
    order = [x["rule"] for x in estimate(docs, rules, text)]
    verdict = measured(lambda m: first_rejection(order, m))
    return with_text(docs, text).where(verdict.isNull()).select("_row.*")


NAMES = "n_words word_chars n_symbols n_dup_lines n_lines n_repeat_words n_capitals n_letters".split()


def judged(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """Every document as ``_row`` with all measures and ``rejected_by``, for reports."""
    order = [x["rule"] for x in estimate(docs, rules, text)]
    held = with_text(docs, text).withColumn("_words", words(F.col("_text")))
    m = Measures(F.col("_text"), F.col("_words"))
    found = held.select("_row", *[getattr(m, c).alias(c) for c in NAMES])
    return found.withColumn("rejected_by", first_rejection(order, Columns()))
