"""Personal data by fixed patterns and a skip-chain conditional random field.

Patterns find complete e-mail addresses, network addresses, card and phone numbers. The field labels
the words of a document that hold a digit or an at sign: neighbours in the text are joined by chain
factors, distant words with the same digits, address or name part by skip factors, each with the one
before and with the nearest one inside a pattern span (else the first one), so any shortened
repeat ("555-0123" after "+1 (743) 555-0123") takes the label of the full mention. Words inside
pattern spans are evidence. Loopy sum-product message passing gives posteriors; words above
``MIN_POSTERIOR`` become further spans, next to the pattern spans, which always stay.

The weights are fitted by pseudo-likelihood on at most ``TRAIN_DOCS`` texts that hold a digit or an at
sign: of all documents, those of least hash with a match of each kind, and the rest without any match.
They are labelled by the patterns, with shortened repeats of found entities and unrelated numbers
of the same shapes put behind them.

Defined cases: null and empty texts have no spans; equal texts have equal spans; texts of any length
are read whole, in time proportional to their length; where no document has an entity the weights are
zero and only patterns count. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.llm.common import settle

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)  # label of words that belong to no entity
LABELS = len(KINDS) + 1

TRAIN_DOCS = 2000
TRAIN_CHARS = 20_000  # of longer documents the surroundings of a match of each kind are trained on
MIN_POSTERIOR = 0.9
SWEEPS, DAMPING = 8, 0.3
NODES_AT_ONCE = 50_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){15,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_SEED = re.compile(r"[0-9@][^\x20\x09-\x0D]*")
_SPACE = frozenset(" \t\n\r\x0b\x0c")
_EDGE = "\"'.,;:!?#*$%&|<>[]{}=`~^_/\\"
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LETTER = re.compile(r"[A-Za-z]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    """Whether every second digit from the right, doubled and reduced, brings the sum to tens."""
    back = [int(c) for c in reversed(digits)]
    doubled = sum(d * 2 - 9 * (d > 4) for d in back[1::2])
    return (sum(back[::2]) + doubled) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with all name characters before it, up to the last match, and a domain."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Pattern matches, by kind and start."""
    out: list[Span] = []
    if not _ANY.search(text):
        return out
    out += [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0]) if len(m[0]) < 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


# ---- the field's nodes --------------------------------------------------------------------------

_DIGIT_STEPS = np.array([1, 3, 4, 5, 7, 8, 10, 11, 16, 20])  # lower ends of digit-count classes
_N_DIGITS = len(_DIGIT_STEPS) + 1
_FLAGS = (
    "bias at_dot at_only plus paren letters1 letters3 quad quad_bad dot1 dot2 hyphen luhn "
    "prev prev_plus next next_plus"
).split()
_FLAG = {name: i for i, name in enumerate(_FLAGS)}
FEATURES = len(_FLAGS) + 3 * _N_DIGITS
_CORE_QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")


@dataclass
class Nodes:
    """Words of one document that hold a digit or at sign."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def _words_of(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, core start, core end) of each such word."""
    out, done = [], 0
    for m in _SEED.finditer(text):
        start, end = m.start(), m.end()
        while start > done and text[start - 1] not in _SPACE:
            start -= 1
        done = end
        word = text[start:end]
        left = len(word) - len(word.lstrip(_EDGE))
        core = word.strip(_EDGE)
        if core:
            out.append((start, end, start + left, start + left + len(core)))
    return out


def _digit_class(n: int) -> int:
    return int(np.searchsorted(_DIGIT_STEPS, n, side="right"))


def _own(word: str, digits: str) -> list[int]:
    on = ["bias"]
    if "@" in word:
        on.append("at_dot" if "." in word.rpartition("@")[2] else "at_only")
    on += ["plus"] if word[0] == "+" else []
    on += ["paren"] if word[0] == "(" else []
    letters = len(_LETTER.findall(word[:64]))
    on += ["letters3"] if letters > 2 else ["letters1"] if letters else []
    dots = word.count(".")
    if dots >= 3:
        quad = _CORE_QUAD.search(word)
        good = quad and all(int(p) < 256 for p in quad[0].split("."))
        on.append("quad" if good else "quad_bad")
    elif dots:
        on.append(f"dot{dots}")
    on += ["hyphen"] if "-" in word[1:] else []
    on += ["luhn"] if 16 <= len(digits) <= 19 and luhn(digits) else []
    return [_FLAG[x] for x in on] + [len(_FLAGS) + _digit_class(len(digits))]


def _keys(word: str, digits: str) -> list[str]:
    """What a word shares with its repeats: name part, address, last or only digits."""
    keys = []
    if "@" in word:
        keys.append("n" + word.partition("@")[0].lower())
    elif _LETTER.search(word):
        keys.append("n" + word.lower())
    quad = _CORE_QUAD.search(word) if word.count(".") >= 3 else None
    if quad:
        keys.append("q" + quad[0])
    elif 4 <= len(digits) < 7:
        keys.append("d" + digits)
    elif len(digits) >= 7 and not _LETTER.search(word):
        keys.append("l" + digits[-7:])
    return keys


def nodes(text: str, base: list[Span] | None = None) -> Nodes:
    """The nodes of a text; ``base``: its pattern spans, whose words are joined to all their repeats."""
    found = Nodes([], [], [], [])
    mentions: dict[str, list[int]] = {}
    words = _words_of(text) if _ANY.search(text) else []
    digit_classes = []
    for i, (start, _, a, b) in enumerate(words):
        word = text[a:b]
        digits = _NOT_DIGIT.sub("", word)
        digit_classes.append(_digit_class(len(digits)))
        found.spans.append((a, b))
        found.features.append(_own(word, digits))
        if i and start - words[i - 1][1] <= 2 and not text[words[i - 1][1] : start].strip(" "):
            found.chain.append((i - 1, i))
        for key in _keys(word, digits):
            mentions.setdefault(key, []).append(i)
    known = evidence(found.spans, base or [])
    skip: dict[tuple[int, int], None] = {}
    for same in mentions.values():
        sure = [i for i in same if known[i] >= 0]
        at = 0  # evidence so far
        for before, i in zip(same, same[1:]):
            skip[before, i] = None
        for i in same:
            if sure and sure[at : at + 1] == [i]:
                at += 1
            else:
                hub = sure[max(at - 1, 0)] if sure else same[0]
                if hub != i:
                    skip[min(hub, i), max(hub, i)] = None
    found.skip += skip
    base = len(_FLAGS)
    for i, j in found.chain:
        found.features[j] += [_FLAG["prev"], base + _N_DIGITS + digit_classes[i]]
        found.features[i] += [_FLAG["next"], base + 2 * _N_DIGITS + digit_classes[j]]
        found.features[j] += [_FLAG["prev_plus"]] if text[found.spans[i][0]] == "+" else []
        found.features[i] += [_FLAG["next_plus"]] if text[found.spans[j][0]] == "+" else []
    return found


def evidence(spans: list[tuple[int, int]], base: list[Span]) -> np.ndarray:
    """Kind of the pattern span that covers most of each word, -1 where there is none."""
    out = np.full(len(spans), -1, np.int64)
    if not base or not spans:
        return out
    starts = np.array([a for a, _ in spans])
    ends = np.array([b for _, b in spans])
    for kind, start, end in base:
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(starts, end, "left")
        for i in range(first, last):
            a, b = spans[i]
            if 2 * (min(b, end) - max(a, start)) > b - a:
                out[i] = kind
    return out


# ---- the model ----------------------------------------------------------------------------------


@dataclass
class Field:
    """Weights of word features, of neighbouring labels and of labels joined by a skip factor."""

    word: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _scores(weights: np.ndarray, features: list[list[int]]) -> np.ndarray:
    flat = np.fromiter((f for fs in features for f in fs), np.int64)
    starts = np.cumsum([0] + [len(fs) for fs in features[:-1]])
    return np.add.reduceat(weights[flat], starts, axis=0)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def posteriors(model: Field, parts: list[Nodes], known: list[np.ndarray]) -> np.ndarray:
    """Label probabilities of all words of several documents by loopy message passing."""
    base = np.cumsum([0] + [len(p.spans) for p in parts])
    theta = _scores(model.word, [f for p in parts for f in p.features])
    labels = np.concatenate(known)
    fixed = labels >= 0
    theta[fixed] = -30.0
    theta[fixed, labels[fixed]] = 0.0
    chain = [(b + i, b + j) for b, p in zip(base, parts, strict=False) for i, j in p.chain]
    skip = [(b + i, b + j) for b, p in zip(base, parts, strict=False) for i, j in p.skip]
    edges = np.array(chain + skip, np.int64).reshape(-1, 2)
    if len(edges):
        factor = np.concatenate(
            [
                np.broadcast_to(model.chain, (len(chain), LABELS, LABELS)),
                np.broadcast_to(model.skip, (len(skip), LABELS, LABELS)),
            ]
        )
        # Each edge carries a message both ways; the second half of the list is the way back.
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        factor = np.concatenate([factor, factor.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.zeros((len(source), LABELS))
        for _ in range(SWEEPS):
            belief = theta.copy()
            np.add.at(belief, target, message)
            new = _log_sum((belief[source] - message[back])[:, :, None] + factor, 1)
            new -= _log_sum(new, 1)[:, None]
            message = DAMPING * message + (1 - DAMPING) * new
        np.add.at(theta, target, message)
    return np.exp(theta - _log_sum(theta, 1)[:, None])


def _shortened(kind: int, entity: str, rng: random.Random) -> str:
    if kind == 0:
        return entity.partition("@")[0]
    if kind == 1:
        return f"{entity}:{rng.choice([80, 443, 8080])}"
    digits = _NOT_DIGIT.sub("", entity)
    if kind == 2:
        return rng.choice([" ".join(digits[i : i + 4] for i in range(0, 12, 4)), digits[-7:]])
    return rng.choice([f"{digits[-7:-4]}-{digits[-4:]}", digits[-10:], digits[-7:]])


def _like(text: str, rng: random.Random) -> str:
    """Other digits in the same shape."""
    return re.sub("[0-9]", lambda _: rng.choice("0123456789"), text)


def training_text(text: str, rng: random.Random) -> tuple[str, list[Span], list[Span]]:
    """A text with shortened repeats and unrelated numbers behind it: pattern spans, all spans."""
    truth = base_spans(text)
    for kind, start, end in list(truth)[:8]:
        repeat = _shortened(kind, text[start:end], rng)
        text += " " + _like(repeat, rng) + " of "
        if repeat:
            truth.append((kind, len(text), len(text) + len(repeat)))
        text += repeat + " and " + _like(repeat, rng) + " to"
    text += f" {rng.randint(1, 99)} of {rng.randint(1990, 2030)} at {rng.randint(1, 9999)}.{rng.randint(0, 99)}"
    return text, base_spans(text), truth


def fit(texts: list[str], steps: int = 250, rate: float = 0.1, decay: float = 1e-3) -> Field:
    """Weights that make each training word's label likely given the labels joined to it."""
    rng = random.Random(5)
    parts, gold = [], []
    for text in texts:
        long, base, truth = training_text(text, rng)
        part = nodes(long, base)
        if not part.spans:
            continue
        labels = evidence(part.spans, [*truth, *base])
        parts.append(part)
        gold.append(np.where(labels < 0, OTHER, labels))
    model = Field(
        np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))
    )
    if not parts or all((g == OTHER).all() for g in gold):
        return model
    y = np.concatenate(gold)
    n, base_at = len(y), np.cumsum([0] + [len(p.spans) for p in parts])
    features = [f for p in parts for f in p.features]
    x = np.zeros((n, FEATURES))
    np.add.at(x, (np.repeat(np.arange(n), [len(f) for f in features]), np.concatenate(features)), 1)
    one = np.eye(LABELS)[y]

    def joined(edges):
        pairs = [(b + i, b + j) for b, p in zip(base_at, parts, strict=False) for i, j in edges(p)]
        e = np.array(pairs, np.int64).reshape(-1, 2)
        before, after = np.zeros((n, LABELS)), np.zeros((n, LABELS))
        np.add.at(before, e[:, 1], one[e[:, 0]])
        np.add.at(after, e[:, 0], one[e[:, 1]])
        return before, after

    before, after = joined(lambda p: p.chain)
    near = sum(joined(lambda p: p.skip))
    design = np.hstack([x, before, after, near])
    weights = np.zeros((design.shape[1], LABELS))
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    cut = np.cumsum([FEATURES, LABELS, LABELS])
    for step in range(1, steps + 1):
        logits = design @ weights
        p = np.exp(logits - _log_sum(logits, 1)[:, None])
        grad = design.T @ (p - one) / n + decay * weights
        # One table serves both ends of a chain factor, and a skip factor has no direction.
        own, b, a, s = np.split(grad, cut)
        grad = np.vstack([own, b + a.T, (b + a.T).T, (s + s.T) / 2])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        weights -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    own, b, _, s = np.split(weights, cut)
    return Field(own, b, s)


def further_spans(part: Nodes, known: np.ndarray, posterior: np.ndarray, text: str) -> list[Span]:
    """Runs of words outside pattern spans that the field gives one entity label."""
    out: list[Span] = []
    joined = set(part.chain)
    for i, (a, b) in enumerate(part.spans):
        kind = int(posterior[i].argmax())
        if known[i] >= 0 or kind == OTHER or posterior[i, kind] < MIN_POSTERIOR:
            continue
        if out and out[-1][0] == kind and (i - 1, i) in joined and out[-1][2] == part.spans[i - 1][1]:
            out[-1] = (kind, out[-1][1], b)
        else:
            out.append((kind, a, b))
    return out


def _apart(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that overlap no base span: each looks at one of the merged stretches only."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    out = []
    for span in spans:
        i = bisect_right(ends, span[1])
        if i == len(ends) or starts[i] >= span[2]:
            out.append(span)
    return out


def spans_of(texts: list[str], model: Field) -> list[tuple[list[Span], list[Span]]]:
    """Pattern spans and all spans of each text, by kind and start."""
    out: list[tuple[list[Span], list[Span]]] = []
    waiting: list[tuple[int, Nodes, np.ndarray]] = []

    def infer() -> None:
        if waiting:
            every = posteriors(model, [w[1] for w in waiting], [w[2] for w in waiting])
            at = 0
            for k, part, known in waiting:
                own = every[at : at + len(known)]
                at += len(known)
                base = out[k][0]
                more = _apart(further_spans(part, known, own, texts[k]), base)
                out[k] = (base, sorted([*base, *more]))
        waiting.clear()

    held = 0
    for k, text in enumerate(texts):
        base = base_spans(text)
        out.append((base, base))
        part = nodes(text, base)
        known = evidence(part.spans, base)
        # Without an entity to repeat or words of its own, a document has nothing to infer.
        if part.spans and (known < 0).any():
            waiting.append((k, part, known))
            held += len(known)
        if held > NODES_AT_ONCE:
            infer()
            held = 0
    infer()
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def _kind_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, hash) of the texts of least hash with a pattern span of each kind, and of those without."""
    least = [np.zeros(0, np.int64)] * LABELS
    for batch in batches:
        found: list[list[int]] = [[] for _ in range(LABELS)]
        for text, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist(), strict=True):
            for kind in {k for k, _, _ in base_spans(text)} or {OTHER}:
                found[kind].append(h)
        for kind, new in enumerate(found):
            least[kind] = np.union1d(least[kind], np.array(new, np.int64))[:TRAIN_DOCS]
    kinds = np.repeat(np.arange(LABELS), [len(x) for x in least])
    yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(np.concatenate(least))], ["kind", "h"])


def excerpt(text: str) -> str:
    """A text of at most ``TRAIN_CHARS``: of a longer one, what lies around a match of each kind."""
    if len(text) <= TRAIN_CHARS:
        return text
    first: dict[int, tuple[int, int]] = {}
    for kind, start, end in base_spans(text):
        if end - start <= TRAIN_CHARS // LABELS // 2:
            first.setdefault(kind, (start, end))
    if not first:
        found = _ANY.search(text)
        first[OTHER] = found.span() if found else (0, 0)
    room = TRAIN_CHARS // len(first)
    parts, done = [], 0
    for start, end in sorted(first.values()):
        a = max(done, start - (room - (end - start)) // 2)
        done = max(done, min(len(text), a + room))
        parts.append(text[a:done])
    return " ".join(parts)


def _excerpt_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([excerpt(t) for t in batch.column("text").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("h"), texts], ["h", "text"])


def training_texts(docs: DataFrame) -> list[str]:
    """The bounded sample that the field is fitted on; equal documents give equal samples, in any order."""
    rows = docs.select("text").where(F.col("text").rlike("[0-9@]")).withColumn("h", F.xxhash64("text"))
    # At most LABELS * TRAIN_DOCS numbers of each task.
    kinds = settle(rows.mapInArrow(_kind_rows, "kind long, h long"), "kinds")
    chosen: set[int] = set()
    for kind in range(LABELS):
        room = TRAIN_DOCS // LABELS if kind < OTHER else TRAIN_DOCS - len(chosen)
        own = kinds.where(F.col("kind") == kind).select("h").distinct()
        chosen |= {r["h"] for r in own.orderBy("h").limit(room).collect()}
    if not chosen:
        return []
    texts = rows.where(F.col("h").isin(sorted(chosen))).mapInArrow(_excerpt_rows, "h long, text string")
    texts = texts.groupBy("h").agg(F.min("text").alias("text"))
    return [r["text"] for r in sorted(texts.collect(), key=lambda r: r["h"])]


def train(docs: DataFrame) -> Field:
    """Fits the field on a bounded sample of documents with digits or at signs."""
    return fit(training_texts(docs))


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "base_sha256 string, spans string"
)


def find(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """Personal data of every document: counts of pattern spans, their digest, and all spans."""
    model = model or train(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = spans_of(texts, model)
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in range(OTHER)]
            digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(digests),
                    pa.array([written(every) for _, every in found]),
                ],
                [field.split()[0] for field in SCHEMA.split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
