r"""Conversations as marked text for training, checked by a grammar round trip.

A conversation is a sentence of this grammar, read by a deterministic parser::

    conversation := turn*
    turn         := "<|im_start|>" role "\n" text "<|im_end|>" "\n"

Neither role nor text may hold a control string (``<|im_start|>``, ``<|im_end|>``), a role no line
break. Turns are rendered as they are, the rendered text is parsed again and the recovered turns are
compared with the source; turns that come back otherwise are escaped, until all are identical. Escaping
puts one backslash more after ``<`` of each control string, also of those that have some already
(``<|im_end|>``, ``<\|im_end|>``, …), so the parser restores every text by taking one away. In roles a
line break becomes ``<|nl|>``, which is escaped alike. No control string begins with the end of another,
so turns that come back alone also come back side by side, and one escape is enough.

The formatted text comes in parts of whole turns, a new one after ``PART`` characters, so that a
conversation of any length is a stream; nearly all have one part. Loss spans (code points of the part,
end exclusive) cover the texts of ``assistant`` turns as they stand there, escapes included.

Defined cases: a null role or text is the empty one; turns are ordered by turn, null first, then by role
and text; repeated rows are turns each; rows without conv_id form one conversation with a null id; an
empty table gives no rows. Only ``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
LEARNT = "assistant"
PART = 1 << 20
_FLUSH = 1 << 22  # characters of one output batch

_CONTROL = re.compile(r"<\|im_(?:start|end)\|>")
_IN_TEXT = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
_IN_ROLE = re.compile(r"<(\\*)\|(im_start|im_end|nl)\|>")

Turn = tuple[str, str]


def escaped(turn: Turn) -> Turn:
    """One backslash more in every control string."""
    more = r"<\1\\|\2|>"
    role, text = turn
    return _IN_ROLE.sub(more, role).replace("\n", BREAK), _IN_TEXT.sub(more, text)


def _restored_role(role: str) -> str:
    return _IN_ROLE.sub(
        lambda m: f"<{m[1][1:]}|{m[2]}|>" if m[1] else "\n" if m[2] == "nl" else m[0], role
    )


def restored(text: str) -> str:
    """A text without the backslashes that escaping put in."""
    return _IN_TEXT.sub(lambda m: f"<{m[1][1:]}|{m[2]}|>", text) if "|im_" in text else text


def render(turns: list[Turn]) -> str:
    return "".join(f"{START}{role}\n{text}{END}\n" for role, text in turns)


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, start, end of the text's place) of every turn; None if it is no sentence."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            return None
        line = formatted.find("\n", at + len(START))
        if line < 0:
            return None
        role = formatted[at + len(START) : line]
        mark = _CONTROL.search(formatted, line + 1)
        if _CONTROL.search(role) or not mark or mark[0] != END:
            return None
        if not formatted.startswith("\n", mark.end()):
            return None
        text = formatted[line + 1 : mark.start()]
        if "<" in role:
            role = _restored_role(role)
        turns.append((role, restored(text), line + 1, mark.start()))
        at = mark.end() + 1
    return turns


def _same(found: list | None, turns: list[Turn]) -> bool:
    return found is not None and [turn[:2] for turn in found] == turns


def fitted(turns: list[Turn]) -> tuple[str, list[tuple[str, str, int, int]]]:
    """Rendered turns that parse to the same turns again, and the parse."""
    forms = list(turns)
    while True:
        formatted = render(forms)
        found = parse(formatted)
        if _same(found, turns):
            return formatted, found
        for i, (form, turn) in enumerate(zip(forms, turns, strict=True)):
            if not _same(parse(render([form])), [turn]):
                forms[i] = escaped(form)


FORMATTED = "conv_id long, part long, formatted string, loss_start array<long>, loss_end array<long>"
_FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int64()),
        ("formatted", pa.string()),
        ("loss_start", pa.list_(pa.int64())),
        ("loss_end", pa.list_(pa.int64())),
    ]
)
READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)
_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _part(conv_id: int | None, part: int, turns: list[Turn]) -> tuple:
    formatted, found = fitted(turns)
    loss = [turn for turn in found if turn[0] == LEARNT]
    return conv_id, part, formatted, [turn[2] for turn in loss], [turn[3] for turn in loss]


def _format(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Turns in order of conversations; a part is rendered when it is full or its conversation ends."""
    out, chars = [], 0
    key, part, turns, held = None, 0, [], 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
        for conv_id, role, text in zip(*columns, strict=True):
            if turns and (conv_id != key or held >= size):
                out.append(_part(key, part, turns))
                part, turns, held = part + 1, [], 0
            if conv_id != key:
                key, part = conv_id, 0
            turns.append((role, text))
            held += len(text)
            chars += len(text)
            if chars >= _FLUSH:
                yield _batch(out, _FORMATTED)
                out, chars = [], 0
    if turns:
        out.append(_part(key, part, turns))
    yield _batch(out, _FORMATTED)


class _Reader:
    """Digests of one conversation, part after part."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, formatted: str, starts: list[int], ends: list[int]) -> None:
        found = parse(formatted)
        if found is None:
            raise ValueError(f"conversation {self.conv_id} is not formatted by the grammar")
        self.chars += len(formatted)
        self.turns += len(found)
        for role, text, _, _ in found:
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        for start, end in zip(starts, ends, strict=True):
            text = restored(formatted[start:end])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        loss = (self.loss_chars, self.loss.hexdigest())
        return self.conv_id, self.turns, self.all.hexdigest(), *loss, self.chars


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = None
    for batch in batches:
        out = []
        names = ("conv_id", "formatted", "loss_start", "loss_end")
        for conv_id, *part in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if reader is None or reader.conv_id != conv_id:
                if reader is not None:
                    out.append(reader.row())
                reader = _Reader(conv_id)
            reader.read(*part)
        yield _batch(out, _READ)
    if reader is not None:
        yield _batch([reader.row()], _READ)


def formatted(conversations: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, part, formatted, loss_start, loss_end) of every conversation, parts in order.

    The rows of a conversation are in one partition, side by side.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = (F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
    dealt = turns.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.mapInArrow(partial(_format, size=part), FORMATTED)


def read_back(parts: DataFrame) -> DataFrame:
    """Counts and digests of every conversation, from its formatted parts in any order."""
    dealt = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.mapInArrow(_read, READ)


def round_trip(conversations: DataFrame, part: int = PART) -> DataFrame:
    """Counts and digests of every conversation, read from the formatted text where it is made."""
    return formatted(conversations, part).mapInArrow(_read, READ)
