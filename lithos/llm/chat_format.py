"""Conversations as one marked-up text each, with a loss mask and the attachments that its placeholders stand for.

A turn is text or a list of typed parts. A visitor flattens the parts in order: text is written
with control strings escaped, an image, a piece of audio or a document as a placeholder, whose
reference, place and expanded number of tokens are recorded. ``read`` takes the formatted text
apart again, to the very turns.

Rows are dealt out by ranges of (conversation, turn) and formatted turn by turn as a stream, so a conversation of
any length is never held whole: it comes as chunks of about ``chunk_chars``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks before and after a turn's text by role; any other role is written out between ``other``'s marks."""

    roles: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
    )
    other: tuple[str, str, str] = ("<|role|>", "<|says|>", "<|end|>")
    placeholders: dict[str, str] = field(default_factory=lambda: {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"})
    unknown: str = "<|file|>"
    learnt: str = "assistant"

    def marks(self) -> list[str]:
        """All control strings, longest first."""
        found = {m for pair in self.roles.values() for m in pair} | {*self.other, *self.placeholders.values(), self.unknown}
        return sorted(found, key=lambda m: (-len(m), m))


@dataclass(frozen=True)
class Costs:
    """Tokens that a placeholder expands to: an image by patches, audio by the second, a document by the page; one at least."""

    patch: int = 28
    audio_per_second: float = 25.0
    document_page: int = 256

    def of(self, kind: str, part: dict) -> int:
        if kind == "image":
            return max(1, math.ceil((part.get("width") or 0) / self.patch) * math.ceil((part.get("height") or 0) / self.patch))
        if kind == "audio":
            return max(1, math.ceil((part.get("seconds") or 0) * self.audio_per_second))
        if kind == "document":
            return max(1, (part.get("pages") or 0) * self.document_page)
        return 1


class Escapes:
    """Control strings in texts, made harmless and back.

    No mark holds a backslash, begins another, or begins inside another, so an escaped text neither
    holds a mark nor completes one with what stands beside it; other templates raise.
    """

    def __init__(self, marks: list[str]):
        for m in marks:
            ends = [m[i:] for i in range(1, len(m))]
            if not ends or "\\" in m or any(o != m and o.startswith(m) for o in marks) or any(o.startswith(e) or e.startswith(o) for o in marks for e in ends):
                raise ValueError(f"{m!r} cannot be told from other marks or from texts")
        self.marks = re.compile("|".join(map(re.escape, marks)))
        self._starts = re.compile("|".join(f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in marks))
        self._slash = re.compile(r"\\(\\?)")

    def escape(self, text: str) -> str:
        """Backslashes doubled, and one after the first character of every control string."""
        if "\\" in text:
            text = text.replace("\\", "\\\\")
        return self._starts.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._slash.sub(r"\1", text) if "\\" in text else text


class Visitor:
    """Writes parts one after another; what it has written so far is in ``out``, ``spans`` and ``attached``."""

    def __init__(self, template: Template, costs: Costs):
        self.template, self.costs, self.escapes = template, costs, Escapes(template.marks())
        self.clear()

    def clear(self) -> None:
        self.out: list[str] = []
        self.length = 0
        self.turns = 0
        self.spans: list[dict] = []
        self.attached: list[dict] = []

    def _write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def turn(self, role: str | None, parts: list[dict]) -> None:
        role = role or ""
        before, after = self.template.roles.get(role, (None, None))
        if before is None:
            first, then, after = self.template.other
            before = first + self.escapes.escape(role) + then
        self._write(before)
        for kind, run in groupby(parts, lambda p: p.get("type") or "text"):
            getattr(self, f"visit_{kind}", self.visit_attachments)(kind, run, role)
        self._write(after)
        self.turns += 1

    def visit_text(self, kind: str, parts: Iterable[dict], role: str) -> None:
        """Texts in a row are one text, so no control string can arise between them."""
        start = self.length
        self._write(self.escapes.escape("".join(p.get("text") or "" for p in parts)))
        if role == self.template.learnt and self.length > start:
            self.spans.append({"start": start, "end": self.length})

    def visit_attachments(self, kind: str, parts: Iterable[dict], role: str) -> None:
        for part in parts:
            tokens = self.costs.of(kind, part)
            self.attached.append({"type": kind, "ref": part.get("ref"), "turn": self.turns, "at": self.length, "tokens": tokens})
            self._write(self.template.placeholders.get(kind, self.template.unknown))


_CHUNK = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("task", pa.int32()),
        ("chunk", pa.int32()),
        ("open", pa.bool_()),
        ("turns", pa.int64()),
        ("formatted", pa.large_string()),
        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("attachments", pa.list_(pa.struct([("type", pa.string()), ("ref", pa.string()), ("turn", pa.int64()), ("at", pa.int32()), ("tokens", pa.int64())]))),
        ("attached_tokens", pa.int64()),
    ]
)
_CHUNK_DDL = """conv_id long, task int, chunk int, open boolean, turns long, formatted string, loss array<struct<start: int, end: int>>,
attachments array<struct<type: string, ref: string, turn: long, at: int, tokens: long>>, attached_tokens long"""


def formatted(rows: DataFrame, template: Template = Template(), costs: Costs = Costs(), chunk_chars: int = 1 << 20, content: str | None = None) -> DataFrame:
    """Chunks of formatted conversations, from rows with ``conv_id``, ``turn``, ``role`` and ``text``.

    ``content`` names an optional column with an array of structs of which ``type``, ``text``, ``ref``,
    ``width``, ``height``, ``seconds`` and ``pages`` are read as far as there are any; where it is null, or not named, the turn is its
    text. A part without a type is text; one of an unknown type gets a placeholder of one token.

    Turns come by turn, then role, then text, nulls first; repeated rows are turns of their own. A null
    role or text counts as empty. Nothing says to which conversation a row without an id belongs, so each is
    one of its own, with a null id. No rows give no chunks. Other columns are left out.

    A conversation's chunks in order are those by (``task``, ``chunk``); ``open`` says that there may be others than this one.
    Offsets (``loss``, ``at``) are code points within the chunk, ``turn`` counts from its first.
    """
    text = F.col("text")
    parts = F.col(content) if content else F.lit(None).cast("string")
    rows = rows.select("conv_id", "turn", "role", text, parts.alias("content"))
    # a conversation with very many rows, or very many rows of one turn, is cut into ranges like any others
    order = [F.col("conv_id"), F.col("turn"), F.col("role")]
    rows = rows.repartitionByRange(*order, F.left(text, F.lit(64))).sortWithinPartitions(*order, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        visitor, done, size = Visitor(template, costs), [], 0
        now, chunk, first = None, 0, True

        def close(more: bool) -> None:
            nonlocal chunk, size
            tokens = sum(a["tokens"] for a in visitor.attached)
            done.append((now, task, chunk, now is not None and (more or first or chunk > 0), visitor.turns, "".join(visitor.out), visitor.spans, visitor.attached, tokens))
            size += visitor.length
            chunk += 1
            visitor.clear()

        for batch in batches:
            for conv, role, said, parts in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4)), strict=True):
                if visitor.turns and (conv != now or conv is None):
                    close(False)
                    first = False
                    chunk = 0
                elif visitor.length >= chunk_chars:
                    close(True)
                now = conv
                visitor.turn(role, [{"text": said}] if parts is None else [p or {} for p in parts])
                if size >= 1 << 22 or len(done) >= 5000:
                    yield _batch(done)
                    done, size = [], 0
        if visitor.turns:
            close(True)  # the next range may go on with it
        if done:
            yield _batch(done)

    return rows.mapInArrow(run, _CHUNK_DDL)


def _batch(done: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), _CHUNK, strict=True)], schema=_CHUNK)


class Reader:
    """Takes formatted text apart: turns as (role, parts), where a part is text or the control string of a placeholder."""

    def __init__(self, template: Template):
        self.template, self.escapes = template, Escapes(template.marks())
        self._by_mark = {before: (role, after) for role, (before, after) in template.roles.items()}

    def turns(self, formatted: str) -> Iterator[tuple[str, list[tuple[str, str]]]]:
        at = 0
        while at < len(formatted):
            mark = self.escapes.marks.match(formatted, at)
            if mark and mark[0] == self.template.other[0]:
                then = self.escapes.marks.search(formatted, mark.end())
                role, after, at = self.escapes.unescape(formatted[mark.end() : then.start()]), self.template.other[2], then.end()
            elif mark and mark[0] in self._by_mark:
                (role, after), at = self._by_mark[mark[0]], mark.end()
            else:
                raise ValueError("no turn begins here")
            parts = []
            while True:
                mark = self.escapes.marks.search(formatted, at)
                if mark is None:
                    raise ValueError("a turn has no end")
                if mark.start() > at:
                    parts.append(("text", self.escapes.unescape(formatted[at : mark.start()])))
                at = mark.end()
                if mark[0] == after:
                    break
                parts.append(("mark", mark[0]))
            yield role, parts


_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("attached_tokens", pa.int64())]
)
_DIGEST_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, attached_tokens long"


def digests(chunks: DataFrame, template: Template = Template()) -> DataFrame:
    """One row a conversation, read back from ``chunks``: turns and their digest, what is under the loss mask, and lengths.

    ``turns_sha256`` is over role, line feed, text, line feed of each turn, a placeholder counting as its control string.
    Only conversations that may have several chunks are shuffled, as chunks. SHA-256 runs through a conversation from
    start to end, so its chunks pass through one task, as a stream in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(template)
        now, state = None, None
        for batch in batches:
            done = []
            for conv, text, spans, tokens in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "formatted", "loss", "attached_tokens")), strict=True):
                if state is None or conv is None or conv != now:
                    if state is not None:
                        done.append(_digest(now, state))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, parts in reader.turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{''.join(p[1] for p in parts)}\n".encode())
                for span in spans:
                    learnt = reader.escapes.unescape(text[span["start"] : span["end"]])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(text)
                state[5] += tokens
            if done:
                yield pa.RecordBatch.from_pylist(done, _DIGEST)
        if state is not None:
            yield pa.RecordBatch.from_pylist([_digest(now, state)], _DIGEST)

    columns = ["conv_id", "task", "chunk", "formatted", "loss", "attached_tokens"]
    whole = chunks.where("not open").select(columns).mapInArrow(run, _DIGEST_DDL)
    rest = chunks.where("open").select(columns).repartition("conv_id").sortWithinPartitions("conv_id", "task", "chunk")
    return whole.unionByName(rest.mapInArrow(run, _DIGEST_DDL))


def _digest(conv: int | None, state: list) -> dict:
    turns, said, chars, learnt, length, tokens = state
    return {"conv_id": conv, "n_turns": turns, "turns_sha256": said.hexdigest(), "loss_chars": chars, "loss_sha256": learnt.hexdigest(), "formatted_chars": length, "attached_tokens": tokens}

