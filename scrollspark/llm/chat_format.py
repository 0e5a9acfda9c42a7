r"""Chat formatting with a grammar round trip.

A conversation is rendered with this grammar and nothing else::

    conversation := turn*
    turn         := "### " header ": " body "</turn>" "\n"
    header       := User | Assistant | System | Tool | "=" percent-encoded role
    body         := text in which "\\", "\###" and "\</turn>" stand for
                    "\", "###" and "</turn>"; a bare "###" is not allowed

The rendered text is parsed again with a deterministic parser and the recovered
turns are compared with the source.  Turns that differ, or do not parse, are
escaped one level further until all are identical:

    level 0: as it is
    level 1: a backslash before every "###" and "</turn>"
    level 2: backslashes are doubled first

Level 2 is a bijection, so the loop ends.  Ordinary texts stay untouched.

Edge cases: null texts and roles are empty strings; turns are ordered by turn
(null first), ties by role, then text, and repeated rows stay; rows with a
null conversation id form one conversation; an empty table gives no rows; extra
columns are ignored.

No task holds a conversation.  Turns are dealt by ranges of (conversation, turn, role), so
that a conversation with a third of all turns is rendered by many tasks, and a
document is a sequence of pieces of whole turns, of about ``PIECE_BYTES`` at most unless one turn
is longer.  Conversations inside one range are read back where they are; only
the pieces of those at the edges of ranges, and of those with more than one, are brought
together, and stream through the digests one at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = {"user": "User", "assistant": "Assistant", "system": "System", "tool": "Tool"}
NAMES = {name: role for role, name in ROLES.items()}
OPEN, CLOSE = "###", "</turn>"
HEADER = re.compile(r"### ([^:\n]*): ")
TOKEN = re.compile(r"\\(\\|###|</turn>)|###|</turn>")
CONTROL = re.compile(r"###|</turn>")
LEVELS = 3
PIECE_BYTES = 4 << 20  # of texts in a piece of a document, and of rows that are given on together
PIECE_ROWS = 500
ROLE_CHARS = 64  # of roles that ranges are told apart by
DIGESTS = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


class GrammarError(ValueError):
    pass


def header_of(role: str) -> str:
    return ROLES.get(role) or "=" + quote(role, safe="")


def role_of(header: str) -> str:
    if header.startswith("="):
        return unquote(header[1:])
    if header not in NAMES:
        raise GrammarError(f"unknown header {header!r}")
    return NAMES[header]


def escaped(text: str, level: int) -> str:
    if level >= 2:
        text = text.replace("\\", "\\\\")
    return CONTROL.sub(r"\\\g<0>", text) if level >= 1 else text


def rendered(role: str, text: str, level: int) -> str:
    return f"{OPEN} {header_of(role)}: {escaped(text, level)}{CLOSE}\n"


def parsed(document: str) -> Iterator[tuple[str, str, int, int]]:
    """Turns as (role, text, start, end): the span of the body in the document.  Raises GrammarError."""
    at = 0
    while at < len(document):
        head = HEADER.match(document, at)
        if not head:
            raise GrammarError(f"no turn at {at}")
        start = at = head.end()
        parts: list[str] = []
        while True:
            token = TOKEN.search(document, at)
            if not token or token[0] == OPEN:
                raise GrammarError(f"turn at {start} does not end")
            parts.append(document[at : token.start()])
            at = token.end()
            if token[0] == CLOSE:
                break
            parts.append(token[1])
        if not document.startswith("\n", at):
            raise GrammarError(f"no line end at {at}")
        yield role_of(head[1]), "".join(parts), start, token.start()
        at += 1


def recovered(document: str) -> list[tuple[str, str]] | None:
    try:
        return [(role, text) for role, text, _, _ in parsed(document)]
    except GrammarError:
        return None


def formatted_turns(turns: list[tuple[str, str]]) -> tuple[str, int]:
    """The document and the highest level of escaping in it."""
    levels = [0] * len(turns)
    for i, turn in enumerate(turns):
        while recovered(rendered(*turn, levels[i])) != [turn]:
            levels[i] += 1
            if levels[i] == LEVELS:
                raise GrammarError(f"turn {i} cannot be rendered")
    document = "".join(rendered(*turn, level) for turn, level in zip(turns, levels, strict=True))
    if recovered(document) != turns:
        raise GrammarError("the conversation does not survive the round trip")
    return document, max(levels, default=0)


def _same(x: object, y: object) -> bool:
    return x == y or (x != x and y != y)


class Outbox:
    """Joins rows to record batches of bounded rows and bytes."""

    def __init__(self, schema: pa.Schema, piece_bytes: int):
        self.schema, self.piece_bytes, self.rows, self.size = schema, piece_bytes, [], 0

    def put(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= PIECE_ROWS or self.size >= self.piece_bytes:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), self.schema, strict=True)], schema=self.schema)
        self.rows, self.size = [], 0


def formatted(conversations: DataFrame) -> DataFrame:
    """Pieces of the documents of all conversations of (conv_id, turn, role, text).

    conv_id, part (ascending inside a conversation), formatted, escape_level, loss_spans: [start, end) of
    the bodies of assistant turns, in code points of the piece; whole: the piece is the conversation's only one.
    A piece that is not marked as whole may be the only one all the same.
    """
    id_type = conversations.select("conv_id").schema[0].dataType.simpleString()
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = conversations.select("conv_id", "turn", clean("role"), clean("text"))
    dealt = turns.repartitionByRange("conv_id", "turn", F.substring("role", 1, ROLE_CHARS)).sortWithinPartitions("conv_id", "turn", "role", "text")
    piece_bytes = PIECE_BYTES

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        held: list[tuple[str, str]] = []
        size, pieces, first, current, out = 0, 0, True, None, None

        def piece(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal at
            document, level = formatted_turns(held)
            spans = [[start, end] for role, _, start, end in parsed(document) if role == "assistant"]
            yield from out.put((current, at, document, level, spans, whole), size)
            at += 1

        for batch in batches:
            out = out or Outbox(pa.schema([("conv_id", batch.schema.field("conv_id").type), ("part", pa.int64()), ("formatted", pa.string()), ("escape_level", pa.int32()), ("loss_spans", pa.list_(pa.list_(pa.int64()))), ("whole", pa.bool_())]), piece_bytes)
            names, roles, texts = (batch.column(c) for c in ("conv_id", "role", "text"))
            for i in range(batch.num_rows):
                name, role, text = names[i].as_py(), roles[i].as_py(), texts[i].as_py()
                ended = bool(held) and not _same(name, current)
                if held and (ended or size >= piece_bytes):
                    # A partition's first conversation may have begun in the one before.
                    yield from piece(ended and not first and not pieces)
                    first, pieces = first and not ended, 0 if ended else pieces + 1
                    held, size = [], 0
                current = name
                held.append((role, text))
                size += len(text)
        if held:
            yield from piece(False)
            yield from out.rest()

    return dealt.mapInArrow(render, f"conv_id {id_type}, part bigint, formatted string, escape_level int, loss_spans array<array<bigint>>, whole boolean")


class Digest:
    """Of a document whose pieces come one after the other."""

    def __init__(self):
        self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, document: str) -> Digest:
        for role, text, _, _ in parsed(document):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                self.loss.update(text.encode())
                self.loss_chars += len(text)
        self.chars += len(document)
        return self

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(pieces: DataFrame) -> DataFrame:
    """Parses formatted conversations: digests of the turns and of the text under the loss mask, which covers the bodies of assistant turns.

    pieces: conv_id, part, formatted, whole, as ``formatted`` makes them.
    """
    id_type = pieces.select("conv_id").schema[0].dataType.simpleString()
    numbers = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    piece_bytes = PIECE_BYTES
    nothing = (None,) * len(numbers)

    def whole_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digests of whole conversations; pieces of others as they are."""
        for batch in batches:
            out = Outbox(pa.schema([("conv_id", batch.schema.field("conv_id").type), ("part", pa.int64()), ("formatted", pa.string()), *numbers]), piece_bytes)
            names, parts, texts, whole = (batch.column(c) for c in ("conv_id", "part", "formatted", "whole"))
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                found = (None, *Digest().add(text).row()) if whole[i].as_py() else (text, *nothing)
                yield from out.put((names[i].as_py(), parts[i].as_py(), *found), len(found[0] or ""))
            yield from out.rest()

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, out = None, None, None
        for batch in batches:
            out = out or Outbox(pa.schema([("conv_id", batch.schema.field("conv_id").type), *numbers]), piece_bytes)
            done = list(zip(*(batch.column(name).to_pylist() for name, _ in numbers), strict=True))
            names, texts = batch.column("conv_id"), batch.column("formatted")
            for i in range(batch.num_rows):
                name = names[i].as_py()
                if digest and not _same(name, current):
                    yield from out.put((current, *digest.row()), 0)
                    digest = None
                if texts[i].is_valid:
                    current, digest = name, (digest or Digest()).add(texts[i].as_py())
                else:
                    yield from out.put((name, *done[i]), 0)
        if digest:
            yield from out.put((current, *digest.row()), 0)
        if out:
            yield from out.rest()

    some = pieces.select("conv_id", "part", "formatted", "whole").mapInArrow(whole_ones, f"conv_id {id_type}, part bigint, formatted string, {DIGESTS}")
    dealt = some.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.mapInArrow(together, f"conv_id {id_type}, {DIGESTS}")
