"""Conversations as training text: typed content parts, turn marks, escapes and loss spans.

A turn is a list of parts. A visitor flattens them in order: text as it is, an image,
audio or document part as a numbered placeholder, whose reference and number of
tokens in the expanded prompt are recorded. Control strings inside texts are escaped,
so marks of the template are the template's own and reading back is exact.

Turns come as rows in order, one segment each; the segments of a conversation joined
are its formatted text. Nothing longer than a turn is held in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table_of

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
PART = "struct<type:string,text:string,uri:string,tokens:int>"
PARTS = f"array<{PART}>"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_MARKS = {"image": "<|image:{}|>", "audio": "<|audio:{}|>", "document": "<|document:{}|>"}

_SEGMENTS = (
    "conv_id long, position long, segment string, loss_start int, loss_end int, "
    "attachments array<struct<number:int,type:string,uri:string,tokens:int>>"
)
_SEGMENTS_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("position", pa.int64()), ("segment", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32()),
        ("attachments", pa.list_(pa.struct([("number", pa.int32()), ("type", pa.string()), ("uri", pa.string()), ("tokens", pa.int32())]))),
    ]
)
_DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_attachments long, attachment_tokens long"
)
_DIGESTS_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_attachments", pa.int64()), ("attachment_tokens", pa.int64()),
    ]
)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


@dataclass
class Flattened:
    """What a visitor has gathered: escaped text with placeholders, and attachments in order."""

    text: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)


class PartVisitor:
    """Flattens typed parts; attachments are numbered through a conversation."""

    #: Tokens of a part that does not state its own number.
    TOKENS = {"image": 576, "audio": 750, "document": 1024}

    def __init__(self, first: int = 0):
        self.number, self.out = first, Flattened()

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        if kind != "text" and kind not in _MARKS:
            raise ValueError(f"unknown kind of content part: {kind!r}")
        getattr(self, f"visit_{kind}")(part)

    def visit_text(self, part: dict) -> None:
        self.out.text.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)

    def _attach(self, kind: str, part: dict) -> None:
        tokens = self.TOKENS[kind] if part.get("tokens") is None else part["tokens"]
        self.out.attachments.append({"number": self.number, "type": kind, "uri": part.get("uri"), "tokens": tokens})
        self.out.text.append(_MARKS[kind].format(self.number))
        self.number += 1


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, position, number = object(), 0, 0
    for batch in batches:
        out: dict[str, list] = {f.name: [] for f in _SEGMENTS_ARROW}
        held = 0
        for conv_id, role, parts in zip(*[c.to_pylist() for c in batch.columns]):
            if conv_id != now:
                now, position, number = conv_id, 0, 0
            visitor = PartVisitor(number)
            for part in parts or ():
                if part is not None:
                    visitor.visit(part)
            number, body = visitor.number, "".join(visitor.out.text)
            head = f"{OPEN}{escape_role(role or '')}\n"
            learned = role == LEARNED_ROLE
            row = (
                conv_id, position, f"{head}{body}{CLOSE}\n", len(head) if learned else None,
                len(head) + len(body) if learned else None, visitor.out.attachments,
            )
            for values, value in zip(out.values(), row):
                values.append(value)
            position, held = position + 1, held + len(body)
            if held > 4 << 20:
                yield table_of(out, _SEGMENTS_ARROW)
                out, held = {f.name: [] for f in _SEGMENTS_ARROW}, 0
        yield table_of(out, _SEGMENTS_ARROW)


def format_turns(turns: DataFrame) -> DataFrame:
    """One formatted segment per turn, in order, with its loss span and attachments.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and either ``parts`` (array of
    struct type, text, uri, tokens) or ``text``. The span, in code points of the
    segment, covers an assistant's content. Columns: ``conv_id``, ``position`` (from
    0), ``segment``, ``loss_start``, ``loss_end`` (null where nothing is learned) and
    ``attachments``.

    Null texts, roles and parts are empty; a null ``conv_id`` is a conversation of its
    own, a null ``turn`` comes first; rows of one turn come by role and text; repeated
    rows are all kept; extra columns are not carried; an empty table gives no rows.
    """
    if "parts" in turns.columns:
        parts, tie = F.col("parts").cast(PARTS), F.to_json("parts")
    else:
        text = F.struct(F.lit("text").alias("type"), F.col("text"), F.lit(None).cast("string").alias("uri"), F.lit(None).cast("int").alias("tokens"))
        parts, tie = F.array(text).cast(PARTS), F.col("text")
    rows = turns.select(F.col("conv_id").cast("long"), "turn", F.col("role").cast("string"), parts.alias("parts"), tie.alias("tie"))
    in_order = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "tie")
    return in_order.select("conv_id", "role", "parts").mapInArrow(_format, _SEGMENTS)


def read_segment(segment: str) -> tuple[str, str]:
    """Role and content, unescaped, of a formatted segment; placeholders stay as they are."""
    if not segment.startswith(OPEN) or not segment.endswith(CLOSE + "\n"):
        raise ValueError("not a formatted turn")
    role, content = segment[len(OPEN) : -len(CLOSE) - 1].split("\n", 1)
    return unescape_role(role), unescape(content)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state: list | None = None

    def closed(s: list) -> tuple:
        return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), *s[5:])

    for batch in batches:
        done = []
        for conv_id, _, segment, lo, hi, attachments in zip(*[c.to_pylist() for c in batch.columns]):
            if state is None or state[0] != conv_id:
                if state is not None:
                    done.append(closed(state))
                state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
            role, content = read_segment(segment)
            state[1] += 1
            state[2].update(f"{role}\n{content}\n".encode())
            if lo is not None:
                learned = unescape(segment[lo:hi])
                state[3] += len(learned)
                state[4].update(learned.encode())
            state[5] += len(segment)
            state[6] += len(attachments)
            state[7] += sum(a["tokens"] for a in attachments)
        if done:
            yield table_of(dict(zip(_DIGESTS_ARROW.names, zip(*done))), _DIGESTS_ARROW)
    if state is not None:
        yield table_of(dict(zip(_DIGESTS_ARROW.names, zip(*[closed(state)]))), _DIGESTS_ARROW)


def digests(segments: DataFrame) -> DataFrame:
    """Per conversation, read back from its segments: turns, learned text, lengths and attachments."""
    names = [f.name for f in T.StructType.fromDDL(_SEGMENTS)]
    in_order = segments.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return in_order.mapInArrow(_digest, _DIGESTS)
