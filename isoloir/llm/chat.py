"""Chat formatting: typed content parts, a reversible template, a loss mask.

A turn is ``<|im_start|>role``, a line break, its content, ``<|im_end|>``, a line
break. Content is a list of typed parts. A visitor writes text parts escaped and
puts a numbered placeholder for every image, audio and document part, records
which attachment it stands for, and counts the tokens it will expand to.

A conversation is never gathered: Spark sorts its turns into one partition, and
they stream through a task one by one, so one with very many turns costs time
but no memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from isoloir.llm.common import rows_of

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens that a unit of an attachment expands to: a 512-pixel tile, a second, a page.
TOKENS_PER_UNIT = {"image": 170, "audio": 25, "document": 500}
LEARNED_ROLE = "assistant"

#: Control strings of this and other templates begin so; none may appear in a text.
_CONTROL = re.compile(
    r"\\|<(?=\|im_start\|>|\|im_end\|>|\|(?:image|audio|document):\d+\|>|/?s>)|\[(?=/?INST\])"
)
_ESCAPES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_PLAIN = {"\\": "\\", "l": "<", "b": "[", "n": "\n"}
_PLACEHOLDER = re.compile(r"<\|(image|audio|document):(\d+)\|>")

PARTS = "array<struct<kind: string, text: string, ref: string, units: double>>"
FORMATTED = (
    "conv_id {key}, position long, formatted string, start long,"
    " loss array<struct<start: int, end: int>>,"
    " attachments array<struct<number: int, kind: string, ref: string, tokens: long>>,"
    " expanded_tokens long"
)
DIGESTS = (
    "conv_id {key}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long, n_attachments long, expanded_tokens long"
)


def escape(text: str) -> str:
    """No control string is left; ``unescape`` gives the text back."""
    return _CONTROL.sub(lambda m: _ESCAPES[m.group()], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m.group(1)], text)


@dataclass
class TurnVisitor:
    """Flattens the parts of one turn; offsets count code points of the content."""

    content: list[str] = field(default_factory=list)
    length: int = 0
    texts: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict | None) -> None:
        """A null part, or one of an unknown kind without text, adds nothing."""
        kind = (part or {}).get("kind") or "text"
        if kind in TOKENS_PER_UNIT:
            self.visit_attachment(kind, part)
        else:
            self.visit_text((part or {}).get("text") or "")

    def visit_text(self, text: str) -> None:
        start = self.length
        self._add(escape(text))
        if self.length > start:
            self.texts.append((start, self.length))

    def visit_attachment(self, kind: str, part: dict) -> None:
        tokens = max(1, round((part.get("units") or 0) * TOKENS_PER_UNIT[kind]))
        number = len(self.attachments)
        self.attachments.append(
            {"number": number, "kind": kind, "ref": part.get("ref"), "tokens": tokens}
        )
        self._add(f"<|{kind}:{number}|>")

    def _add(self, piece: str) -> None:
        self.content.append(piece)
        self.length += len(piece)


def text_parts(text: str) -> Column:
    """A plain text column as a list of one text part."""
    none = F.lit(None)
    part = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        none.cast("string").alias("ref"),
        none.cast("double").alias("units"),
    )
    return F.array(part)


def format_conversations(
    turns: DataFrame,
    parts: Column,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
) -> DataFrame:
    """One row per turn, of a conversation in order and in one partition.

    ``formatted`` is the turn's piece of the conversation and ``start`` its place
    there; ``loss`` has the spans of the piece that are learned: the texts of an
    assistant's turn. Turns of equal number go by role, then content. A null role is
    empty; null parts or text are an empty turn; a null ``conv_id`` is a conversation of
    its own. An empty table gives an empty result; other columns are ignored.
    """
    key = turns.schema[conv_id].dataType.simpleString()
    picked = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        parts.cast(PARTS).alias("parts"),
    )
    ordered = picked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = run  # no conversation has this id
        position = start = 0
        for batch in batches:
            out = []
            for row in rows_of(batch):
                if row["conv_id"] != now:
                    now, position, start = row["conv_id"], 0, 0
                visitor = TurnVisitor()
                for part in row["parts"] or []:
                    visitor.visit(part)
                head = f"{START}{escape(row['role']).replace('\n', '\\n')}\n"
                piece = f"{head}{''.join(visitor.content)}{END}\n"
                learned = visitor.texts if row["role"] == LEARNED_ROLE else []
                out.append(
                    {
                        "conv_id": now,
                        "position": position,
                        "formatted": piece,
                        "start": start,
                        "loss": [{"start": a + len(head), "end": b + len(head)} for a, b in learned],
                        "attachments": visitor.attachments,
                        "expanded_tokens": sum(a["tokens"] for a in visitor.attachments),
                    }
                )
                position, start = position + 1, start + len(piece)
            yield from _batches(out, schema)

    layout = ordered.limit(0).mapInArrow(run, FORMATTED.format(key=key)).schema
    schema = to_arrow_schema(layout)
    return ordered.mapInArrow(run, layout)


def _batches(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def parse_turn(formatted: str, loss: list[dict]) -> tuple[str, str, list[str]]:
    """Role, text and learned texts that a formatted turn holds."""
    head, _, rest = formatted.partition("\n")
    if not (head.startswith(START) and rest.endswith(f"{END}\n")):
        raise ValueError(f"not a formatted turn: {formatted[:80]!r}")
    content = rest[: -len(END) - 1]
    texts = [unescape(formatted[s["start"] : s["end"]]) for s in loss]
    return unescape(head[len(START) :]), unescape(_PLACEHOLDER.sub("", content)), texts


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, from its formatted turns alone.

    Takes the rows as ``format_conversations`` leaves them: a conversation's turns in
    order and in one partition. ``turns_sha256`` is over role and text of each turn, both
    followed by a line break; ``loss_sha256`` over all learned text. A null ``conv_id`` is a
    conversation of its own; a turn that the template did not write raises; an empty table
    gives an empty result.
    """
    key = formatted.schema["conv_id"].dataType.simpleString()
    fields = [f.split()[0] for f in DIGESTS.format(key="-").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []
        for batch in batches:
            done = []
            for row in rows_of(batch):
                if not state or row["conv_id"] != state[0]:
                    if state:
                        done.append(_digest(state, fields))
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                role, text, learned = parse_turn(row["formatted"], row["loss"])
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                for piece in learned:
                    state[3] += len(piece)
                    state[4].update(piece.encode())
                state[5] += len(row["formatted"])
                state[6] += len(row["attachments"])
                state[7] += row["expanded_tokens"]
            yield from _batches(done, schema)
        if state:
            yield from _batches([_digest(state, fields)], schema)

    layout = formatted.limit(0).mapInArrow(run, DIGESTS.format(key=key)).schema
    schema = to_arrow_schema(layout)
    return formatted.mapInArrow(run, layout)


def _digest(state: list, fields: list[str]) -> dict:
    values = [v.hexdigest() if hasattr(v, "hexdigest") else v for v in state]
    return dict(zip(fields, values, strict=True))
