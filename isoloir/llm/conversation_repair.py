"""Repair of the structure of conversations, by generalised LR over their roles.

Turns of a conversation should be an optional system turn, then pairs of user and assistant.
Blank and repeated turns have to go, others may be kept, deleted or given another role, and
empty turns may be inserted anywhere; the cheapest repair is sought (``role_grammar``).

What the search needs of a turn is its role's initial and its faults, so texts are shuffled
only when repaired turns are written. Which turns repeat an earlier one is found by the role
and the hash of the text, spread over all tasks. The turns of a conversation then stream
through one task, sorted: only the few tops of the search and the edits that led to them are
kept, so that one with very many turns takes time but little memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from isoloir.llm.common import rows_of, stored
from isoloir.llm.role_grammar import DELETE, INSERT, KEEP, Automaton, Repairer

#: An optional system turn, then one pair or more; or nothing at all.
GRAMMAR = (
    ("conversation", ()),
    ("conversation", ("pairs",)),
    ("conversation", ("s", "pairs")),
    ("pairs", ("pair",)),
    ("pairs", ("pairs", "pair")),
    ("pair", ("u", "a")),
)
ROLES = {"u": "user", "a": "assistant"}
FOLLOWS = ("su", "ua", "au")
SPACES = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = (".", "!", "?")

REPAIRS = (
    "conv_id {key}, gaps long, blank long, duplicate long, truncated long, illegal long,"
    " cost long, audit string"
)
TURNS = "conv_id {key}, position long, turn long, edit string, role string, text string"
DIGESTS = REPAIRS + ", repaired_sha256 string"

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"


def _said(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """Turns of ``conv_id``, ``turn``, ``role``, ``text``, damaged by a hash of id and number.

    Of twenty kinds, one drops the turn, one empties its text, one takes the sentence ends
    out of it, one repeats the turn, and one makes it the user's. A null counts as one space.
    """
    kind = F.crc32(F.concat(_said("conv_id"), F.lit(":"), _said("turn")).cast("binary")) % 20
    text, copies = _said("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    damaged = turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(_said("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.array_repeat(F.lit(0), copies).alias("copy"),
    )
    return damaged.select("*", F.explode("copy")).drop("copy", "col")


def _picked(turns: DataFrame) -> DataFrame:
    named = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), _said("role").alias("role"), _said("text").alias("text"))
    # Turns of equal number go by role, then by this.
    return named.withColumn("text_hash", F.sha2("text", 256))


def _sorted(rows: DataFrame, *more: str) -> DataFrame:
    """One partition for a conversation, its row of kind 0 first, then its turns in order."""
    order = ("conv_id", "kind", "turn", "role", "text_hash", *more)
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def find_repairs(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation: what is wrong with it, and the cheapest repair.

    ``gaps`` counts turn numbers missing between the least and the largest; ``blank``,
    ``duplicate`` and ``truncated`` count turns by their first fault; ``illegal`` counts
    neighbours whose roles may not follow each other. ``audit`` has the initials of the edits
    (keep, rerole, delete, insert) in order; of repairs that cost the same, the least.

    Turns go by number, nulls first, then role, then the hash of the text. A null role or text
    counts as one space; a null ``conv_id`` is a conversation of its own. ``every`` may have
    conversations in ``conv_id`` that are returned even if they have no turns: with zeros and
    no edits. Other columns are ignored; an empty table gives an empty result.
    """
    layout = REPAIRS.format(key=turns.schema["conv_id"].dataType.simpleString())
    said = F.rtrim("text", F.lit(SPACES))
    blank, ends = said == "", F.right(said, F.lit(1)).isin(*SENTENCE_ENDS)
    earlier = Window.partitionBy("conv_id", "role", "text_hash").orderBy("turn")
    marked = _picked(turns).select(
        "conv_id", "turn", "role", "text_hash", F.lit(1).alias("kind"), blank.alias("blank"), ends.alias("ends")
    )
    # Equal turns of a conversation stream through one task, a number for each.
    marked = marked.withColumn("again", F.row_number().over(earlier) > 1)
    fault = F.when(F.col("blank"), BLANK).when(F.col("again"), DUPLICATE).when(~F.col("ends"), TRUNCATED)
    rows = marked.withColumn("fault", fault).drop("blank", "ends")
    if every is not None:
        none = [F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"), ("text_hash", "string"))]
        named = every.select("conv_id").distinct()
        named = named.select("conv_id", *none, F.lit(0).alias("kind"))
        rows = rows.unionByName(named, allowMissingColumns=True)
    ordered = _sorted(rows, "again").select("conv_id", "kind", "turn", F.substring("role", 1, 1).alias("initial"), "fault")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer(Automaton(GRAMMAR), "".join(ROLES))
        now: _Search | None = None
        for batch in batches:
            done = []
            for row in rows_of(batch):
                if now is None or now.conv_id != row["conv_id"]:
                    if now is not None:
                        done.append(now.result())
                    now = _Search(row["conv_id"], repairer)
                if row["kind"]:
                    now.read(row["turn"], row["initial"], row["fault"])
            yield from _batches(done, schema)
        if now is not None:
            yield from _batches([now.result()], schema)

    result = ordered.limit(0).mapInArrow(run, layout).schema
    schema = to_arrow_schema(result)
    return ordered.mapInArrow(run, result)


class _Search:
    """One conversation while its turns are read."""

    def __init__(self, conv_id: object, repairer: Repairer) -> None:
        self.conv_id, self.repairer, self.tops = conv_id, repairer, repairer.start()
        self.faults = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0)
        self.illegal, self.initial = 0, None
        self.first = self.last = None
        self.numbers = 0

    def read(self, turn: int | None, initial: str, fault: str | None) -> None:
        if fault is not None:
            self.faults[fault] += 1
        if self.initial is not None and self.initial + initial not in FOLLOWS:
            self.illegal += 1
        self.initial = initial
        if turn is not None:
            self.numbers += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        self.tops = self.repairer.step(self.tops, initial, fault in (BLANK, DUPLICATE), fault == TRUNCATED)

    def result(self) -> dict:
        cost, audit = self.repairer.finish(self.tops)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.numbers
        return {
            "conv_id": self.conv_id, "gaps": gaps, **self.faults,
            "illegal": self.illegal, "cost": cost, "audit": audit,
        }


def _batches(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _with_audits(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """The turns of every conversation behind its repair, in the order of the search."""
    rows = _picked(turns).withColumn("kind", F.lit(1))
    return _sorted(repairs.withColumn("kind", F.lit(0)).unionByName(rows, allowMissingColumns=True))


class _Replay:
    """The turns that a repair leaves, as its conversation's turns are read."""

    def __init__(self, repair: dict, repairer: Repairer) -> None:
        self.repair, self.repairer = repair, repairer
        self.stack = self.at = self.position = 0

    def _leave(self, edit: str, row: dict | None) -> dict:
        initial = row["role"][:1] if row else ""
        self.stack, role = self.repairer.replay(self.stack, edit, initial)
        out = {
            "conv_id": self.repair["conv_id"], "position": self.position, "edit": edit,
            "turn": row["turn"] if row else None, "text": row["text"] if row else "",
            "role": row["role"] if edit == KEEP else ROLES[role],
        }
        self.position += 1
        return out

    def inserted(self) -> Iterator[dict]:
        audit = self.repair["audit"]
        while self.at < len(audit) and audit[self.at] == INSERT:
            self.at += 1
            yield self._leave(INSERT, None)

    def read(self, row: dict) -> Iterator[dict]:
        yield from self.inserted()
        edit = self.repair["audit"][self.at]
        self.at += 1
        if edit != DELETE:
            yield self._leave(edit, row)


def _replays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Replay, Iterator[dict], bool]]:
    """For every row, its conversation's replay and the turns it leaves; whether it is the last."""
    repairer, now = Repairer(Automaton(GRAMMAR), "".join(ROLES)), None
    for batch in batches:
        for row in rows_of(batch):
            if row["kind"] == 0:
                if now is not None:
                    yield now, now.inserted(), True
                now = _Replay(row, repairer)
            else:
                yield now, now.read(row), False
    if now is not None:
        yield now, now.inserted(), True


def repaired_turns(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """The turns that ``find_repairs(turns)`` leaves, in order of ``position``.

    ``edit`` is what made a turn; one that is inserted has no number and an empty text. A
    conversation of whose turns none is left has no row.
    """
    layout = TURNS.format(key=turns.schema["conv_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for _, left, _ in _replays(batches):
            out += left
            if len(out) >= 256:
                yield from _batches(out, schema)
                out = []
        yield from _batches(out, schema)

    ordered = _with_audits(turns, repairs)
    result = ordered.limit(0).mapInArrow(run, layout).schema
    schema = to_arrow_schema(result)
    return ordered.mapInArrow(run, result)


def repaired_digests(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """``repairs`` with the hash of each conversation's repaired turns, ``role:text`` by line."""
    layout = DIGESTS.format(key=turns.schema["conv_id"].dataType.simpleString())
    names = [f.split()[0] for f in layout.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest = [], hashlib.sha256()
        for replay, left, last in _replays(batches):
            for turn in left:
                line = "\n" if turn["position"] else ""
                digest.update(f"{line}{turn['role']}:{turn['text']}".encode("utf-8", "surrogatepass"))
            if last:
                found = {**replay.repair, "repaired_sha256": digest.hexdigest()}
                out.append({n: found[n] for n in names})
                digest = hashlib.sha256()
            if len(out) >= 256:
                yield from _batches(out, schema)
                out = []
        yield from _batches(out, schema)

    ordered = _with_audits(turns, repairs)
    result = ordered.limit(0).mapInArrow(run, layout).schema
    schema = to_arrow_schema(result)
    return ordered.mapInArrow(run, result)


def repair_conversations(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """The rows of ``find_repairs`` with the hash of what is left of each conversation."""
    return repaired_digests(turns, stored(find_repairs(turns, every), "repairs"))
