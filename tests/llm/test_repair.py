import hashlib
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from isoloir.llm import conversation_repair as repair
from isoloir.llm.role_grammar import Automaton, Repairer
from pyspark.sql import functions as F

from .conftest import sentence

SENTENCE = re.compile(r"(s?(ua)+)?\Z")
KINDS = {"u": "user", "a": "assistant", "s": "system", "t": "tool", " ": " "}


def repairer():
    return Repairer(Automaton(repair.GRAMMAR), "ua")


def searched(turns):
    """Cost and audit of (initial, fault) turns, by the search."""
    search = repairer()
    tops = search.start()
    for initial, fault in turns:
        tops = search.step(tops, initial, fault in ("blank", "duplicate"), fault == "truncated")
    return search.finish(tops)


def every_repair(turns):
    """Cost, audit and roles of all edits, with up to two insertions in a row."""
    gaps = [(("", ""), ("I", "u"), ("I", "a"), ("II", "ua"), ("II", "au"))] * (len(turns) + 1)
    edits = []
    for initial, fault in turns:
        extra = 1 if fault == "truncated" else 0
        ways = [(3, "D", "")]
        if fault not in ("blank", "duplicate"):
            ways += [(extra, "K", initial), (2 + extra, "R", "u"), (2 + extra, "R", "a")]
        edits.append(ways)
    for added in product(*gaps):
        for chosen in product(*edits):
            cost = sum(2 * len(x) for x, _ in added) + sum(c for c, _, _ in chosen)
            audit, roles = added[0]
            for (_, letter, role), (more, new) in zip(chosen, added[1:], strict=True):
                audit, roles = audit + letter + more, roles + role + new
            if SENTENCE.match(roles):
                yield cost, audit


turn = st.tuples(st.sampled_from("uas "), st.sampled_from(["", "blank", "duplicate", "truncated"]))


@settings(max_examples=120, deadline=None)
@given(st.lists(turn, max_size=4))
def test_the_search_finds_the_least_of_all_edits(turns):
    assert searched(turns) == min(every_repair(turns))


@settings(max_examples=60, deadline=None)
@given(st.lists(turn, max_size=40))
def test_an_audit_replays_to_a_sentence(turns):
    cost, audit = searched(turns)
    assert sum(x != "I" for x in audit) == len(turns)
    search, stack, said, rest = repairer(), 0, "", iter(turns)
    for letter in audit:
        initial = "" if letter == "I" else next(rest)[0]
        if letter != "D":
            stack, role = search.replay(stack, letter, initial)
            said += role
    assert SENTENCE.match(said)


def test_the_automaton_tells_sentences():
    machine = Automaton(repair.GRAMMAR)
    for n in range(7):
        for word in product("sua", repeat=n):
            stacks = {(0,)}
            for symbol in word:
                stacks = {t for s in stacks for t in machine.advance(s, symbol)}
            accepted = any(machine.advance(s, "$") for s in stacks)
            assert accepted == bool(SENTENCE.match("".join(word)))


def test_grammars_that_need_several_stacks():
    # An even palindrome: where its middle is cannot be told from what comes before.
    machine = Automaton((("p", ()), ("p", ("u", "p", "u")), ("p", ("a", "p", "a"))))
    for n in range(7):
        for word in product("ua", repeat=n):
            stacks = {(0,)}
            for symbol in word:
                stacks = {t for s in stacks for t in machine.advance(s, symbol)}
            accepted = any(machine.advance(s, "$") for s in stacks)
            assert accepted == (n % 2 == 0 and word == word[::-1])


TURNS = [
    (1, 0, "user", "Hello."),
    (1, 1, "assistant", "Hi there."),
    (1, 1, "assistant", "Hi there."),
    (1, 5, "assistant", "cut sho"),
    (2, 3, "assistant", "First."),
    (2, None, "user", None),
    (2, 9, None, "Who?"),
    (2, 9, "tool", " \t\x0b\n"),
    (None, 0, "system", "Be good. \n"),
    (None, 1, "user", "So.\x1c"),
    (3, 0, "user", ""),
    (4, 0, "", "No role."),
    (5, None, "user", "é?"),
    (5, None, "user", "é?"),
    *[(6, k, ("user", "assistant")[k % 2], sentence(k, 6) + "." * (k % 7 > 0)) for k in range(3000)],
    (7, 0, "system", "Alone."),
    (8, 0, "assistant", "x" * 400_000 + "!"),
]


def by_hand(turns, ids):
    """Faults, repair by the search alone, and the text it leaves, one conversation at a time."""
    found = defaultdict(list)
    for conv, number, role, text in turns:
        found[conv].append((number, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv in ids:
        key = lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).hexdigest())
        rows = sorted(found[conv], key=key)
        faults, seen = [], set()
        for _, role, text in rows:
            said = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
            faults.append(fault)
            seen.add((role, text))
        numbers = {n for n, _, _ in rows if n is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
        cost, audit = searched([(r[1][:1], f) for r, f in zip(rows, faults, strict=True)])
        left, rest = [], iter(rows)
        for letter in audit:
            row = (None, "", "") if letter == "I" else next(rest)
            if letter == "D":
                continue
            first = left[0][0][:1] if left else ""
            place = len(left) + (first == "s")
            role = row[1] if letter == "K" else ("user", "assistant")[place % 2]
            left.append((role, row[2]))
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
        )
    return out


def frame(spark, turns):
    rows = [(*t, "x", 1) for t in turns]
    schema = "conv_id long, turn long, role string, text string, audit string, kind int"
    return spark.createDataFrame(rows, schema).repartition(3)


def test_conversations_are_repaired_like_by_hand(spark):
    turns = frame(spark, TURNS)
    every = spark.createDataFrame([(9,), (1,), (9,), (None,)], "conv_id long")
    got = {r[0]: tuple(r[1:]) for r in repair.repair_conversations(turns, every).collect()}
    assert got == by_hand(TURNS, {t[0] for t in TURNS} | {9})
    assert got[9] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.find_repairs(turns.where("false")).collect() == []


def test_repaired_turns_are_whole_conversations(spark):
    turns = frame(spark, TURNS)
    found = repair.find_repairs(turns).cache()
    left = defaultdict(list)
    for r in sorted(repair.repaired_turns(turns, found).collect(), key=lambda r: r.position):
        assert r.position == len(left[r.conv_id])
        left[r.conv_id].append(r)
    want = by_hand(TURNS, {t[0] for t in TURNS})
    for conv, rows in left.items():
        assert SENTENCE.match("".join(r.role[:1] for r in rows))
        said = "\n".join(f"{r.role}:{r.text}" for r in rows)
        assert hashlib.sha256(said.encode()).hexdigest() == want[conv][-1]
        assert [r.edit for r in rows] == [x for x in want[conv][-2] if x != "D"]
    assert {conv for conv, w in want.items() if set(w[-2]) - {"D"}} == set(left)


def test_damage_goes_by_the_hash_of_id_and_number(spark):
    odd = [(k, n, r, t) for k in range(40) for n, r, t in ((0, "user", "A.b!c?"), (1, None, None), (None, "assistant", "x."))]
    odd += [(None, k, "user", "y!") for k in range(40)]
    want = []
    said = lambda v: " " if v is None else v
    for conv, number, role, text in odd:
        kind = zlib.crc32(f"{said(conv)}:{said(number)}".encode()) % 20
        role, text = said(role), said(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        want += [(conv, number, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    got = repair.damage(frame(spark, odd)).select("conv_id", "turn", "role", "text")
    key = lambda t: tuple(map(repr, t))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("rows", [0, 5000])
def test_one_conversation_of_all_rows(spark, rows):
    turns = spark.range(rows).select(
        F.lit(1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"),
    )
    got = [tuple(r[1:]) for r in repair.repair_conversations(turns).collect()]
    local = [(1, k, "assistant" if k % 3 else "user", f"{k}.") for k in range(rows)]
    assert got == ([by_hand(local, [1])[1]] if rows else [])
