"""Generalised LR over a grammar of roles: automaton, stacks, and edits with their costs.

The automaton is the usual one of item sets with follow sets. A stack is a chain of states;
equal stacks are one number, so that all conversations share one small graph of stacks and
what an edit does to a stack is worked out once. Where a state allows several reductions,
all are followed.

A repair reads the turns of a conversation and keeps, for every stack that edits of the
turns so far can lead to, the least (cost, audit). Audits are not compared as texts: each
ends in an edit of the same turn, so that none begins another, and the order of two longer
ones follows from the order of what they extend and then from the letters added.
"""

from __future__ import annotations

from dataclasses import dataclass

END = "$"
KEEP, REROLE, DELETE, INSERT = "KRDI"


@dataclass(frozen=True)
class Costs:
    """What edits cost, and what a turn that is cut short costs unless it is deleted."""

    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1


class Automaton:
    """States of a grammar given as (head, body) productions; the first head is the goal."""

    def __init__(self, productions: tuple[tuple[str, tuple[str, ...]], ...]) -> None:
        self.productions = (("", (productions[0][0],)), *productions)
        self.heads = {head for head, _ in self.productions}
        self.follow = self._follow()
        start = self._closure({(0, 0)})
        self.states = [start]
        self.goto: dict[tuple[int, str], int] = {}
        for state in self.states:  # grows meanwhile
            for symbol in {s for item in state if (s := self._next(item))}:
                kernel = {(p, dot + 1) for p, dot in state if self._next((p, dot)) == symbol}
                target = self._closure(kernel)
                if target not in self.states:
                    self.states.append(target)
                self.goto[self.states.index(state), symbol] = self.states.index(target)

    def _next(self, item: tuple[int, int]) -> str | None:
        body = self.productions[item[0]][1]
        return body[item[1]] if item[1] < len(body) else None

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        found, new = set(items), list(items)
        while new:
            wanted = self._next(new.pop())
            more = {(p, 0) for p, (head, _) in enumerate(self.productions) if head == wanted}
            new += more - found
            found |= more
        return frozenset(found)

    def _follow(self) -> dict[str, set[str]]:
        """Terminals that can come after each head; bodies begin with their first symbol."""
        empty = {head for head, body in self.productions if not body}
        first: dict[str, set[str]] = {h: set() for h in self.heads}
        follow: dict[str, set[str]] = {h: {END} if not h else set() for h in self.heads}
        before = None
        while before != (before := repr((sorted(empty), sorted(map(str, first.items())), sorted(map(str, follow.items()))))):
            for head, body in self.productions:
                if all(s in empty for s in body):
                    empty.add(head)
                after = set(follow[head])
                for symbol in reversed(body):
                    if symbol in self.heads:
                        follow[symbol] |= after
                        after = first[symbol] | (after if symbol in empty else set())
                    else:
                        after = {symbol}
                for symbol in body:
                    first[head] |= first.get(symbol, {symbol})
                    if symbol not in empty:
                        break
        return follow

    def advance(self, stack: tuple[int, ...], symbol: str) -> set[tuple[int, ...]]:
        """The stacks after ``symbol``, shifted behind all reductions that it allows.

        For the end, which is never shifted, the stacks that accept.
        """
        found, open_ = set(), [stack]
        while open_:
            stack = open_.pop()
            for p, dot in self.states[stack[-1]]:
                head, body = self.productions[p]
                if dot < len(body) or symbol not in self.follow[head]:
                    continue
                if not p:
                    found.add(stack)
                    continue
                below = stack[: len(stack) - len(body)]
                open_.append((*below, self.goto[below[-1], head]))
            target = self.goto.get((stack[-1], symbol))
            if target is not None:
                found.add((*stack, target))
        return found


@dataclass
class Top:
    """The best way to a stack: its cost, its place among all audits, and its last edits."""

    cost: int
    rank: int
    edits: tuple | None


class Repairer:
    """Least edits that make the roles of a conversation a sentence of the grammar.

    Roles are told by ``initial``; ``inserted`` are the initials that may be inserted or given
    to a turn, in the order in which they are tried.
    """

    def __init__(self, automaton: Automaton, inserted: str = "ua", costs: Costs = Costs()) -> None:
        self.automaton, self.inserted, self.costs = automaton, inserted, costs
        self.stacks: list[tuple[int, ...]] = [(0,)]
        self.numbers = {(0,): 0}
        self._insertions: dict[int, list[tuple[int, int, str]]] = {}
        self._moves: dict[tuple, list[tuple[int, int, str]]] = {}

    def number(self, stack: tuple[int, ...]) -> int:
        if stack not in self.numbers:
            self.numbers[stack] = len(self.stacks)
            self.stacks.append(stack)
        return self.numbers[stack]

    def after(self, stack: int, initial: str) -> list[int]:
        return sorted(self.number(s) for s in self.automaton.advance(self.stacks[stack], initial))

    def insertions(self, stack: int) -> list[tuple[int, int, str]]:
        """Stacks that insertions lead to, itself included, with cost and audit: the fewest."""
        if stack not in self._insertions:
            found, new, letters = {stack: ""}, [stack], ""
            while new:
                letters += INSERT
                new = [t for s in new for i in self.inserted for t in self.after(s, i) if t not in found]
                found.update(dict.fromkeys(new, letters))
            cost = self.costs.insert
            self._insertions[stack] = [(t, cost * len(x), x) for t, x in found.items()]
        return self._insertions[stack]

    def moves(self, stack: int, initial: str, delete: bool, truncated: bool) -> list[tuple[int, int, str]]:
        """Where a turn takes a stack, with least cost and audit; insertions may come before it."""
        key = (stack, initial, delete, truncated)
        if key not in self._moves:
            best: dict[int, tuple[int, str]] = {}
            for at, cost, letters in self.insertions(stack):
                ways = [(at, self.costs.delete, DELETE)]
                if not delete:
                    extra = self.costs.truncated if truncated else 0
                    ways += [(t, extra, KEEP) for t in self.after(at, initial)]
                    ways += [
                        (t, extra + self.costs.rerole, REROLE)
                        for role in self.inserted
                        for t in self.after(at, role)
                    ]
                for target, more, letter in ways:
                    way = (cost + more, letters + letter)
                    best[target] = min(best.get(target, way), way)
            self._moves[key] = [(t, cost, x) for t, (cost, x) in best.items()]
        return self._moves[key]

    def start(self) -> dict[int, Top]:
        return {0: Top(0, 0, None)}

    def step(self, tops: dict[int, Top], initial: str, delete: bool, truncated: bool) -> dict[int, Top]:
        """The tops after one more turn: of equal stacks the least cost, then audit."""
        best: dict[int, tuple[int, int, str]] = {}
        whose: dict[int, Top] = {}
        for stack, top in tops.items():
            for target, cost, letters in self.moves(stack, initial, delete, truncated):
                way = (top.cost + cost, top.rank, letters)
                if target not in best or way < best[target]:
                    best[target], whose[target] = way, top
        ranks = {key: k for k, key in enumerate(sorted({way[1:] for way in best.values()}))}
        return {
            stack: Top(way[0], ranks[way[1:]], (whose[stack].edits, way[2]))
            for stack, way in best.items()
        }

    def finish(self, tops: dict[int, Top]) -> tuple[int, str]:
        """Cost and audit of the best way to a whole sentence."""
        ways = [
            ((top.cost + cost, top.rank, letters), top.edits)
            for stack, top in tops.items()
            for target, cost, letters in self.insertions(stack)
            if self.after(target, END)
        ]
        (cost, _, letters), edits = min(ways, key=lambda w: w[0])
        audit = [letters]
        while edits is not None:
            edits, letters = edits
            audit.append(letters)
        return cost, "".join(reversed(audit))

    def replay(self, stack: int, letter: str, initial: str) -> tuple[int, str]:
        """The stack after an edit of an audit, and the initial of the turn it leaves."""
        for role in [initial] if letter == KEEP else self.inserted:
            found = self.after(stack, role)
            if found:
                return found[0], role
        raise ValueError(f"{letter} of {initial!r} is no edit here")
