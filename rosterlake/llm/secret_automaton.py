"""Rules as one deterministic automaton over bytes.

A rule is a small expression built from byte sets: ``lit``, ``seq``, ``alt``, ``opt``,
``rep``. All rules together become an NFA, subset construction makes it
deterministic, and partition refinement minimises it. What is left is one array of
transitions, ``state * classes + class of byte``, and the rules each state accepts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np

BYTES = 256


@dataclass(frozen=True)
class Node:
    kind: str  # set, seq, alt, rep
    parts: tuple = ()
    low: int = 0
    high: int | None = None


def chars(spec: str) -> frozenset[int]:
    """Byte set of a text such as ``A-Z0-9_``; a dash is itself at the end."""
    found, i = set(), 0
    while i < len(spec):
        if i + 2 < len(spec) and spec[i + 1] == "-":
            found.update(range(ord(spec[i]), ord(spec[i + 2]) + 1))
            i += 3
        else:
            found.add(ord(spec[i]))
            i += 1
    return frozenset(found)


def one(spec: str) -> Node:
    return Node("set", (chars(spec),))


def lit(text: str, any_case: bool = False) -> Node:
    def byte(c: str) -> Node:
        both = {c.lower(), c.upper()} if any_case else {c}
        return Node("set", (frozenset(map(ord, both)),))

    return seq(*[byte(c) for c in text])


def seq(*parts: Node) -> Node:
    return Node("seq", parts)


def alt(*parts: Node) -> Node:
    return Node("alt", parts)


def rep(part: Node, low: int, high: int | None = None) -> Node:
    """``part`` from ``low`` to ``high`` times, without end for None."""
    return Node("rep", (part,), low, high)


def opt(part: Node) -> Node:
    return rep(part, 0, 1)


class _Nfa:
    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, node: Node, start: int) -> int:
        """Build ``node`` from ``start``; gives its end state."""
        if node.kind == "set":
            end = self.state()
            self.moves[start].append((node.parts[0], end))
            return end
        if node.kind == "seq":
            for part in node.parts:
                start = self.add(part, start)
            return start
        if node.kind == "alt":
            end = self.state()
            for part in node.parts:
                self.free[self.add(part, start)].append(end)
            return end
        part = node.parts[0]
        for _ in range(node.low):
            start = self.add(part, start)
        if node.high is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            return loop
        end = self.state()
        for _ in range(node.high - node.low):
            self.free[start].append(end)
            start = self.add(part, start)
        self.free[start].append(end)
        return end

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        found, open_ = set(states), list(states)
        while open_:
            for nxt in self.free[open_.pop()]:
                if nxt not in found:
                    found.add(nxt)
                    open_.append(nxt)
        return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    table: np.ndarray  # states x classes, next state
    classes: np.ndarray  # class of each byte
    accepts: tuple[frozenset[int], ...]  # rules a state accepts
    start: int
    dead: int | None  # the state no match comes back from

    @property
    def states(self) -> int:
        return len(self.accepts)


def _minimal(table: np.ndarray, accepts: list[frozenset[int]]) -> np.ndarray:
    """Block of each state: refined until states of a block agree in all their moves."""
    kinds = {a: i for i, a in enumerate(sorted(set(accepts), key=sorted))}
    block = np.array([kinds[a] for a in accepts])
    while True:
        rows = np.column_stack([block, block[table]])
        _, finer = np.unique(rows, axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            return finer
        block = finer


def compile_rules(rules: Sequence[Node], search: bool) -> Automaton:
    """All rules in one automaton. ``search``: a match may begin at any byte."""
    nfa = _Nfa()
    root = nfa.state()
    ends = {}
    for i, rule in enumerate(rules):
        begin = nfa.state()
        nfa.free[root].append(begin)
        ends[nfa.add(rule, begin)] = i
    sets = {byte_set for moves in nfa.moves for byte_set, _ in moves}
    signature = [tuple(b in s for s in sets) for b in range(BYTES)]
    numbers = {s: i for i, s in enumerate(dict.fromkeys(signature))}
    classes = np.array([numbers[s] for s in signature], np.uint8)
    sample = {numbers[s]: b for b, s in reversed(list(enumerate(signature)))}

    first = nfa.closure([root])
    index, todo, rows = {first: 0}, [first], []
    while todo:
        now = todo.pop(0)
        row = []
        for c in range(len(numbers)):
            hit = {to for s in now for byte_set, to in nfa.moves[s] if sample[c] in byte_set}
            nxt = nfa.closure(hit | ({root} if search else set()))
            if nxt not in index:
                index[nxt] = len(index)
                todo.append(nxt)
            row.append(index[nxt])
        rows.append(row)
    accepts = [frozenset(ends[s] for s in states if s in ends) for states in index]
    table = np.array(rows)
    block = _minimal(table, accepts)
    chosen = np.array([np.flatnonzero(block == b)[0] for b in range(block.max() + 1)])
    small = block[table[chosen]].astype(np.int32)
    kept = tuple(accepts[s] for s in chosen)
    stuck = [s for s in range(len(kept)) if not kept[s] and (small[s] == s).all()]
    return Automaton(small, classes, kept, int(block[0]), stuck[0] if stuck else None)
