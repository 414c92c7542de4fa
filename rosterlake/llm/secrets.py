"""Secrets by a combined automaton.

All rules run as one deterministic automaton over the bytes of a batch, many pieces of
text side by side: one step of a vectorised loop advances every piece by one byte. A
piece ends at a byte after which the automaton is back at its start whatever came
before, so a piece is scanned on its own and no match is cut. Pieces in which some
rule accepted, which are few, are read again by the automata of the single rules, that
give start and longest end of each match; a rule's matches do not overlap.

Cases: a null or empty text has no span; a text is scanned whole, however long, and
positions count code points; input columns named like a result column are replaced;
all other columns and repeated rows pass through; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.llm.common import with_columns
from rosterlake.llm.secret_automaton import Automaton, Node, alt, compile_rules, lit, one, opt, rep, seq

PIECE = 512


@dataclass(frozen=True)
class Rule:
    kind: str
    node: Node
    least: int = 0  # shortest match; shorter ones are dropped
    least_value: int = 0  # shortest value after the separator, likewise


_WORDY = "A-Za-z0-9"

# The base rules and the public formats of further keys.
RULES = (
    Rule(
        "assign",
        seq(
            alt(
                *[lit(w, any_case=True) for w in ("password", "passwd", "secret", "token")],
                seq(lit("api", any_case=True), opt(one("_")), lit("key", any_case=True)),
            ),
            opt(one("\"'")),
            rep(one(" "), 0),
            one(":="),
            rep(one(" "), 0),
            opt(one("\"'")),
            rep(one(f"{_WORDY}+/_.=-"), 1),
        ),
        least_value=6,
    ),
    Rule("access", seq(lit("AKIA"), rep(one("A-Z0-9"), 1)), least=20),
    Rule("hex", rep(one("0-9a-f"), 24)),
    Rule("github", seq(lit("gh"), one("pousr"), lit("_"), rep(one(_WORDY), 1)), least=40),
    Rule("google", seq(lit("AIza"), rep(one(f"{_WORDY}_-"), 1)), least=39),
    Rule("slack", seq(lit("xox"), one("abprs"), lit("-"), rep(one(f"{_WORDY}-"), 1)), least=15),
    Rule("stripe", seq(one("sr"), lit("k_live_"), rep(one(_WORDY), 1)), least=32),
    Rule(
        "private_key",
        seq(lit("-----BEGIN "), opt(alt(lit("RSA "), lit("EC "), lit("OPENSSH "))), lit("PRIVATE KEY-----")),
    ),
)
BASE = ("assign", "access", "hex")
SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def value_length(match: bytes) -> int:
    """Length of what follows the separator, blanks and an opening quote."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    value = match[at + 1 :].lstrip(b" ")
    return len(value[1:] if value[:1] in (b'"', b"'") else value)


class Scanner:
    """The compiled rules."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        whole = compile_rules([r.node for r in rules], search=True)
        # Accepting states last: the largest state seen tells whether a piece accepted.
        order = np.argsort([bool(a) for a in whole.accepts], kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        table = place[whole.table[order]]
        self.first_accepting = int(sum(not a for a in whole.accepts))
        self.start, self.width = int(place[whole.start]), table.shape[1]
        self.flat = (table * self.width).astype(np.int32).reshape(-1)
        self.classes = whole.classes
        resets = (table == self.start).all(axis=0)
        self.is_reset = resets[whole.classes]
        if not self.is_reset[ord("\n")]:
            raise ValueError("a rule may not span lines")
        self.single = [self._rows(compile_rules([r.node], search=False)) for r in rules]

    @staticmethod
    def _rows(automaton: Automaton):
        """Rows of next states by byte; None is the dead state."""
        rows = automaton.table[:, automaton.classes].tolist()
        dead = automaton.dead
        rows = [[None if s == dead else s for s in row] for row in rows]
        firsts = {b for b in range(256) if rows[automaton.start][b] is not None}
        return rows, [bool(a) for a in automaton.accepts], automaton.start, firsts

    def accepted_pieces(self, data: np.ndarray) -> list[tuple[int, int]]:
        """Bounds of the pieces in which a rule accepts."""
        ends = np.flatnonzero(self.is_reset[data])
        wanted = np.searchsorted(ends, np.arange(PIECE, len(data), PIECE))
        cuts = np.unique(ends[wanted[wanted < len(ends)]] + 1)
        bounds = np.concatenate([[0], cuts[cuts < len(data)], [len(data)]])
        starts, sizes = bounds[:-1], np.diff(bounds)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        symbols = self.classes[data]
        state = np.full(len(starts), self.start * self.width, np.int32)
        highest = state.copy()
        active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
        for i, n in enumerate(active.tolist()):
            now = self.flat[state[:n] + symbols[starts[:n] + i]]
            state[:n] = now
            np.maximum(highest[:n], now, out=highest[:n])
        hit = np.flatnonzero(highest >= self.first_accepting * self.width)
        return [(int(starts[k]), int(starts[k] + sizes[k])) for k in hit]

    def matches(self, piece: bytes):
        """``(kind number, start, end)`` of a piece, in bytes: leftmost, longest, not overlapping."""
        for number, (rule, (rows, accepts, first, firsts)) in enumerate(zip(self.rules, self.single)):
            at, size = 0, len(piece)
            while at < size:
                if piece[at] not in firsts:
                    at += 1
                    continue
                state, here, end = first, at, -1
                while here < size:
                    state = rows[state][piece[here]]
                    if state is None:
                        break
                    here += 1
                    if accepts[state]:
                        end = here
                if end < 0:
                    at += 1
                    continue
                if end - at >= rule.least and (
                    not rule.least_value or value_length(piece[at:end]) >= rule.least_value
                ):
                    yield number, at, end
                at = end

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """``(start, kind number, end)`` in code points of every text, sorted."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        joined = b"\n".join(texts)
        if not joined:
            return found
        data = np.frombuffer(joined, np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        for low, high in self.accepted_pieces(data):
            for number, start, end in self.matches(joined[low:high]):
                doc = int(np.searchsorted(offsets, low + start, side="right")) - 1
                begin = int(offsets[doc])
                before = _points(data[begin : low + start])
                found[doc].append((before, number, before + _points(data[low + start : low + end])))
        return [sorted(f) for f in found]


def _points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def find_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``spans``: kind, start and end of every match, by start and kind."""
    scanner = Scanner(rules)  # compiled once, tasks get the arrays

    def compute(texts: list[bytes], _) -> list[pa.Array]:
        rows = [
            [{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in spans]
            for spans in scanner.spans(texts)
        ]
        return [pa.array(rows, _SPAN_TYPE)]

    return with_columns(docs, [T.StructField("spans", SPANS)], compute, text)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and joined texts of the spans of every row."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE]
    return found.select(
        key, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
