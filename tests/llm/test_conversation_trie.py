"""The prefix trie against plain dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from rosterlake.llm import conversation_trie as trie
from rosterlake.llm.common import Scratch

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, digest int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "mine", 7, "own") for r in rows], SCHEMA)


def ordered(rows):
    """Turns of every conversation as the module orders them."""
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            found.setdefault(conv, []).append((turn is not None, turn or 0, name, (role, text)))
    return {c: [t[3] for t in sorted(turns)] for c, turns in found.items()}


def rebuilt(rows):
    own = ordered(rows)
    result = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        result[c] = own.get(first, [])[:h] + turns[h:]
    return result


def plain(paths):
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        ends = sorted(c for c in convs if len(paths[c]) == len(prefix))
        leaves = [p for p in below if not any(q[:-1] == p and q for q in members)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        rows.append(
            (min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs), len(children),
             len(leaves), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
        )
    return sorted(rows, key=str)


def found(spark, rows, block=trie.BLOCK, fork=True):
    scratch = Scratch(spark, "trie-test")
    placed, sizes = trie.numbered(trie.turns(frame(spark, rows)), scratch)
    path, lengths = (trie.forked if fork else trie.whole)(placed, sizes)
    nodes, ends = trie.prefix_trie(path, lengths, scratch, block)
    return sorted([tuple(r) for r in trie.described(nodes, ends).collect()], key=str), nodes


def awkward(seed=3, n=30):
    rnd = random.Random(seed)
    said = [("user", "hi"), ("assistant", "hello"), ("user", "é ü"), (None, "x"), ("user", None), ("user:", "a"), ("user", ":a")]
    rows = []
    for c in [*range(n), -7, -5, -3, 10**12]:
        shared = rnd.randint(0, 9)
        draw = random.Random(c % 3)
        for t in range(rnd.randint(1, 14)):
            role, text = draw.choice(said) if t < shared else rnd.choice(said)
            rows.append((c, t, role, text))
    rows += [(50 + k, t, "user", f"copy {t}") for k in range(12) for t in range(11)]  # copies
    rows += [(70, None, "user", "untimed"), (70, 1, "user", "b"), (70, 1, "user", "a"), (70, 1, "user", "a")]
    rows += [(71, 0, "user", "long " * 20_000), (None, 0, "user", "nobody"), (80, None, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1, 3, 4])
def test_trie_equals_plain(spark, block):
    rows = awkward()
    assert found(spark, rows, block)[0] == plain(rebuilt(rows))


def test_whole_conversations_and_texts(spark):
    rows = awkward(seed=5, n=12)
    got, nodes = found(spark, rows, fork=False)
    assert got == plain(ordered(rows))
    paths = ordered(rows)
    for r in trie.with_turns(nodes, frame(spark, rows)).collect():
        assert (r.role, r.text) == (paths[r.conv_id][r.depth - 1] if r.depth else (None, None))


def test_long_conversations_are_cut(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 3)
    monkeypatch.setattr(trie, "CHUNK", 2)
    monkeypatch.setattr(trie, "CROWDED", 2)
    rows = [(c, t, "user", str(t if t < 60 else c * t)) for c in range(6) for t in range(70)]
    rows += [(10 + c, 0, "user", "0") for c in range(9)]
    assert found(spark, rows)[0] == plain(rebuilt(rows))


def test_empty_table(spark):
    assert found(spark, [])[0] == []
    assert found(spark, [(None, 0, "user", "nobody")])[0] == []
