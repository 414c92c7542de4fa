import random

import numpy as np
import pytest

from rosterlake.llm import decontaminate as d
from rosterlake.llm.common import Scratch
from tests.llm.corpus import SCHEMA, awkward, documents, sentence

ITEMS = "item_id bigint, text string, extra string"


def items_of(rnd, n=30):
    return [(i, sentence(rnd, rnd.randint(10, 60)).capitalize() + ".", "x") for i in range(n)]


def edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        place = rnd.randrange(len(words))
        kind = rnd.randrange(3)
        if kind == 0:
            words[place] = sentence(rnd, 1)
        elif kind == 1 and len(words) > 1:
            del words[place]
        else:
            words.insert(place, sentence(rnd, 1))
    return words


def test_exact_and_edited_passages(spark):
    rnd = random.Random(8)
    items = items_of(rnd)
    rows, want = [], set()
    for i in range(200):
        body = sentence(rnd, rnd.randint(0, 200)).split()
        if i % 2:
            item, text, _ = rnd.choice(items)
            words = text.split()
            limit = d.allowed(len(words))
            body[len(body) // 2 : len(body) // 2] = edited(rnd, words, rnd.randint(0, limit))
            want.add((i, item))
        rows.append((i, " ".join(body), "aa", "s"))
    rows += [(1000 + (i or 0), t, a, b) for i, t, a, b in awkward()]
    rows.append((3000, items[0][1].upper().replace(" ", "\n"), None, None))
    want.add((3000, 0))
    bench = spark.createDataFrame([*items, (98, None, "x"), (99, "", "x"), (97, "the and", "x")], ITEMS)
    found = d.contaminated(documents(spark, rows), bench, Scratch(spark, "t")).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(got & want) >= 0.97 * len(want)  # the target is 0.95
    exact = {(r.doc_id, r.item_id): r for r in found}
    texts = {i: t for i, t, *_ in rows}
    plain = {i: d.words_of(t.encode()) for i, t, _ in items}
    for (doc, item), r in exact.items():  # every hit is real
        stretch = d.words_of(texts[doc].encode())[r.start : r.end]
        assert distance(plain[item], stretch) == r.distance <= d.allowed(len(plain[item]))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_blocks_give_the_same(spark, monkeypatch):
    rnd = random.Random(9)
    items = items_of(rnd)
    rows = [(i, sentence(rnd, 30) + " " + items[i][1] + " " + sentence(rnd, 30), "aa", "s") for i in range(30)]
    bench = spark.createDataFrame(items, ITEMS)
    docs = documents(spark, rows)
    once = {tuple(r) for r in d.contaminated(docs, bench, Scratch(spark, "t")).collect()}
    monkeypatch.setattr(d, "BLOCK", 7)
    assert {tuple(r) for r in d.contaminated(docs, bench, Scratch(spark, "t")).collect()} == once
    assert {(i, i, 0) for i in range(30)} <= {r[:3] for r in once}


def test_clean_keeps_whole_rows(spark):
    rnd = random.Random(10)
    items = items_of(rnd, 3)
    docs = documents(spark, awkward() + [(500, "x " + items[1][1] + " y", "aa", "s"), (None, items[2][1], None, None)])
    kept = d.clean(docs, spark.createDataFrame(items, ITEMS), Scratch(spark, "t"))
    assert kept.columns == docs.columns and kept.where("size <> 'mine'").isEmpty()
    assert kept.count() == docs.count() - 2 and kept.where("doc_id = 500").isEmpty()


def test_empty_sides(spark):
    docs, bench = documents(spark, awkward(n=5)), spark.createDataFrame(items_of(random.Random(1)), ITEMS)
    none = spark.createDataFrame([], ITEMS)
    assert d.contaminated(docs, none, Scratch(spark, "t")).collect() == []
    assert d.contaminated(spark.createDataFrame([], SCHEMA), bench, Scratch(spark, "t")).collect() == []


@pytest.mark.parametrize("edits, most", [(0, 0), (2, 30)])
def test_embedding_maps_edits_to_few_places(edits, most):
    """Walks that share the coins meet again soon after an edit."""
    draw = np.random.default_rng(0)
    embedding = d.Embedding()
    words = draw.integers(1, 1 << 62, (40, 40), dtype=np.uint64)
    other = words.copy()
    for k in range(edits):
        other[:, 5 + 15 * k :] = np.roll(other[:, 5 + 15 * k :], 1, axis=1)
    same = (embedding.buckets(words) == embedding.buckets(other)).any(axis=1).mean()
    apart = (embedding.buckets(words) == embedding.buckets(words[::-1])).any(axis=1)
    assert same > (0.6 if edits else 0.999) and apart.mean() < 0.1


def found_at_the_limit(n, trials=100, seed=12):
    rnd = random.Random(seed)
    name = lambda: f"w{rnd.getrandbits(40):x}"
    items = [[name() for _ in range(n)] for _ in range(trials)]
    embedding = d.Embedding()
    searcher = d.Searcher(d.prepare([(i, " ".join(w).encode()) for i, w in enumerate(items)], embedding), embedding)
    texts = []
    for item in items:
        words = list(item)
        for _ in range(d.allowed(n)):
            place, kind = rnd.randrange(len(words)), rnd.randrange(3)
            words[place : place + (kind != 2)] = [] if kind == 1 else [name()]
        around = [name() for _ in range(rnd.randint(0, 41))]
        texts.append(" ".join(around + words + around[::-1]).encode())
    return len({(t, k) for t, k, *_ in searcher.hits(texts)} & {(i, i) for i in range(trials)}) / trials


@pytest.mark.parametrize("n", [8, 20, 28, 40, 60, 100, 200, 400])
def test_recall_at_the_limit_does_not_fall_with_length(n):
    assert found_at_the_limit(n) >= 0.95


def test_exact_items_of_one_size_at_every_place():
    item = [f"w{i}" for i in range(15)]
    embedding = d.Embedding()
    searcher = d.Searcher(d.prepare([(1, " ".join(item).encode())], embedding), embedding)
    texts = [" ".join(["x"] * k + item).encode() for k in range(20)]
    assert [hit[:3] for hit in searcher.hits(texts)] == [(k, 0, 0) for k in range(20)]


@pytest.mark.parametrize("n", range(1, 8))
def test_best_stretch_is_the_first_nearest(n):
    rnd = random.Random(n)
    for _ in range(60):
        item, text = rnd.choices("abcd", k=n), rnd.choices("abcde", k=rnd.randint(0, 12))
        spans = [(i, j) for i in range(len(text) + 1) for j in range(i, len(text) + 1)]
        want = min((distance(item, text[i:j]), j, i) for i, j in spans)
        assert d.best_stretch(item, text) == (want[0], want[2], want[1])


def test_short_items_and_scripts_without_blanks(spark):
    items = [
        (1, "Who wrote the old red book?", "x"), (2, "what colour has a ripe lemon then", "x"), (3, "Paris", "x"),
        (4, "中国最长的河流叫什么名字？", "x"), (5, "ประเทศไทยมีกี่จังหวัด", "x"), (6, "日本で一番高い山", "x"),
    ]
    rows = [
        (1, "a b who wrote THE old red book c", "aa", "s"),  # 6 words, as they are
        (2, "a who wrote the old blue book c", "aa", "s"),  # one edit in 6 is too many
        (3, "say what colour has a ripe fig then", "aa", "s"),  # 1 edit in 7
        (4, "say what hue has a ripe fig then", "aa", "s"),  # 2 edits in 7
        (5, "in Paris, once", "aa", "s"),
        (6, "parish", "aa", "s"),
        (7, "问：中国最长的河流叫什么名字?答:长江。", "aa", "s"),
        (8, "中国最长的那河流叫什么名字", "aa", "s"),  # 1 edit in 12
        (9, "โจทย์ประเทศไทยมีกี่จังหวัดครับ", "aa", "s"),
        (10, "これは日本で一番高い山です", "aa", "s"),
        (11, "中国的河流很多", "aa", "s"),
    ]
    bench, docs = spark.createDataFrame(items, ITEMS), documents(spark, rows)
    found = d.contaminated(docs, bench, Scratch(spark, "t")).collect()
    want = {(1, 1, 0, 6), (3, 2, 1, 7), (5, 3, 0, 1), (7, 4, 0, 12), (8, 4, 1, 12), (9, 5, 0, 21), (10, 6, 0, 8)}
    assert {(r.doc_id, r.item_id, r.distance, r.item_words) for r in found} == want
    left = lambda **kw: {r.doc_id for r in d.clean(docs, bench, Scratch(spark, "t"), **kw).collect()}
    assert left() == {2, 4, 6, 11} and left(least_words=7) == {1, 2, 4, 5, 6, 11}


def test_blocks_are_not_stacked(spark, monkeypatch):
    """A task holds one block of items, also where one item fills the benchmark."""
    rnd = random.Random(12)
    items = items_of(rnd, 9)
    rows = [(i, f"{sentence(rnd, 20)} {items[i % 12][1] if i % 12 < 9 else ''}", "aa", "s") for i in range(48)]
    bench = spark.createDataFrame([*items, *[items[0]] * 50], ITEMS)
    want = {r.doc_id for r in d.clean(documents(spark, rows), bench, Scratch(spark, "t")).collect()}
    assert want == {i for i in range(48) if i % 12 >= 9}
    monkeypatch.setattr(d, "BLOCK", 2)
    left = d.clean(documents(spark, rows), bench, Scratch(spark, "t"))
    assert left._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id for r in left.collect()} == want
    sizes = [len(s.bench.ids) for s in d.searchers(bench, Scratch(spark, "t"), d.ERRORS, "item_id", "text")]
    assert sum(sizes) == 9
