import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import logbilinear as lb
from rosterlake.llm.common import Scratch, crc_mod
from tests.llm.corpus import SCHEMA, awkward, documents, lowered, words


def corpus():
    """Words that follow each other by rule, so that the context tells."""
    rnd = random.Random(3)
    names = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        at, text = rnd.randrange(60), []
        for _ in range(rnd.randint(20, 120)):
            at = (at * 7 + rnd.randint(1, 3)) % 60
            text.append(names[at] if rnd.random() < 0.95 else f"rare{rnd.randrange(3000)}")
        rows.append((i, " ".join(text), "aa", "s"))
    return rows + [(None if d is None else 5000 + d, *rest) for d, *rest in awkward()]


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus()
    held_out = crc_mod(F.col("doc_id"), 10) == 0
    return rows, lb.score_texts(documents(spark, rows), held_out, Scratch(spark, "t")).collect()


def test_base_score_and_counts(scored):
    rows, found = scored
    assert len(found) == len(rows)
    counts, ends = Counter(), 0
    for doc, text, *_ in rows:
        if zlib.crc32(("" if doc is None else str(doc)).encode()) % 10:
            counts.update(words(lowered(text)))
            ends += 1
    tokens, types = sum(counts.values()) + ends, len(counts) + 1
    floor = math.log10(tokens + 0.1 * (types + 1))
    texts = {d: t for d, t, *_ in rows if d is not None}
    for r in found:
        assert r.train_tokens == tokens
        if r.doc_id is None:
            continue
        held = words(lowered(texts[r.doc_id]))
        assert (r.n_tokens, r.n_known) == (len(held) + 1, sum(counts[w] > 0 for w in held) + 1)
        base = sum(math.log10(counts[w] + 0.1) - floor for w in held) + math.log10(ends + 0.1) - floor
        assert r.base_score == pytest.approx(base)


def test_model_beats_the_base_on_held_out_texts(scored):
    held = [r for r in scored[1] if r.held_out and r.doc_id is not None and r.doc_id < 5000]
    assert len(held) > 20 and all(r.score <= 0 for r in held)
    per_token = [sum(getattr(r, c) for r in held) / sum(r.n_tokens for r in held) for c in ("score", "base_score")]
    assert per_token[0] > per_token[1] + 0.05


def test_probabilities_sum_to_one():
    draw = np.random.default_rng(1)
    model = lb.LogBilinear.start(np.full(lb.CLASSES, 1 / lb.CLASSES))
    model.first *= 5
    model.bias += draw.normal(size=lb.CLASSES).astype(np.float32)
    one, two, total = model.tables()
    for _ in range(20):
        u, v = draw.integers(0, lb.CLASSES, 2)
        assert np.exp(one[u] + two[v] - total[u, v]).sum() == pytest.approx(1)


def test_words_of_a_bucket_share_its_mass(spark):
    docs = documents(spark, corpus())
    counts, vocabulary = lb.learn_counts(docs, Scratch(spark, "t"))
    mass = np.zeros(lb.CLASSES)
    frequent = set(vocabulary.words[: lb.FREQUENT])
    for r in counts.collect():
        w = r.word.encode()
        if w not in frequent:
            mass[lb.bucket(w)] += r.n + lb.SMOOTH
    mass[1 + lb.FREQUENT :] += lb.SMOOTH
    np.testing.assert_allclose(vocabulary.mass[1 + lb.FREQUENT :], mass[1 + lb.FREQUENT :])
    assert vocabulary.class_counts.sum() == vocabulary.tokens


def test_contexts_stay_inside_a_text():
    target, before, earlier = lb.contexts([np.array([5, 6, 7]), np.array([], int), np.array([8])])
    assert target.tolist() == [5, 6, 7, 0, 0, 8, 0]
    assert before.tolist() == [0, 5, 6, 7, 0, 0, 8]
    assert earlier.tolist() == [0, 0, 5, 6, 0, 0, 0]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lb.score_texts(empty, F.lit(False), Scratch(spark, "t")).collect() == []
    untrained = lb.score_texts(documents(spark, awkward(n=5)), F.lit(True), Scratch(spark, "t")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score <= 0 for r in untrained)
