import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import neardup
from rosterlake.llm.common import Scratch
from tests.llm.corpus import SCHEMA, awkward, documents, lowered, sentence, words


def shingles(text):
    w = words(lowered(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """Component of every id by comparing all pairs."""
    sets = {}
    for doc, text, *_ in rows:
        if doc is not None:
            sets[doc] = shingles(text)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: (len(sets[d]), find(d)) for d in ids}


def check(spark, rows):
    found = neardup.near_duplicates(documents(spark, rows), Scratch(spark, "t")).collect()
    assert len(found) == len(rows)
    want = brute(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_against_all_pairs(spark):
    check(spark, awkward())


@pytest.mark.parametrize("seed", [7, 8])
def test_crowded_groups(spark, seed):
    """A chain of near copies, and texts around one common passage that are no copies."""
    rnd = random.Random(seed)
    base, rows = sentence(rnd, 120).split(), []
    for i in range(60):
        text = list(base)
        for _ in range(rnd.randint(1, 7)):
            text[rnd.randrange(len(text))] = "x" + str(rnd.randrange(10**6))
        rows.append((i, " ".join(text), "aa", "s"))
    passage = sentence(rnd, 60)
    rows += [(100 + i, passage + " " + sentence(rnd, 25), "aa", "s") for i in range(40)]
    check(spark, rows)


@pytest.mark.parametrize("lone", [1, 2, 3])
def test_three_documents_in_one_bucket(spark, monkeypatch, lone):
    """Two of three are copies, whichever is the centre of the bucket."""
    rnd = random.Random(11)
    near, other = sentence(rnd, 100), sentence(rnd, 100)
    changed = near.split(" ")
    changed[50] = "changed"
    texts = iter([near, " ".join(changed)])
    rows = [(i, other if i == lone else next(texts), "aa", "s") for i in (1, 2, 3)]
    features = neardup.features

    def one_bucket(docs, *columns):
        # Workers have their own module, so the buckets are replaced in the frame.
        return features(docs, *columns).withColumn("buckets", F.array(F.lit(1).cast("long")))

    monkeypatch.setattr(neardup, "features", one_bucket)
    check(spark, rows)


def test_repeated_id_keeps_the_same_row(spark):
    rows = [(5, f"text number {i} of the one id", "aa", "s") for i in range(20)] + [(6, "other text here", "bb", "s")]
    kept = set()
    for n in (1, 3, 7):
        docs = documents(spark, rows).repartition(n)
        found = neardup.distinct_documents(docs, Scratch(spark, "t"))
        kept.add(tuple(sorted((r.doc_id, r.text) for r in found.collect())))
    assert len(kept) == 1 and len(kept.pop()) == 2


def test_one_document_of_a_group_stays_whole(spark):
    rows = awkward()
    docs = documents(spark, rows)
    kept = neardup.distinct_documents(docs, Scratch(spark, "t"))
    assert kept.columns == docs.columns and kept.where("size <> 'mine'").isEmpty()
    want = sorted(d for d, (_, c) in brute(rows).items() if d == c)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == want
    assert kept.where("doc_id is null").count() == 2


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert neardup.near_duplicates(empty, Scratch(spark, "t")).collect() == []


def test_signature_estimates_similarity():
    draw = np.random.default_rng(3)
    circulant = neardup.Circulant()
    for share in (0.3, 0.6, 0.9):
        estimates = []
        for _ in range(20):
            common = draw.integers(0, 1 << 63, int(1000 * share), dtype=np.uint64)
            own = draw.integers(0, 1 << 63, (2, 1000 - len(common)), dtype=np.uint64)
            a, b = (circulant.signature(np.concatenate([common, o])) for o in own)
            estimates.append(float((a == b).mean()))
        assert np.mean(estimates) == pytest.approx(len(common) / (2000 - len(common)), abs=0.04)


def test_sketch_counts_agreeing_places(spark):
    draw = np.random.default_rng(4)
    a = draw.integers(0, 1 << 21, 200)
    b = np.where(draw.random(200) < 0.5, a, a ^ 1)
    frame = spark.createDataFrame(
        [(neardup.sketch(a).tolist(), neardup.sketch(b).tolist())], "a array<bigint>, b array<bigint>"
    )
    assert frame.select(neardup.agreeing("a", "b").alias("n")).first().n == int((a == b).sum())
