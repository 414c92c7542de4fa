import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import mil, toxicity
from rosterlake.llm.common import Scratch, crc_mod
from tests.llm.corpus import SCHEMA, awkward, documents, sentence

LABELS = "doc_id bigint, quality int, toxic int"


def accuracy(found, labels):
    rows = [r for r in found.collect() if r.held_out and r.doc_id in labels]
    assert len(rows) > 20
    return sum(r.predicted == labels[r.doc_id] for r in rows) / len(rows)


def test_quality_by_attention(spark):
    rnd = random.Random(2)
    rows, labels = [], {}
    for i in range(500):
        good, bad = sentence(rnd, rnd.randint(30, 300)), sentence(rnd, 40).replace(" ", "*** ")
        labels[i] = int(i % 4 != 0)
        rows.append((i, good if labels[i] else f"{good}\n{bad}", "aa", "s"))
    frame = spark.createDataFrame([(d, y, 0) for d, y in labels.items()], LABELS)
    docs = documents(spark, rows + [(9000 + i, t, a, b) for i, (_, t, a, b) in enumerate(awkward())])
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = mil.train(docs, frame, held_out)
    found = mil.classify(docs, model).withColumn("held_out", held_out)
    assert accuracy(found, labels) > 0.95
    assert found.where("score is null or score < 0 or score > 1").isEmpty() and found.where("size <> 'mine'").isEmpty()
    kept = mil.select_documents(docs, model)
    assert kept.columns == docs.columns and kept.count() == found.where("predicted = 1").count()


def test_gradients_of_the_attention_model():
    draw = np.random.default_rng(0)
    bags = [draw.normal(size=(n, mil.FEATURES)) for n in (1, 3, 5)]
    y = np.array([1.0, 0.0, 1.0])
    model = mil.fit(bags, y)
    rows, counts = np.concatenate(bags), np.array([1, 3, 5])

    def loss():
        s = model.score(rows, counts)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grads = model.gradients(model.forward(rows, counts), y)
    for name, g in grads.items():
        at = tuple(draw.integers(0, n) for n in g.shape)
        kept, step = model.weights[name][at], 1e-5
        model.weights[name][at] = kept + step
        up = loss()
        model.weights[name][at] = kept - step
        down = loss()
        model.weights[name][at] = kept
        assert g[at] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_passages_cover_the_whole_text():
    texts = [b"", b"one", ("w " * 1000).encode(), "É" .encode() * 3]
    rows, counts = mil.passages(texts)
    assert counts.tolist() == [1, 1, 21, 1] and rows.shape == (24, mil.FEATURES)
    assert rows[:, 14].sum() * mil.PASSAGE_WORDS == pytest.approx(1 + 1000 + 1)


@pytest.mark.parametrize("rows, want", [([], 0.5), ([(1, 1, 0), (1, 0, 0), (2, 1, 1)], 1.0), ([(1, None, None)], 0.5)])
def test_quality_without_two_kinds_of_labels(spark, rows, want):
    docs = documents(spark, awkward(n=5))
    model = mil.train(docs, spark.createDataFrame(rows, LABELS), F.lit(False))
    assert {r.score for r in mil.classify(docs, model).collect()} == {want}
    assert mil.classify(spark.createDataFrame([], SCHEMA), model).collect() == []


def disguise(rnd, word):
    kind = rnd.randrange(4)
    if kind == 0:
        return word.translate(str.maketrans("oiesat", "01354" + "7"))
    if kind == 1:
        return rnd.choice(".-_*").join(word)
    if kind == 2:
        return " ".join(word)
    return "".join(c * rnd.choice((1, 3)) for c in word) + word[-1]


def test_toxicity_behind_disguises(spark):
    rnd = random.Random(4)
    bad = ["moron", "idiotic", "stupid", "worthless", "disgusting"]
    rows, labels = [], {}
    for i in range(900):
        text = sentence(rnd, rnd.randint(5, 80)).split()
        labels[i] = int(i % 3 == 0)
        if labels[i]:
            word = rnd.choice(bad)
            text.insert(rnd.randrange(len(text) + 1), disguise(rnd, word) if i % 2 else word)
        rows.append((i, " ".join(text), "aa", "s"))
    docs = documents(spark, rows + [(9000 + i, t, a, b) for i, (_, t, a, b) in enumerate(awkward())])
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    frame = spark.createDataFrame([(d, 0, y) for d, y in labels.items()], LABELS)
    model = toxicity.train(docs, frame, held_out, Scratch(spark, "t"))
    assert set(bad) <= set(model.lexicon)
    found = toxicity.classify(docs, model).withColumn("held_out", held_out)
    assert accuracy(found, labels) > 0.95
    assert found.where("score is null or score < 0 or score > 1").isEmpty()
    # Plain text of any length is left alone.
    assert found.where("doc_id >= 9000 and predicted = 1").isEmpty()


def test_decoder_restores_words(spark):
    rnd = random.Random(6)
    text = " ".join(["stupid idiot moron loser scum trash letter"] * 50) + " " + sentence(rnd, 500)
    docs = documents(spark, [(1, text, "aa", "s")])
    decoder = toxicity.Decoder(toxicity.character_model(docs))
    hidden = {
        "1d10t": "idiot", "$tup1d": "stupid", "m0r0n!!": "moron", "s.c.u.m": "scum", "lllooooser": "loser",
        "tr@sh": "trash", "letter": "letter", "idiot,": "idiot",
    }
    assert {h: decoder.restore(h) for h in hidden} == hidden
    assert toxicity.spaced_words(b"you i d i o t now a b") == [b"idiot"]


def test_trigrams_of_words():
    counts = toxicity.trigram_counts("ab, é b1c".encode(), toxicity._symbol_codes()).reshape([toxicity.SIZE] * 3)
    a, b, other = 1, 2, toxicity.SIZE - 1
    want = {(0, 0, a): 1, (0, a, b): 1, (a, b, 0): 1, (0, 0, other): 1, (0, other, 0): 1, (0, 0, b): 1}
    assert {tuple(map(int, k)): int(counts[tuple(k)]) for k in np.argwhere(counts)} == want


def test_toxicity_without_labels(spark):
    docs = documents(spark, awkward(n=5))
    empty = spark.createDataFrame([], LABELS)
    model = toxicity.train(docs, empty, F.lit(False), Scratch(spark, "t"))
    assert {r.score for r in toxicity.classify(docs, model).collect()} == {0.0}
    assert toxicity.classify(spark.createDataFrame([], SCHEMA), model).collect() == []
    nothing = toxicity.train(spark.createDataFrame([], SCHEMA), empty, F.lit(False), Scratch(spark, "t"))
    assert nothing.lexicon == {}


def test_spaced_words_beside_others_and_signs_at_edges(spark):
    rnd = random.Random(6)
    text = " ".join(["you are a stupid idiot i am a moron so fat he is a man letter"] * 50) + " " + sentence(rnd, 500)
    prices = toxicity.character_model(documents(spark, [(1, text, "aa", "s")]))
    model = toxicity.ToxicityModel(prices, {"stupid": 0.9, "idiot": 0.9, "moron": 0.9, "fat": 0.9}, 0.0)
    hidden = [
        "you are a s t u p i d man", "what a m o r o n", "i a m a s t u p i d man", "so f a t", "he is stu pid",
        "stu p1d", "!diot", "|diot", "(!diot)", "1 d 1 o t", "you are a s t u p i d", "mor on",
    ]
    plain = ["he is a man", "a letter", "so i am", "fatal!", "a b c d", "you! are a (man)", "i", "!", "", "st upon"]
    scores = model.score([t.encode() for t in hidden + plain])
    assert [t for t, s in zip(hidden, scores) if s < 0.9] == []
    assert [t for t, s in zip(plain, scores[len(hidden) :]) if s] == []
    ending = toxicity.ToxicityModel(prices, {"ali": 0.9}, 0.0)
    assert ending.score([b"al!", b"al"]).tolist() == pytest.approx([0.9, 0])


def readings(token, prices):
    """Every reading of a token of the lattice with its price, one character after the other."""
    token = token.strip(toxicity._EDGES) or token
    dropped = 0.0 if max(map(len, token.split(" "))) == 1 else toxicity.DROPPED_BLANK
    found = [(0.0, "", 0, 0)]
    for i, c in enumerate(token):
        repeat = i > 0 and token[i - 1] == c
        after = []
        for price, text, before, last in found:
            if c == " ":
                after.append((price + dropped, text, before, last))
                after.append((price + prices[before][last][0], text + " " if last else text, 0, 0))
                continue
            options = [(x, toxicity.AS_LOOKALIKE) for x in toxicity.LOOKALIKES.get(c, "")]
            if c.isalpha():
                options.append((c, toxicity.KEPT_DOUBLE if repeat else 0.0))
            for letter, cost in options:
                s = toxicity.symbol(letter)
                after.append((price + cost + prices[before][last][s], text + letter, last, s))
            if not c.isalpha():
                after.append((price + toxicity.AS_NOTHING, text, before, last))
            elif repeat:
                after.append((price + toxicity.AS_REPEAT, text, before, last))
        found = after
    return min((price + prices[before][last][0], text.strip()) for price, text, before, last in found)


def test_search_finds_the_cheapest_of_all_readings():
    rnd, draw = random.Random(8), np.random.default_rng(8)
    prices = draw.gamma(2.0, 1.5, (toxicity.SIZE,) * 3)
    decoder, tried = toxicity.Decoder(prices), 0
    for _ in range(400):
        alphabet = rnd.choice(["ab1@", "aab0$!", "a b 1", "x|l1 ", "eé3-", "ss5 "])
        token = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 7))).strip()
        if token and "  " not in token and toxicity._CHOICE.search(token.strip(toxicity._EDGES) or token):
            assert decoder.restore(token) == readings(token, prices)[1]
            tried += 1
    assert tried > 200


def test_bag_score_by_loops():
    draw = np.random.default_rng(5)
    bags = [draw.normal(size=(n, mil.FEATURES)) for n in (1, 2, 6, 4)]
    model = mil.fit(bags, np.array([1.0, 0.0, 1.0, 0.0]))
    p = model.weights

    def one(bag):
        hidden, weights = [], []
        for row in bag:
            x = [(v - m) / s for v, m, s in zip(row, model.mean, model.scale)]
            h = [np.tanh(sum(x[i] * p["W"][i][k] for i in range(len(x))) + p["d"][k]) for k in range(mil.HIDDEN)]
            tall = [np.tanh(sum(h[k] * p["V"][k][g] for k in range(mil.HIDDEN))) for g in range(mil.GATE)]
            gate = [1 / (1 + np.exp(-sum(h[k] * p["U"][k][g] for k in range(mil.HIDDEN)))) for g in range(mil.GATE)]
            hidden.append(h)
            weights.append(np.exp(sum(t * u * w for t, u, w in zip(tall, gate, p["w"]))))
        mixed = [sum(a * h[k] for a, h in zip(weights, hidden)) / sum(weights) for k in range(mil.HIDDEN)]
        return 1 / (1 + np.exp(-(sum(z * c for z, c in zip(mixed, p["c"])) + p["b"][0])))

    got = model.score(np.concatenate(bags), np.array([len(b) for b in bags]))
    assert got == pytest.approx([one(b) for b in bags], abs=1e-12)


def test_sample_of_the_quality_model_is_bounded(spark, monkeypatch):
    """One labelled id on most rows gives one bag, the same however the rows are dealt out."""
    rows = [(1, f"row {i} " + "of the one id " * (i % 9 * 400), "aa", "s") for i in range(300)]
    rows += [(2, "other text", "aa", "s"), (3, "third text", "aa", "s")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0)], LABELS)
    fitted = []
    fit = mil.fit
    monkeypatch.setattr(mil, "fit", lambda bags, y, *a: fitted.append((bags, list(y))) or fit(bags, y, *a))
    for n in (1, 7):
        mil.train(documents(spark, rows).repartition(n), labels, F.lit(False), most=2)
    (first, y), (second, again) = fitted
    assert len(first) == 2 and y == again
    assert all(np.array_equal(a, b) for a, b in zip(first, second))
