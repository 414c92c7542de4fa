import math
import random
from collections import Counter

import numpy as np
import pytest

from rosterlake.llm import divergence
from rosterlake.llm.common import Scratch
from tests.llm.corpus import SCHEMA, awkward, documents, sentence, words

LETTER_KINDS = [
    lambda c: c in "aeiou", lambda c: "a" <= c <= "z", lambda c: "A" <= c <= "Z", lambda c: c in "0123456789",
    lambda c: c in ".,;:!?'\"", lambda c: c in "#*$%&|<>", lambda c: "!" <= c <= "~", lambda c: ord(c) > 127,
]


def histogram(text):
    counts = Counter()
    for c in "".join(words(text)):
        counts[next((i for i, test in enumerate(LETTER_KINDS) if test(c)), None)] += 1
    return np.array([counts[i] for i in range(len(LETTER_KINDS))], float)


def distance(p, q):
    m = (p + q) / 2
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
    return math.sqrt(max(0, (kl(p) + kl(q)) / 2))


def base(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def corpus(seed=5):
    rnd = random.Random(seed)
    rows = [(i, sentence(rnd, rnd.randint(60, 200)), "aa", "s") for i in range(60)]
    rows += [(1000 + i, sentence(rnd, 120).upper().replace(" ", "!! "), "aa", "s") for i in range(5)]
    rows += [(2000 + i, " ".join(w + "###" for w in sentence(rnd, 120).split()), None, "s") for i in range(5)]
    rows += [(3000, "la la la\nla la la\n" * 40, "bb", "s"), (3001, "x\n\nx\n \n x\nx", "bb", "s")]
    return rows + [(d if d is None else 5000 + d, *rest) for d, *rest in awkward()]


def test_base_figures_and_distances(spark):
    rows = corpus()
    docs = documents(spark, rows)
    learned = divergence.references(docs, Scratch(spark, "t"))
    assert learned.languages == ("aa", "bb")
    shares = []
    for language in learned.languages:
        total = sum(histogram(t) for _, t, lang, _ in rows if lang == language)
        shares.append(total / total.sum())
    np.testing.assert_allclose(learned.chars, shares)
    counts = Counter(w.lower() for _, t, lang, _ in rows if lang == "aa" for w in words(t))
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[: divergence.COMMON_WORDS]
    assert [w.decode() for w in learned.words[0]] == [w for w, _ in top]
    found = divergence.judge(docs, learned).collect()
    assert len(found) == len(rows)
    texts = {d: t for d, t, *_ in rows}
    for r in found:
        if r.doc_id is None:
            continue
        *figures, failed = base(texts[r.doc_id])
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == figures
        assert r.base_failed == failed and not (failed and r.kept)
        if r.n_words:
            p = histogram(texts[r.doc_id])
            i = learned.languages.index(r.language)
            assert r.char_distance == pytest.approx(distance(p / p.sum(), shares[i]))
    kept = {r.doc_id: r.kept for r in found}
    assert not any(kept[i] for r in ((1000, 1005), (2000, 2005)) for i in range(*r))
    assert sum(kept[i] for i in range(60)) >= 58


def test_without_language_or_rows(spark):
    rows = [(1, "w " * 10 + "x y z " * 3, None, None), (2, None, None, None)]
    docs = documents(spark, rows)
    learned = divergence.references(docs, Scratch(spark, "t"))
    assert learned.languages == ()
    assert {(r.kept, r.language) for r in divergence.judge(docs, learned).collect()} == {(False, None)}
    assert divergence.judge(spark.createDataFrame([], SCHEMA), learned).collect() == []


def test_result_columns_replace_their_namesakes(spark):
    docs = documents(spark, corpus())
    judged = divergence.judge(docs, divergence.references(docs, Scratch(spark, "t")))
    assert judged.columns.count("kept") == 1 and dict(judged.dtypes)["kept"] == "boolean"
    assert judged.where("size <> 'mine'").isEmpty()


def test_texts_without_common_words_are_rejected(spark):
    rnd = random.Random(7)
    common = "the of and to in a is that for it was on with as be by at this from or".split()
    name = lambda letters: "".join(rnd.choices(letters, k=rnd.randint(3, 8)))
    stock = [name("eeaoinstrhldcum") for _ in range(3000)]
    rows = [
        (i, " ".join(rnd.choice(common) if rnd.random() < 0.33 else rnd.choice(stock) for _ in range(150)), "en", "s")
        for i in range(150)
    ]
    rows += [(1000 + i, " ".join(name("eeaoinstrhldcum") for _ in range(150)), None, "s") for i in range(5)]
    finnish = "tämä on vain yksi pitkä teksti jossa ei ole mitään yhteistä muiden kielten kanssa vaikka se onkin oikea"
    rows.append((2000, " ".join(rnd.choices(finnish.split(), k=120)), None, "s"))
    # No words are common to the documents of this language, so none can be missed.
    rows += [(3000 + i, " ".join(name("ωαβγδεζηθικλμ") for _ in range(100)), "xx", "s") for i in range(20)]
    docs = documents(spark, rows)
    learned = divergence.references(docs, Scratch(spark, "t"))
    kept = {r.doc_id: r.kept for r in divergence.judge(docs, learned).collect()}
    assert {i for i in kept if kept[i]} == {*range(150), *range(3000, 3020)}


def test_more_languages_than_are_compared_at_once(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(i, sentence(rnd, 120) + f" only{i % 7}" * 60, f"l{i % 7}", "s") for i in range(28)]
    docs = documents(spark, rows)
    judged = lambda: {
        (r.doc_id, r.language, r.word_distance)
        for r in divergence.judge(docs, divergence.references(docs, Scratch(spark, "t"))).collect()
    }
    once = judged()
    assert {(i, f"l{i % 7}") for i in range(28)} == {x[:2] for x in once}
    monkeypatch.setattr(divergence, "LANGUAGES", 2)
    assert judged() == once
