from fractions import Fraction

import pytest

from rosterlake.llm import mixing
from rosterlake.llm.common import Scratch
from tests.llm.corpus import SCHEMA, awkward, documents, words


def water(sizes: dict) -> dict:
    """Targets by resharing the excess until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        share = Fraction(total - sum(capped.values()), sum(weight[s] for s in rest) or 1)
        over = [s for s in rest if share * weight[s] > 3 * sizes[s]]
        if not over:
            return {s: capped.get(s, share * weight[s]) for s in names}
        capped |= {s: 3 * sizes[s] for s in over}


def test_targets_and_taken_words(spark):
    rows = awkward()
    found = mixing.systematic_copies(documents(spark, rows), Scratch(spark, "t")).collect()
    assert len(found) == len(rows)
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(map(str, (r[0] for r in rows)))
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = water(sizes)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(want[r.source]))
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    again = mixing.systematic_copies(documents(spark, rows[::-1]), Scratch(spark, "t")).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_taken_words_come_near_the_target(spark):
    rows = [(i, "w " * (1 + i * 7919 % 300), "aa", f"s{i % 10 // 7}") for i in range(4000)]
    found = mixing.systematic_copies(documents(spark, rows), Scratch(spark, "t"))
    for r in found.groupBy("source", "target").sum("taken").collect():
        assert r["sum(taken)"] == pytest.approx(r.target, rel=0.01)


def test_mixture_repeats_whole_rows(spark):
    docs = documents(spark, awkward())
    counted = mixing.systematic_copies(docs, Scratch(spark, "t"))
    taken = mixing.mixed(docs, Scratch(spark, "t"))
    assert taken.columns == docs.columns and taken.count() == counted.agg({"copies": "sum"}).first()[0]
    assert taken.where("size <> 'mine' or kept <> 7 or score <> 'own'").isEmpty()


def test_empty_and_wordless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.systematic_copies(empty, Scratch(spark, "t")).collect() == []
    blank = documents(spark, [(1, None, None, None), (2, " ", None, "s")])
    assert {(r.size, r.target, r.taken) for r in mixing.systematic_copies(blank, Scratch(spark, "t")).collect()} == {(0, 0.0, 0)}


def test_no_python_in_the_plan(spark):
    plan = mixing.mixed(documents(spark, awkward()), Scratch(spark, "t"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
