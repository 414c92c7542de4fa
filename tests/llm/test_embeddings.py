"""Whitening and neighbour search against plain numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import multi_index, whitening
from rosterlake.llm.common import Scratch

SCHEMA = "vec_id bigint, embedding array<float>, label int, cell string, vector string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", "v", "n") for i, v in rows], SCHEMA)


def spread(n, d, seed=1):
    rnd = np.random.default_rng(seed)
    mixing = rnd.normal(size=(d, d)) * np.logspace(0, -2, d)
    return (rnd.normal(size=(n, d)) @ mixing.T).astype(np.float32).astype(float)


UNUSABLE = [(900, None), (901, [1.0, None, 2.0]), (902, [math.nan, 1.0, 1.0]), (903, [math.inf, 0.0, 1.0]), (904, [])]


def plain_whitening(vectors, most=8):
    x = np.floor(1024 * vectors).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:most]
    deviation = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    return centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(covariance), deviation


@pytest.mark.parametrize("d", [3, 12])
def test_whitening_equals_numpy(spark, d):
    vectors = spread(300, d)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(950, [1.0] * (d + 1))] + (UNUSABLE if d == 3 else UNUSABLE[:1])
    found = whitening.components(frame(spark, rows + odd), Scratch(spark, "w")).toPandas()
    found = found.sort_values(["vec_id", "component"])
    most = min(d, 8)
    assert len(found) == 300 * most and set(found.n) == {300}
    got = found.whitened.to_numpy().reshape(-1, most)
    want, explained, deviation = plain_whitening(vectors)
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got * sign - want).max() < 1e-9
    assert np.abs(found.explained.to_numpy()[:most] / explained - 1).max() < 1e-9
    assert found.deviation.to_list()[::most] == list(deviation)
    assert found.identity_error.nunique() == 1 and found.identity_error.iloc[0] < 1e-9


def test_whitening_of_repeated_and_constant_vectors(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 4.0])]
    found = whitening.components(frame(spark, rows), Scratch(spark, "w")).collect()
    assert [(r.vec_id, r.component, r.n) for r in sorted(found, key=str)].count((1, 1, 3)) == 2
    assert len(found) == 3 and all(abs(r.explained - 1) < 1e-12 for r in found)
    constant = frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert whitening.components(constant, Scratch(spark, "w")).collect() == []
    assert whitening.components(frame(spark, []), Scratch(spark, "w")).collect() == []


def test_jacobi_on_ranks():
    rnd = np.random.default_rng(2)
    for d, rank in ((1, 1), (6, 3), (9, 9)):
        half = rnd.normal(size=(d, rank))
        a = half @ half.T
        factor = whitening.pivoted_cholesky(a)
        assert np.abs(factor @ factor.T - a).max() < 1e-12 and factor.shape[1] == rank
        values, vectors = whitening.one_sided_jacobi(factor)
        assert np.abs(vectors.T @ vectors - np.eye(rank)).max() < 1e-12
        assert np.abs(a @ vectors - vectors * values).max() < 1e-11
        assert (np.diff(values) <= 0).all()


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**20 * i), float(3 * i % 7)]) for i in range(50)]
    model = whitening.fit(whitening.finite_vectors(frame(spark, rows)))
    x = [[math.floor(1024 * v) + 100_000 for v in vector] for _, vector in rows]
    assert model.sums == tuple(map(sum, zip(*x)))
    variance = sum(50 * (50 * row[0] - model.sums[0]) ** 2 for row in x) / 50**4
    assert abs(model.trace / variance - 1) < 1e-9


def plain_neighbours(rows, step, top=5):
    best = {}
    for i, v in rows:
        usable = v and all(c is not None and math.isfinite(c) for c in v) and any(v)
        if i is not None and usable and len(v) == len(rows[0][1]):
            best[i] = min(best.get(i, v), v)
    result = {}
    for q in best:
        if q % step == 0:
            scored = []
            for i, v in best.items():
                if i != q:
                    a, b = np.array(best[q]), np.array(v)
                    scored.append((-round(float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)), 12), i))
            result[q] = [(i, -s) for s, i in sorted(scored)[:top]]
    return result


def search(spark, rows, step, monkeypatch=None, target=1.0):
    index = multi_index.MultiIndex(
        multi_index.usable_vectors(frame(spark, rows)), Scratch(spark, "m"), target=target
    )
    found = {}
    for r in index.search(F.col("vec_id") % step == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
    return found, index


@pytest.mark.parametrize("d", [1, 2, 3, 8])
def test_everything_taken_equals_brute_force(spark, monkeypatch, d):
    monkeypatch.setattr(multi_index, "REGION_BYTES", 16 * 8 * d)
    monkeypatch.setattr(multi_index, "PER_CELL", 10)
    monkeypatch.setattr(multi_index, "LANE", 3)
    monkeypatch.setattr(multi_index, "HELD", 4)
    monkeypatch.setattr(multi_index, "needed_share", lambda *a: 1.0)
    vectors = spread(240, d, 4)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(300 + i, rows[7][1]) for i in range(80)]  # equal vectors: ties go to smaller ids
    rows += [(8, rows[8][1]), (9, [9.0] * d), (None, [1.0] * d), (600, [0.0] * d), (601, [1.0] * (d + 1)), *UNUSABLE[:1]]
    found, _ = search(spark, rows, 7)
    want = plain_neighbours(rows, 7)
    assert set(found) == set(want)
    for q in want:
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in want[q]], abs=1e-9)
        assert found[q][0][0] == want[q][0][0] or d < 3  # many vectors of few dimensions point the same way
        assert [i for i, s in found[q]] == [i for i, s in want[q]] or d < 3


def test_recall_of_a_part(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "REGION_BYTES", 64 * 8 * 16)
    vectors = spread(4000, 16, 5)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found, index = search(spark, rows, 20, target=multi_index.TARGET)
    assert index.share < 0.9
    want = plain_neighbours(rows, 20)
    hits = [len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 5 for q in want]
    assert np.mean(hits) >= 0.9
    assert all(len(v) == 5 for v in found.values())


def test_few_and_no_vectors(spark):
    found, _ = search(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], 2)
    assert {q: [i for i, _ in v] for q, v in found.items()} == {0: [1, 2], 2: [1, 0]}
    assert search(spark, [], 2)[0] == {}
    assert search(spark, [(0, [0.0])], 2)[0] == {}
    assert search(spark, [(0, [1.0])], 2)[0] == {}


def test_pairs_come_by_distance():
    rnd = np.random.default_rng(6)
    one, two = rnd.random(7), rnd.random(5)
    sums = [one[i] + two[j] for i, j in multi_index.pairs_by_distance(one, two)]
    assert len(sums) == 35 and sums == sorted(sums)
