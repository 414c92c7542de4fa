"""Whitening of embeddings: pivoted Cholesky, then one-sided Jacobi on the factor.

Entries become whole numbers on a fixed grid, so counts, sums and products of what tasks
have seen add up without any rounding, in whatever order tasks end: ``n`` times the
scatter around the mean is exact before the first rounding step. Products are taken of
entries from which the rounded mean has been taken off, so nothing cancels.

The scatter is factored by Cholesky with the largest remaining diagonal as pivot. Jacobi
rotations then turn the columns of the triangular factor until all are at right angles;
squared column norms are eigenvalues and normalised columns are components. Small
eigenvalues keep their digits, as the scatter is never multiplied out again.

What reaches the driver is one row per pair of dimensions, whatever the number of rows.

Cases: vectors that are null or hold null or non-finite entries are left out; where
lengths differ, the length that most vectors have counts (of equals the longer) and
others are left out; repeated ids and null ids are rows like others; directions without
any variance have no component; an empty table, or vectors that are all the same, give
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import Scratch

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
ROWS = 4096  # vectors that are worked on at once
SWEEPS = 60
EXACT = 1 << 53


def grid(entries: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * entries.astype(np.float64)).astype(np.int64) + OFFSET


def finite_vectors(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, vector)`` with double entries, without rows that hold no usable vector."""
    entries = F.col(vector).cast("array<double>")
    usable = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return embeddings.where(usable & (F.size(vector) > 0)).select(
        F.col(key).cast("long").alias("vec_id"), entries.alias("vector")
    )


def matrices(batches: Iterator[pa.RecordBatch], dim: int | None = None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """``(ids, entries)`` of vectors of equal length, a bounded number at a time."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            ids, vectors = batch.column(0), batch.column(1)
            lengths = pc.list_value_length(vectors)
            for d in [dim] if dim else pc.unique(lengths).to_pylist():
                same = pc.equal(lengths, d)
                entries = pc.list_flatten(vectors.filter(same)).to_numpy(zero_copy_only=False)
                if len(entries):
                    yield ids.filter(same), entries.reshape(-1, d)


def _decimals(numbers) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in numbers], pa.decimal128(38, 0))


def dimension_sums(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """Dimension, number of vectors that have it, and the sum of every entry on the grid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for _, entries in matrices(batches):
            x = grid(entries)
            d = x.shape[1]
            n, sums = held.get(d, (0, np.zeros(d, object)))
            held[d] = (n + len(x), sums + x.sum(axis=0).astype(object))
        for d, (n, sums) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int64()), pa.array(range(d), pa.int64()), pa.array([n] * d, pa.int64()), _decimals(sums)],
                ["d", "i", "n", "s"],
            )

    parts = vectors.mapInArrow(run, "d bigint, i bigint, n bigint, s decimal(38,0)")
    sums = parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))
    most = sums.where("i = 0").agg(F.max(F.struct("n", "d")).alias("m")).first().m
    if most is None:
        return 0, 0, []
    rows = sums.where(F.col("d") == most.d).orderBy("i").collect()
    return most.d, most.n, [int(r.s) for r in rows]


def exact_scatter(vectors: DataFrame, n: int, sums: list[int]) -> list[list[int]]:
    """``n`` times the scatter around the mean, in whole numbers."""
    d = len(sums)
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)  # the rounded mean
    upper = np.triu_indices(d)

    def products(y: np.ndarray) -> np.ndarray:
        if len(y) * int(np.abs(y).max(initial=0)) ** 2 < EXACT:
            z = y.astype(np.float64)
            return (z.T @ z).astype(np.int64).astype(object)
        y = y.astype(object)
        return y.T @ y

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((d, d), object)
        rest = np.zeros(d, object)
        for _, entries in matrices(batches, d):
            y = grid(entries) - middle
            held = held + products(y)
            rest = rest + y.sum(axis=0).astype(object)
        rows, columns = np.append(upper[0], np.full(d, -1)), np.append(upper[1], np.arange(d))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(columns, pa.int64()), _decimals([*held[upper], *rest])],
            ["i", "j", "s"],
        )

    parts = vectors.mapInArrow(run, "i bigint, j bigint, s decimal(38,0)")
    total = parts.groupBy("i", "j").agg(F.sum("s").cast("decimal(38,0)").alias("s"))
    scatter, rest = [[0] * d for _ in range(d)], [0] * d
    for i, j, s in total.collect():
        if i < 0:
            rest[j] = int(s)
        else:
            scatter[i][j] = scatter[j][i] = int(s)
    return [[n * scatter[i][j] - rest[i] * rest[j] for j in range(d)] for i in range(d)]


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``G`` with ``G @ G.T`` equal to the matrix: a triangular factor, its rows put back
    where the pivots came from, with as many columns as the rank."""
    a = matrix.astype(np.float64).copy()
    d = len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    least = d * np.finfo(float).eps * max(np.diag(a).max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(np.diag(a)[k:]))
        if a[p, p] <= least:
            break
        for m in (a, factor):
            m[[k, p]] = m[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    else:
        k = d
    back = np.empty_like(factor)
    back[order] = factor
    return back[:, :k]


def rounds(m: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``m`` columns in rounds of disjoint pairs, as in a tournament."""
    players = list(range(m + m % 2))
    half, found = len(players) // 2, []
    for _ in range(len(players) - 1):
        pairs = [(a, b) for a, b in zip(players[:half], players[half:][::-1]) if a < m and b < m]
        found.append(tuple(np.array(side, int) for side in zip(*pairs)) if pairs else (np.empty(0, int),) * 2)
        players = [players[0], players[-1], *players[1:-1]]
    return found


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of ``factor @ factor.T``."""
    g = factor.copy()
    schedule = rounds(g.shape[1]) if g.shape[1] > 1 else []
    tiny = 4 * np.finfo(float).eps
    for _ in range(SWEEPS):
        turned = False
        for p, q in schedule:
            x, y = g[:, p], g[:, q]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(c) > tiny * np.sqrt(a * b)
            if not turn.any():
                continue
            turned = True
            zeta = np.divide(b - a, 2 * c, out=np.zeros_like(a), where=turn)
            side = np.where(zeta >= 0, 1.0, -1.0)
            t = np.where(turn, side / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            g[:, p], g[:, q] = cos * (x - t * y), cos * (y + t * x)
        if not turned:
            break
    values = (g * g).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], g[:, order] / np.sqrt(values[order])


@dataclass(frozen=True)
class Whitening:
    """What a fit has learned: the mean as ``sums / n``, components and eigenvalues."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray  # a column each
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def deviations(self, entries: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact."""
        x = grid(entries)
        bound = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        kind = np.int64 if bound < 1 << 62 else object
        return self.n * x.astype(kind) - np.array(self.sums, kind)


def fit(vectors: DataFrame) -> Whitening | None:
    """Learn from all vectors; nothing where there is no variance."""
    d, n, sums = dimension_sums(vectors)
    if not n:
        return None
    whole = exact_scatter(vectors, n, sums)
    covariance = np.array([[v / (n * n) for v in row] for row in whole])
    values, components = one_sided_jacobi(pivoted_cholesky(covariance))
    trace = sum(whole[i][i] for i in range(d)) / (n * n)
    return Whitening(n, tuple(sums), values, components, trace) if len(values) else None


WHITENED = "vec_id bigint, deviation decimal(38,0), whitened array<double>"


def whiten(vectors: DataFrame, model: Whitening, most: int = COMPONENTS) -> DataFrame:
    """``(vec_id, deviation, whitened)``: the exact squared distance from the mean times
    ``n * n``, and up to ``most`` coordinates of variance 1."""
    scaled = model.components[:, :most] / np.sqrt(model.values[:most])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, entries in matrices(batches, model.dim):
            off = model.deviations(entries)
            largest = int(np.abs(off).max(initial=0))
            squares = off if largest**2 * model.dim < 1 << 63 else off.astype(object)
            w = (off.astype(np.float64) / model.n) @ scaled
            yield pa.RecordBatch.from_arrays(
                [
                    ids.cast(pa.int64()),
                    _decimals((squares * squares).sum(axis=1)),
                    pa.ListArray.from_arrays(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32), w.ravel()),
                ],
                ["vec_id", "deviation", "whitened"],
            )

    return vectors.mapInArrow(run, WHITENED)


def identity_error(whitened: DataFrame, most: int) -> float:
    """Largest entry of the covariance of what was written, less the identity."""
    columns = [F.col("whitened")[i] for i in range(most)]
    means = whitened.agg(*[F.avg(c) for c in columns]).first()
    centred = [c - F.lit(m) for c, m in zip(columns, means)]
    pairs = [(i, j) for i in range(most) for j in range(i, most)]
    found = whitened.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, found))


def components(embeddings: DataFrame, scratch: Scratch, most: int = COMPONENTS) -> DataFrame:
    """One row per vector and component, with how well the whitening of all rows holds."""
    vectors = finite_vectors(embeddings)
    model = fit(vectors)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], RESULT)
    most = min(most, len(model.values))
    written = scratch.save(whiten(vectors, model, most), "whitened")
    error = identity_error(written, most)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values[:most]])
    return written.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)
