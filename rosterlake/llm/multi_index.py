"""Nearest neighbours by cosine with an inverted multi-index.

Vectors are cut in two halves, each quantised by its own ``k`` centroids, so ``k * k``
cells come from two small codebooks. A query sorts the centroids of each half by distance
and takes pairs of them by summed distance from a heap, until the cells it has taken hold
a share of all vectors; everything in them is compared on the original vectors.

The codebooks are learned from a sample of at most about ``SAMPLE_BYTES``; every vector is
indexed. ``k`` follows the number of vectors, so that a cell holds some ``PER_CELL`` of
them at any size, up to ``MOST_CENTROIDS``. The share is what the sample asks for: queries
of the sample are answered by brute force, and the share is taken at which ``TARGET`` of
their true neighbours are in cells taken. Larger tables have nearer neighbours, so the
recall grows from there.

Work is dealt in blocks. Neighbouring cells form regions of about ``region`` vectors; a
crowded cell is cut into several. The queries of a region are a block that travels once
to every region that one of them asks for, with the cells asked for; a task holds one
region, and of each query the best found so far. No row stands for a single pair. A
region meets at most ``LANE`` blocks in one task.

Cases: vectors that are null, zero, empty or hold null or non-finite entries, and rows
without an id, take no part; of rows that share an id the smallest vector counts; where
lengths differ, the length that most vectors have counts (of equals the longer); equal
scores go to the smaller id; with fewer candidates than asked for, all are returned; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import Scratch
from rosterlake.llm.whitening import finite_vectors, matrices

SAMPLE_BYTES = 16 << 20
PER_CELL = 50
MOST_CENTROIDS = 1024
ROUNDS = 10
TRIALS = 256
TARGET = 0.96
REGION_BYTES = 1 << 20
LANE = 1024
HELD = 20_000  # queries whose best neighbours a task keeps before it hands them out
SLACK = 1e-9
SEED = 20240315


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances to the centroids, less the points' own norms."""
    return (centroids**2).sum(axis=1) - 2 * points @ centroids.T


def codebook(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` centroids by Lloyd's rounds from different points of the sample."""
    different = np.unique(points, axis=0)
    draw = np.random.default_rng(seed)
    centroids = different[draw.permutation(len(different))[:k]].copy()
    for _ in range(ROUNDS):
        own = nearest(points, centroids).argmin(axis=1)
        members = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        some = members > 0
        centroids[some] = sums[some] / members[some, None]
    return centroids


def unit(entries: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small entries stay finite.
    scaled = entries / np.abs(entries).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def pairs_by_distance(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of centroids by the sum of their distances, from a heap."""
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[one].tolist(), second[two].tolist()
    heap = [(a[0] + b[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(one[i]), int(two[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))


@dataclass(frozen=True)
class Codebooks:
    first: np.ndarray
    second: np.ndarray

    def halves(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return nearest(units[:, :cut], self.first), nearest(units[:, cut:], self.second)

    def cells(self, units: np.ndarray) -> np.ndarray:
        one, two = self.halves(units)
        return one.argmin(axis=1) * len(self.second) + two.argmin(axis=1)

    @property
    def size(self) -> int:
        return len(self.first) * len(self.second)

    def taken(self, first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: float) -> list[int]:
        """Cells with members that a query takes until they hold ``enough`` vectors."""
        cells, members = [], 0
        for i, j in pairs_by_distance(first, second):
            cell = i * len(self.second) + j
            if counts[cell]:
                cells.append(cell)
                members += counts[cell]
                if members >= enough:
                    break
        return cells


def learn(sample: np.ndarray, k: int) -> Codebooks:
    cut = max(1, sample.shape[1] // 2)
    return Codebooks(codebook(sample[:, :cut], k, SEED), codebook(sample[:, cut:], k, SEED + 1))


def needed_share(books: Codebooks, sample: np.ndarray, top: int, target: float = TARGET) -> float:
    """Share of the sample that queries must take to find ``target`` of their neighbours."""
    if len(sample) <= top + 1:
        return 1.0
    cells = books.cells(sample)
    counts = np.bincount(cells, minlength=books.size)
    asked = np.random.default_rng(SEED).permutation(len(sample))[:TRIALS]
    scores = sample[asked] @ sample.T
    scores[np.arange(len(asked)), asked] = -2
    truth = np.argpartition(-scores, top - 1, axis=1)[:, :top]
    needed = []
    for row, one, two in zip(truth, *books.halves(sample[asked])):
        order = books.taken(one, two, counts, math.inf)
        seen = dict(zip(order, np.cumsum(counts[order])))
        needed += [seen[c] / len(sample) for c in cells[row]]
    return float(np.quantile(needed, target, method="higher"))


@dataclass(frozen=True)
class Regions:
    """Which regions a cell lies in: ``pieces[c]`` of them from ``start[c]`` on."""

    start: np.ndarray
    pieces: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, most: int) -> Regions:
        start, pieces = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
        at, held = 0, 0
        for cell, n in enumerate(counts.tolist()):
            if held and held + n > most:
                at, held = at + 1, 0
            start[cell] = at
            if n > most:
                pieces[cell] = -(-n // most)
                at += int(pieces[cell])
            else:
                held += n
        return Regions(start, pieces)

    def place(self, cells: np.ndarray, draw: np.ndarray) -> np.ndarray:
        return self.start[cells] + draw % self.pieces[cells]


def usable_vectors(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, vector)``, one row per id, without vectors that have no direction."""
    finite = finite_vectors(embeddings, key, vector)
    some = finite.where("vec_id IS NOT NULL").where(F.exists("vector", lambda c: c != 0))
    return some.groupBy("vec_id").agg(F.min("vector").alias("vector"))


class MultiIndex:
    """All vectors by cell and region, in the shared folder."""

    def __init__(self, vectors: DataFrame, scratch: Scratch, top: int = 5, target: float = TARGET):
        self.top, self.scratch = top, scratch
        stored = scratch.save(vectors, "vectors")
        lengths = stored.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
        most = lengths.agg(F.max(F.struct("n", "d")).alias("m")).first().m
        self.n, self.dim = (most.n, most.d) if most else (0, 0)
        if not self.n:
            return
        stored = stored.where(F.size("vector") == self.dim)
        sample = self._sample(stored)
        k = max(1, min(MOST_CENTROIDS, round(math.sqrt(self.n / PER_CELL)), len(sample) // 4))
        self.books = learn(sample, k)
        self.share = needed_share(self.books, sample, top, target)
        encoded = scratch.save(self._encoded(stored), "encoded")
        self.counts = np.zeros(self.books.size, np.int64)
        for cell, n in encoded.groupBy("cell").count().collect():  # at most a row per cell
            self.counts[cell] = n
        self.region_rows = max(16, REGION_BYTES // (8 * self.dim))
        self.regions = Regions.of(self.counts, self.region_rows)
        self.encoded = encoded

    def _sample(self, vectors: DataFrame) -> np.ndarray:
        """Unit vectors of ids whose hash is below a bound; one row per id, so few repeats."""
        part = min(1.0, SAMPLE_BYTES / (8 * self.dim * self.n))
        hashed = F.xxhash64("vec_id", F.lit(SEED)).bitwiseAND(F.lit((1 << 62) - 1))
        rows = vectors.where(hashed <= int(part * ((1 << 62) - 1))).orderBy("vec_id").select("vector").collect()
        return unit(np.array([r.vector for r in rows] or [[1.0] * self.dim]))

    def _encoded(self, vectors: DataFrame) -> DataFrame:
        books, dim = self.books, self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, entries in matrices(batches, dim):
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(books.cells(unit(entries)).astype(np.int64)),
                        pa.array([row.tobytes() for row in entries.astype("<f8")], pa.binary()),
                    ],
                    ["vec_id", "cell", "vector"],
                )

        return vectors.mapInArrow(run, "vec_id bigint, cell bigint, vector binary")

    def _blocks(self, rows: DataFrame) -> DataFrame:
        """``(region, ids, cells, vectors)``: one row per region, its vectors one after the other."""
        regions = self.regions

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells, draw = (batch.column(i).to_numpy() for i in (1, 3))
                found = pa.array(regions.place(cells, draw))
                yield pa.RecordBatch.from_arrays(
                    [found, *batch.columns[:3]], ["region", "vec_id", "cell", "vector"]
                )

        draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)).alias("draw")
        placed = rows.select("vec_id", "cell", "vector", draw).mapInArrow(
            place, "region bigint, vec_id bigint, cell bigint, vector binary"
        )
        # About ``region_rows`` entries each, whatever the size of a cell.
        listed = placed.groupBy("region").agg(
            F.array_sort(F.collect_list(F.struct("vec_id", "cell", "vector"))).alias("m")
        )
        return listed.select("region", *[F.col(f"m.{a}").alias(b) for a, b in
                                         (("vec_id", "ids"), ("cell", "cells"), ("vector", "vectors"))])

    def _asked(self, blocks: DataFrame) -> DataFrame:
        """Blocks of queries, a row for every region that one of them asks for."""
        books, counts, regions, dim = self.books, self.counts, self.regions, self.dim
        enough = max(self.share * self.n, self.top) + 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, block, ids, _, entries in _regions(batches, dim):
                who, cells = [], []
                for at, (one, two) in enumerate(zip(*books.halves(unit(entries)))):
                    taken = books.taken(one, two, counts, enough)
                    who.append(np.full(len(taken), at, np.int64))
                    cells.append(np.array(taken, np.int64))
                who, cells = np.concatenate(who), np.concatenate(cells)
                pieces = regions.pieces[cells]
                at = np.repeat(np.arange(len(cells)), pieces)
                inside = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                asked = regions.start[cells[at]] + inside
                order = np.argsort(asked, kind="stable")
                cuts = np.flatnonzero(np.diff(asked[order], prepend=-1))
                body = [b.tobytes() for b in entries]
                for part in np.split(order, cuts[1:]):
                    some, local = np.unique(who[at[part]], return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([asked[part[0]]], pa.int64()),
                            pa.array([block], pa.int64()),
                            pa.array([ids[some].tolist()], pa.list_(pa.int64())),
                            pa.array([[body[s] for s in some]], pa.list_(pa.binary())),
                            pa.array([local.tolist()], pa.list_(pa.int64())),
                            pa.array([cells[at[part]].tolist()], pa.list_(pa.int64())),
                        ],
                        ["region", "block", "ids", "vectors", "who", "cells"],
                    )

        kinds = "region bigint, block bigint, ids array<bigint>, vectors array<binary>, who array<bigint>, cells array<bigint>"
        return blocks.select("region", F.col("region").alias("block"), "ids", "cells", "vectors").mapInArrow(run, kinds)

    def search(self, queries: Column) -> DataFrame:
        """``(query_id, rank, vec_id, score)`` of the rows that ``queries`` selects by ``vec_id``."""
        if not self.n:
            return self.scratch.spark.createDataFrame([], RESULT)
        spread = self.scratch.save(self._blocks(self.encoded), "regions")
        asking = self.scratch.save(self._asked(self._blocks(self.encoded.where(queries))), "asked")
        lanes = max(1, -(-int(self.regions.start.max() + 1) // LANE))
        none = F.lit(None)
        entries = spread.select(
            "region", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"),
            F.lit(-1).cast("long").alias("block"), "ids", "vectors", none.cast("array<bigint>").alias("who"), "cells",
        )
        lane = F.pmod(F.xxhash64("block"), F.lit(lanes)).alias("lane")
        both = entries.unionByName(asking.select("region", lane, "block", "ids", "vectors", "who", "cells"))
        dim, top = self.dim, self.top

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _best(_regions(batches, dim, who=5), top)

        met = both.select("region", "block", "ids", "cells", "vectors", "who", "lane")
        dealt = met.repartition("region", "lane").sortWithinPartitions("region", "lane", "block")
        found = dealt.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        return ranked.select("query_id", "rank", "vec_id", "score")


RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def _regions(batches: Iterator[pa.RecordBatch], dim: int, who: int | None = None):
    """Rows ``(region, block, ids, cells, entries)`` as arrays, one at a time."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = [c[at] for c in batch.columns]
            ids, cells = (row[i].values.to_numpy(zero_copy_only=False) for i in (2, 3))
            data = b"".join(row[4].values.to_pylist())
            entries = np.frombuffer(data, "<f8").reshape(-1, dim)
            found = (row[0].as_py(), row[1].as_py(), ids, cells, entries)
            if who is None:
                yield found
            else:
                yield (*found, row[who].values.to_numpy(zero_copy_only=False) if row[who].is_valid else None)


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of every row with the query; equal rows give equal scores."""
    # Divided by their largest entry first: the cosine stays, squares stay finite.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    query = query / np.abs(query).max()
    norms = np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum())
    return (rows * query).sum(axis=1) / norms


def _best(blocks, top: int) -> Iterator[pa.RecordBatch]:
    """The best of every query over the regions of a task, region after region.

    Scores of a block come from one matrix product; what may be among the best is scored
    again pair by pair, so that equal vectors have equal scores.
    """
    held: dict[int, list[tuple[float, int]]] = {}
    ids = cells = entries = units = None

    def flush():
        rows = [(q, v, -s) for q, best in held.items() for s, v in best]
        held.clear()
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
            ["query_id", "vec_id", "score"],
        )

    for _, block, own, asked, vectors, who in blocks:
        if block < 0:
            order = np.argsort(asked, kind="stable")
            ids, cells, entries = own[order], asked[order], vectors[order]
            units = unit(entries)
            continue
        present, column = np.unique(cells, return_inverse=True)
        wanted = np.zeros((len(own), len(present)), bool)
        wanted[who, np.searchsorted(present, asked)] = True
        scores = unit(vectors) @ units.T
        scores[~wanted[:, column]] = -2
        scores[own[:, None] == ids[None, :]] = -2
        for q, row, vector in zip(own.tolist(), scores, vectors):
            best = held.get(q, [])
            least = -best[-1][0] if len(best) == top else -1.5
            if len(row) > top:
                least = max(least, np.partition(row, len(row) - top)[len(row) - top])
            at = np.flatnonzero((row >= least - SLACK) & (row > -1.5))
            if len(at):
                again = cosines(entries[at], vector)
                best = sorted([*best, *zip((-again).tolist(), ids[at].tolist())])[:top]
                held[q] = best
        if len(held) > HELD:
            yield flush()
    yield flush()


def neighbours(
    embeddings: DataFrame, scratch: Scratch, queries: Column, top: int = 5, target: float = TARGET
) -> DataFrame:
    """The ``top`` nearest found of every query, over all vectors."""
    return MultiIndex(usable_vectors(embeddings), scratch, top, target).search(queries)
