"""Scoring texts with a log-bilinear neural model.

The probability of a word class after two words is a softmax over

    s(w | u, v) = (A1[u] + A2[v]) . R[w] + b[w]

with learned vectors for both context places and for the predicted class. Classes are
the most frequent words, buckets of the other words by their ending, and the end of a
text. Within a bucket a word has its share of the smoothed counts, so every word, also
an unknown one, has a probability.

Training is noise-contrastive: no sum over classes is needed. Every training document
is read once. In each of ``ROUNDS`` rounds the tasks train on their documents of that
round, starting from the same model, and the results are averaged by tokens, in a tree
of tasks. A task holds one model, whatever the corpus.

Scoring is normalised. The sum over classes for a pair of context words factors,
``sum_w exp(A1[u].R[w] + b[w]) exp(A2[v].R[w])``, so one matrix product gives it for
all pairs at once, and a token costs three look-ups.

Counts cover all training documents. Those of the 65,536 most frequent words travel
with the tasks; occurrences of all others are joined with the counts.

Cases: a null or empty text is just its end; without training documents the counts
are 0 and all classes are alike; null ids count as an empty text for the split; rows
that repeat are scored one by one; texts are read whole; other columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import Scratch, slices, texts_of, word_counts

FREQUENT = 959  # words that are classes of their own
BUCKETS = 64
CLASSES = 1 + FREQUENT + BUCKETS
LOCAL = 65_536  # words whose counts travel with the tasks
WIDTH = 24
ROUNDS, BATCH, NOISE, RATE = 2, 4096, 48, 0.08
FAN = 32
SMOOTH = 0.1
SEED = 20240315
END = 0
PARAMETERS = 3 * CLASSES * WIDTH + CLASSES


def bucket(word: bytes) -> int:
    return 1 + FREQUENT + zlib.crc32(word[-2:]) % BUCKETS


@dataclass
class Vocabulary:
    """Bounded tables of the counts: the ``LOCAL`` most frequent words and the classes."""

    words: list[bytes]
    counts: np.ndarray
    class_counts: np.ndarray  # tokens of each class
    mass: np.ndarray  # smoothed tokens of each bucket, 1 elsewhere
    tokens: int
    types: int
    place: dict[bytes, int] = field(default_factory=dict, repr=False)
    classes: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"place": {}, "classes": None}

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Place among the frequent words, -1 for all others."""
        if not self.place and self.words:
            self.place.update({w: i for i, w in enumerate(self.words)})
        get = self.place.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def class_of(self, numbers: np.ndarray, words: list[bytes]) -> np.ndarray:
        if self.classes is None:
            own = [1 + i if i < FREQUENT else bucket(w) for i, w in enumerate(self.words)]
            self.classes = np.array([*own, 0], np.int64)
        found = self.classes[numbers]
        for i in np.flatnonzero(numbers < 0).tolist():
            found[i] = bucket(words[i])
        return found


def learn_counts(training: DataFrame, scratch: Scratch, text: str = "text") -> tuple[DataFrame, Vocabulary]:
    """The saved counts ``(word, n)`` of all training words, and the tables made of them."""
    counted = word_counts(training.withColumn("_all", F.lit("")), "_all", text, lowered=True)
    counts = scratch.save(counted.select("word", "n"), "counts")
    ending = F.substring(F.encode("word", "utf-8"), -2, 2)
    of_bucket = (F.lit(1 + FREQUENT) + F.crc32(ending) % BUCKETS).cast("int")
    per_bucket = counts.groupBy(of_bucket.alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect()
    top = counts.orderBy(F.desc("n"), "word").limit(LOCAL).collect()
    ends = training.count()
    n, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in per_bucket:
        n[r["c"]], types[r["c"]] = r["n"], r["types"]
    tokens, distinct = int(n.sum()) + ends, int(types.sum()) + (ends > 0)
    for i, r in enumerate(top[:FREQUENT]):
        c = bucket(r["word"].encode())
        n[c] -= r["n"]
        types[c] -= 1
        n[1 + i] = r["n"]
    n[END] = ends
    mass = np.ones(CLASSES)
    mass[1 + FREQUENT :] = n[1 + FREQUENT :] + SMOOTH * (types[1 + FREQUENT :] + 1)
    words = [r["word"].encode() for r in top]
    return counts, Vocabulary(words, np.array([r["n"] for r in top], float), n, mass, tokens, distinct)


@dataclass
class LogBilinear:
    first: np.ndarray  # classes x width, the word before
    second: np.ndarray  # the word before that
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, noise: np.ndarray, seed: int = SEED) -> LogBilinear:
        draw = np.random.default_rng(seed)
        vectors = [draw.normal(0, 0.15, (CLASSES, WIDTH)).astype(np.float32) for _ in range(3)]
        return cls(*vectors, np.log(noise).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([p.reshape(-1) for p in (self.first, self.second, self.out, self.bias)])

    @classmethod
    def of(cls, flat: np.ndarray) -> LogBilinear:
        size = CLASSES * WIDTH
        parts = [flat[i * size : (i + 1) * size].reshape(CLASSES, WIDTH).copy() for i in range(3)]
        return cls(*parts, flat[3 * size :].copy())

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (word before, class) and (word before that, class), and the log of the sum over classes."""
        one = self.first.astype(np.float64) @ self.out.T + self.bias
        two = self.second.astype(np.float64) @ self.out.T
        top_one, top_two = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
        total = np.exp(one - top_one) @ np.exp(two - top_two).T
        return one, two, np.log(total) + top_one + top_two.T


def contexts(classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Predicted class, the one before and the one before that, text after text with its end."""
    line = np.concatenate([[END], *[part for c in classes for part in (c, [END])]]).astype(np.int64)
    before = line[:-1]
    earlier = np.concatenate([[END], line[:-2]])
    return line[1:], before, np.where(before == END, END, earlier)


class Trainer:
    """Noise-contrastive steps with Adagrad on one task's documents."""

    def __init__(self, model: LogBilinear, noise: np.ndarray, seed: int):
        self.model, self.draw = model, np.random.default_rng(seed)
        self.noise_log = np.log(NOISE * noise).astype(np.float32)
        self.cumulated = np.cumsum(noise) / noise.sum()
        self.squares = [np.full(p.shape, 1e-2, np.float32) for p in (model.first, model.second, model.out, model.bias)]
        self.tokens = 0

    def train(self, target: np.ndarray, before: np.ndarray, earlier: np.ndarray) -> None:
        order = self.draw.permutation(len(target))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            self.step(target[some], before[some], earlier[some])
        self.tokens += len(target)

    def step(self, target: np.ndarray, before: np.ndarray, earlier: np.ndarray) -> None:
        m = self.model
        n = len(target)
        noise = np.searchsorted(self.cumulated, self.draw.random(NOISE)).clip(0, CLASSES - 1)
        query = m.first[before] + m.second[earlier]
        wanted = m.out[target]
        real = (query * wanted).sum(axis=1) + m.bias[target] - self.noise_log[target]
        fake = query @ m.out[noise].T + (m.bias[noise] - self.noise_log[noise])
        pull = 1 / (1 + np.exp(np.clip(real, -30, 30)))  # 1 - sigmoid
        push = -1 / (1 + np.exp(-np.clip(fake, -30, 30)))
        toward = pull[:, None] * wanted + push @ m.out[noise]
        self.update(0, m.first, before, toward)
        self.update(1, m.second, earlier, toward)
        places = np.concatenate([target, noise])
        self.update(2, m.out, places, np.concatenate([pull[:, None] * query, push.T @ query]))
        self.update(3, m.bias, places, np.concatenate([pull, push.sum(axis=0)]))

    def update(self, which: int, parameter: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
        """Ascend by the summed gradient of each row that occurs, scaled to a mean per batch."""
        order = np.argsort(rows, kind="stable")
        found, first = np.unique(rows[order], return_index=True)
        summed = np.add.reduceat(gradient[order], first) * np.float32(1 / 64)
        self.squares[which][found] += summed * summed
        parameter[found] += np.float32(RATE) * summed / np.sqrt(self.squares[which][found])


def fit(training: DataFrame, vocabulary: Vocabulary, scratch: Scratch, key: str, text: str) -> LogBilinear:
    """Train on every training document once."""
    noise = (vocabulary.class_counts + 1) / (vocabulary.class_counts + 1).sum()
    model = LogBilinear.start(noise)
    turn = F.pmod(F.xxhash64(F.col(key)), F.lit(ROUNDS))
    for r in range(ROUNDS):

        def run(batches: Iterator[pa.RecordBatch], model=model, r=r) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(LogBilinear.of(model.flat()), noise, SEED + r)
            for batch in slices(batches, 0, 4 << 20):
                classes = []
                for data in texts_of(batch.column(0)):
                    words = data.lower().split()
                    classes.append(vocabulary.class_of(vocabulary.numbers(words), words))
                if classes:
                    trainer.train(*contexts(classes))
            if trainer.tokens:
                weighed = trainer.model.flat().astype(np.float64) * trainer.tokens
                yield _weighed(weighed, trainer.tokens)

        mine = training.where(turn == r).select(text)
        rows = scratch.save(mine.mapInArrow(run, "model binary, tokens bigint"), "models")
        held = rows.count()
        while held > FAN:
            held = -(-held // FAN)
            fewer = scratch.save(rows.repartition(held).mapInArrow(_summed, "model binary, tokens bigint"), "models")
            scratch.drop(rows)
            rows = fewer
        parts = rows.collect()
        scratch.drop(rows)
        tokens = sum(p["tokens"] for p in parts)
        if tokens:
            total = sum(np.frombuffer(p["model"], np.float64) for p in parts)
            model = LogBilinear.of((total / tokens).astype(np.float32))
    return model


def _weighed(model: np.ndarray, tokens: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([model.tobytes()], pa.binary()), pa.array([tokens], pa.int64())], ["model", "tokens"]
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, tokens = np.zeros(PARAMETERS), 0
    for batch in batches:
        for model, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total += np.frombuffer(model, np.float64)
            tokens += n
    if tokens:
        yield _weighed(total, tokens)


PARTS = "row bigint, id bigint, word string, times bigint, n_tokens bigint, n_known bigint, base double, score double"


def score_texts(
    docs: DataFrame, held_out: Column, scratch: Scratch, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Token counts, base score and the model's log10 probability of every row of ``docs``."""
    training = docs.where(~held_out)
    counts, vocabulary = learn_counts(training.select(key, text), scratch, text)
    model = fit(training, vocabulary, scratch, key, text)
    floor = math.log10(vocabulary.tokens + SMOOTH * (vocabulary.types + 1))
    ends = float(vocabulary.class_counts[END])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, total = model.tables()
        mass = np.log10(vocabulary.mass)
        logs = np.append(np.log10(vocabulary.counts + SMOOTH), 0.0)  # others come by the join
        for batch in slices(batches, 2):
            rows, ids = batch.column(0).to_pylist(), batch.column(1).cast(pa.int64()).to_pylist()
            numbers, classes, rare = [], [], []
            for i, data in enumerate(texts_of(batch.column(2))):
                words = data.lower().split()
                number = vocabulary.numbers(words)
                numbers.append(number)
                classes.append(vocabulary.class_of(number, words))
                others = Counter(words[j] for j in np.flatnonzero(number < 0).tolist())
                rare += [(rows[i], w, n) for w, n in others.items()]
            if not rows:
                continue
            sizes = np.array([len(x) for x in numbers])
            target, before, earlier = contexts(classes)
            model_log = one[before, target] + two[earlier, target] - total[before, earlier]
            text_of = np.repeat(np.arange(len(rows)), sizes + 1)
            line = np.concatenate([part for x in numbers for part in (x, [-1])])
            at_end = target == END
            smoothed = np.where(at_end, math.log10(ends + SMOOTH), logs[line])
            known = np.where(at_end, ends > 0, line >= 0)
            inside = np.where(target > FREQUENT, logs[line] - mass[target], 0.0)

            def per_text(values):
                return np.bincount(text_of, values, minlength=len(rows))

            base = per_text(smoothed - floor)
            score = per_text(model_log / math.log(10) + inside)
            n = len(rows)
            yield _parts(rows, ids, [None] * n, [0] * n, sizes + 1, per_text(known).astype(int), base, score)
            if rare:
                r, w, t = zip(*rare)
                z = np.zeros(len(r))
                yield _parts(r, [None] * len(r), w, t, z.astype(int), z.astype(int), z, z)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), key, text)
    parts = numbered.mapInArrow(run, PARTS)
    joined = parts.join(counts, "word", "left")
    times, n = F.col("times"), F.coalesce("n", F.lit(0))
    late = times * F.log10(n + SMOOTH)
    summed = joined.groupBy("row").agg(
        F.max("id").alias(key),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(n > 0, times).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + late).alias("base_score"),
        F.sum(F.col("score") + late).alias("score"),
    )
    return summed.select(
        key, held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def _parts(rows, ids, words, times, tokens, known, base, score) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    arrays = [pa.array(c, t) for c, t in zip((rows, ids, words, times, tokens, known, base, score), kinds)]
    arrays[2] = arrays[2].cast(pa.string())
    return pa.RecordBatch.from_arrays(
        arrays, ["row", "id", "word", "times", "n_tokens", "n_known", "base", "score"]
    )
