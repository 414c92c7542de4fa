"""Quality classifier: attention over the passages of a document.

A document is a bag of passages of 48 words. Every passage becomes a vector of shares
(character classes, word shapes, repetition), a learned layer encodes it, and a gated
attention, learned from the labels of whole documents alone, weighs the passages:

    h = tanh(W x);  a = softmax(w . (tanh(V h) * sigmoid(U h)));  z = sum(a h)
    score = sigmoid(c . z + b)

The model is fitted on at most ``TRAIN_DOCUMENTS`` labelled documents, those with the
smallest hash of their id, and on at most ``TRAIN_PASSAGES`` passages of each; scoring
reads every passage of every document.

Cases: a null or empty text is one passage of zeros and gets a score; without labels,
or with labels of one kind, all scores are the share of label 1 (0.5 without any); a
document with several labels counts with the largest; null ids are scored and teach
nothing; other columns pass through, those named like a result column are replaced;
an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.llm.common import slices, texts_of, with_columns

PASSAGE_WORDS = 48
TRAIN_DOCUMENTS = 8000
TRAIN_PASSAGES = 64
HIDDEN, GATE = 16, 8
EPOCHS, RATE, BAGS = 30, 0.01, 64
THRESHOLD = 0.3
SEED = 20240315

_SPACES = b" \t\n\x0b\x0c\r"
_LOWER, _UPPER, _DIGIT, _STOP, _SIGN, _BEYOND = range(6)


def _kinds() -> np.ndarray:
    table = np.full(256, 6, np.uint8)
    for b in range(33, 127):
        c = chr(b)
        table[b] = (
            _LOWER if c.islower() else _UPPER if c.isupper() else _DIGIT if c.isdigit() else
            _STOP if c in ".,;:'\"?-()" else _SIGN
        )
    table[0xC0:] = _BEYOND
    return table


KIND = _kinds()
FEATURES = 6 + 10


def _hash_words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hash of each word from its bytes and their places."""
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    powers = np.cumprod(np.full(max(1, int(sizes.max(initial=1))), 0x9E3779B97F4A7C15, np.uint64))
    at = np.repeat(starts, sizes) + place
    terms = (data[at].astype(np.uint64) + np.uint64(1)) * powers[place]
    return np.add.reduceat(terms, np.cumsum(sizes) - sizes)


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of all passages, and how many each text has (at least one)."""
    joined = b"\n".join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    space = np.zeros(256, bool)
    space[list(_SPACES)] = True
    inside = ~space[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edges[::2], edges[1::2]
    bounds = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(bounds, starts, side="right")
    per_doc = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(per_doc) - per_doc
    counts = np.maximum(1, -(-per_doc // PASSAGE_WORDS))
    base = np.cumsum(counts) - counts
    rows = np.zeros((int(counts.sum()), FEATURES))
    if not len(starts):
        return rows, counts
    sizes = ends - starts
    order = np.arange(len(starts)) - first[doc]
    passage = base[doc] + order // PASSAGE_WORDS
    words = np.bincount(passage, minlength=len(rows)).astype(float)
    hashes = _hash_words(data, starts, sizes)

    byte_word = np.repeat(np.arange(len(starts)), sizes)
    byte_at = np.repeat(starts, sizes) + np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kinds = KIND[data[byte_at]]
    per_word = np.bincount(byte_word * 7 + kinds, minlength=7 * len(starts)).reshape(-1, 7)[:, :6]
    per_passage = np.zeros((len(rows), 6))
    for k in range(6):
        per_passage[:, k] = np.bincount(passage, per_word[:, k], minlength=len(rows))
    chars = per_passage.sum(axis=1)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(passage, flags.astype(float), minlength=len(rows)) / np.maximum(words, 1)

    letters = per_word[:, _LOWER] + per_word[:, _UPPER] + per_word[:, _BEYOND]
    same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])])
    pair = (passage.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) ^ hashes
    new_in_passage = _first_seen(pair)
    three = _three_words(hashes, doc)
    rows[:, :6] = per_passage / np.maximum(chars, 1)[:, None]
    rows[:, 6] = share(same)
    rows[:, 7] = share(~new_in_passage)
    rows[:, 8] = share(~_first_seen(three))
    rows[:, 9] = share(letters == 0)
    rows[:, 10] = share(per_word[:, _SIGN] >= 2)
    rows[:, 11] = share((per_word[:, _UPPER] >= 2) & (per_word[:, _LOWER] == 0))
    rows[:, 12] = np.minimum(share(sizes) / 10, 3)
    rows[:, 13] = share(sizes > 25)
    rows[:, 14] = words / PASSAGE_WORDS
    rows[:, 15] = 1.0
    return rows, counts


def _first_seen(keys: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(keys), bool)
    seen[np.unique(keys, return_index=True)[1]] = True
    return seen


def _three_words(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A key per word for itself, the two words before it and its document."""
    a, b = np.roll(hashes, 1), np.roll(hashes, 2)
    key = hashes + a * np.uint64(0xBF58476D1CE4E5B9) + b * np.uint64(0x94D049BB133111EB)
    key ^= doc.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    short = np.arange(len(hashes)) - np.searchsorted(doc, doc) < 2
    # The first two words of a document end no window and repeat nothing.
    key[short] = np.arange(int(short.sum()), dtype=np.uint64)
    return key


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class AttentionModel:
    """Parameters by name, and the scaling of the inputs; a constant score without parameters."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    constant: float = 0.5

    def forward(self, rows: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        x = (rows - self.mean) / self.scale
        starts = np.cumsum(counts) - counts
        bag = np.repeat(np.arange(len(counts)), counts)
        h = np.tanh(x @ p["W"] + p["d"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (v * u) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        s = _sigmoid(z @ p["c"] + p["b"])
        return {"x": x, "h": h, "v": v, "u": u, "a": a, "z": z, "s": s, "bag": bag, "starts": starts}

    def score(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(counts), self.constant)
        return self.forward(rows, counts)["s"]

    def gradients(self, f: dict[str, np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
        p, bag = self.weights, f["bag"]
        out = (f["s"] - y) / len(y)
        dz = out[:, None] * p["c"]
        # Through the weighted sum and the softmax of each bag.
        toward = (dz[bag] * f["h"]).sum(axis=1)
        mean = np.add.reduceat(f["a"] * toward, f["starts"])[bag]
        de = f["a"] * (toward - mean)
        dg = de[:, None] * p["w"]
        dv = dg * f["u"] * (1 - f["v"] ** 2)
        du = dg * f["v"] * f["u"] * (1 - f["u"])
        dh = f["a"][:, None] * dz[bag] + dv @ p["V"].T + du @ p["U"].T
        dx = dh * (1 - f["h"] ** 2)
        return {
            "W": f["x"].T @ dx, "d": dx.sum(axis=0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
            "w": ((f["v"] * f["u"]) * de[:, None]).sum(axis=0), "c": f["z"].T @ out, "b": out.sum(keepdims=True),
        }


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = SEED) -> AttentionModel:
    """Adam over shuffled mini-batches of bags."""
    known = len(labels) > 0
    if not known or labels.min() == labels.max():
        share = float(labels.mean()) if known else 0.5
        return AttentionModel({}, np.zeros(FEATURES), np.ones(FEATURES), share)
    draw = np.random.default_rng(seed)
    every = np.concatenate(bags)
    mean, scale = every.mean(axis=0), every.std(axis=0)
    shapes = {"W": (FEATURES, HIDDEN), "d": HIDDEN, "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": GATE, "c": HIDDEN, "b": 1}
    weights = {k: draw.normal(0, 0.3, s) for k, s in shapes.items()}
    model = AttentionModel(weights, mean, np.where(scale > 1e-6, scale, 1.0))
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(bags))
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        for at in range(0, len(order), BAGS):
            chosen = order[at : at + BAGS]
            rows = np.concatenate([bags[i] for i in chosen])
            counts = np.array([len(bags[i]) for i in chosen])
            grads = model.gradients(model.forward(rows, counts), labels[chosen])
            step += 1
            for k, g in grads.items():
                g = g + 1e-4 * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                fixed = first[k] / (1 - 0.9**step), second[k] / (1 - 0.999**step)
                weights[k] -= rate * fixed[0] / (np.sqrt(fixed[1]) + 1e-8)
    return model


def train(
    docs: DataFrame, labels: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text",
    label: str = "quality", most: int = TRAIN_DOCUMENTS,
) -> AttentionModel:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out)
    chosen = (
        usable.groupBy(key).agg(F.max(label).alias("_label")).orderBy(F.xxhash64(key), key).limit(most)
    )
    texts = docs.select(key, F.col(text).alias("_text")).join(F.broadcast(chosen), key)

    def bags(batches):
        for batch in slices(batches, 1):
            texts = texts_of(batch.column(1))
            rows, counts = passages(texts)
            ends = np.cumsum(counts)
            kept, draws = [], []
            for name, data, end, n in zip(batch.column(0).to_pylist(), texts, ends, counts):
                own = rows[end - n : end]
                draw = zlib.crc32(data, zlib.crc32(name.encode()))
                if n > TRAIN_PASSAGES:  # the same ones however the rows are dealt out
                    own = own[np.sort(np.random.default_rng([SEED, draw]).permutation(n)[:TRAIN_PASSAGES])]
                kept.append(own.astype(np.float32).tobytes())
                draws.append(draw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), batch.column(2), pa.array(draws, pa.int64())],
                ["k", "bag", "label", "draw"],
            )

    drawn = texts.select(F.col(key).cast("string"), "_text", F.col("_label").cast("double"))
    each = drawn.mapInArrow(bags, "k string, bag binary, label double, draw bigint")
    # One row per id, chosen before the shuffle, so no more than ``most`` come to the driver.
    one = each.groupBy("k").agg(F.min(F.struct("draw", "bag", "label")).alias("r")).select("k", "r.bag", "r.label")
    rows = one.collect()
    rows.sort(key=lambda r: r["k"])
    found = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES).astype(float) for r in rows]
    return fit(found, np.array([r["label"] for r in rows]))


ADDED = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def classify(docs: DataFrame, model: AttentionModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and prediction."""

    def compute(texts: list[bytes], _) -> list[pa.Array]:
        scores = model.score(*passages(texts))
        return [pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))]

    return with_columns(docs, ADDED, compute, text)


def select_documents(
    docs: DataFrame, model: AttentionModel, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches the threshold."""
    place = docs.columns.index(text)

    def run(batches):
        for batch in slices(batches, place):
            if batch.num_rows:
                yield batch.filter(pa.array(model.score(*passages(texts_of(batch.column(place)))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
