"""Toxicity behind disguises: a noisy channel, decoded before scoring.

A writer hides a word by look-alike signs (``1d10t``), by signs or blanks between its
letters (``i.d.i.o.t``, ``i d i o t``) and by repeated letters. A disguised token is a
lattice: every character may stand for itself, for letters it resembles, for nothing,
or repeat the letter before it, each at a price. Viterbi search finds the cheapest
reading under a trigram model of characters that is learned from all words of the
corpus. Tokens that leave no choice, nearly all of them, are read as they stand.

A run of single characters is one lattice in which every blank may be kept or dropped,
so ``a s t u p i d`` is read as two words. Pieces of several letters (``stu pid``) are
closed up where that gives a word of the evidence and the search reads them so too.
Signs at the edges of a token are read as nothing, and those that resemble letters also
as these.

The restored words are scored by what the labels of a bounded sample of documents say
about them: a word, or a word
beginning, is toxic evidence as far as the lower bound of its share of label 1 is
high, and the evidence of a text adds up by noisy-or over its different words.

Cases: a null or empty text scores the share of label 1 that no evidence explains;
without labels every score is 0; a document with several labels counts with the
largest; null ids are scored and teach nothing; texts are read whole; other columns
pass through, those named like a result column are replaced; an empty table gives an
empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.llm.common import Scratch, slices, texts_of, with_columns

THRESHOLD = 0.3
TRAIN_DOCUMENTS = 20_000  # labelled documents learned from, those with the smallest hash of their id
LEAST_DOCUMENTS = 6  # labelled documents a word needs to count as evidence
LEAST_SHARE = 0.6  # lower bound of the share of label 1
BEGINNINGS = (4, 5, 6, 7, 8)  # lengths of word beginnings that count as well
LARGEST_LEXICON = 50_000  # strongest evidence first; a bound on the model's size
CACHED_TOKENS = 300_000

# Which letters a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = "^" + LETTERS + "~"  # start, letters, any other letter; the end is the start sign again
_NUMBER = {c: i for i, c in enumerate(SYMBOLS)}
SIZE = len(SYMBOLS)

# Prices of the channel in nats.
AS_LOOKALIKE, AS_NOTHING, AS_REPEAT, KEPT_DOUBLE = 1.0, 1.0, 1.0, 0.3
DROPPED_BLANK = 1.0  # between pieces of several letters; single characters are joined for nothing

_EDGES = ".,;:?!\"'`()[]{}<>|#*%&=~_-/\\"
_RUN = re.compile(rb"(?<!\S)(?:[!-~][ \t]+){2,}[!-~](?!\S)")
_CHOICE = re.compile(r"[^a-zß-￿]|(.)\1")


def symbol(c: str) -> int:
    return _NUMBER.get(c, SIZE - 1)


def _symbol_codes() -> np.ndarray:
    """Symbol by byte: 0 apart from letters, -1 for signs that may hide one, -2 inside a character."""
    table = np.zeros(256, np.int64)
    for c in LETTERS:
        table[ord(c)] = symbol(c)
    table[0xC0:] = SIZE - 1
    table[0x80:0xC0] = -2
    for c in LOOKALIKES:
        if c.isascii() and c not in "!|(<":  # those four also stand between words
            table[ord(c)] = -1
    return table


def trigram_counts(text: bytes, table: np.ndarray) -> np.ndarray:
    """Counts of ``(before, last, next)``; a word begins after two start signs and ends with one."""
    codes = table[np.frombuffer(b"  " + text.lower() + b" ", np.uint8)]
    codes = codes[codes != -2]
    before, last, after = codes[:-2], codes[1:-1], codes[2:]
    begins = last == 0
    good = (last >= 0) & (after >= 0) & (begins | (before >= 0)) & ~(begins & (after == 0))
    flat = (np.where(begins, 0, before) * SIZE + last) * SIZE + after
    return np.bincount(flat[good], minlength=SIZE**3)


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Minus log probabilities ``[before, last, next]``, 28 ** 3 numbers, from all words of ``docs``.

    Letters next to signs that may hide one do not teach. A task sums its counts, so at
    most 28 ** 3 rows of each reach the shuffle, and as many the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _symbol_codes(), np.zeros(SIZE**3, np.int64)
        for batch in slices(batches, 0):
            total += trigram_counts(b" ".join(texts_of(batch.column(0))), table)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["t", "n"])

    rows = docs.select(text).mapInArrow(run, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n"))
    table = np.zeros(SIZE**3)
    for r in rows.collect():
        table[r["t"]] = r["n"]
    table = table.reshape(SIZE, SIZE, SIZE)
    pairs = table.sum(axis=0) + 0.5
    pairs = pairs / pairs.sum(axis=1, keepdims=True)
    smooth = 20.0
    return -np.log((table + smooth * pairs[None]) / (table.sum(axis=2, keepdims=True) + smooth))


class Decoder:
    """Viterbi search over the lattice of one token."""

    def __init__(self, prices: np.ndarray):
        self.prices = prices.tolist()

    def restore(self, token: str) -> str:
        """The cheapest reading of a lower-case token."""
        token = token.strip(_EDGES) or token
        if not _CHOICE.search(token):
            return token
        # Blanks may be kept or dropped; the words are then set apart by one blank each.
        dropped = 0.0 if max(map(len, token.split(" "))) == 1 else DROPPED_BLANK
        prices = self.prices
        # Best price and reading by (symbol before, last symbol, last source letter).
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for i, c in enumerate(token):
            after: dict[tuple[int, int], tuple[float, str]] = {}

            def offer(state, price, text):
                held = after.get(state)
                if held is None or price < held[0]:
                    after[state] = (price, text)

            if c == " ":
                for (before, last), (price, text) in states.items():
                    offer((before, last), price + dropped, text)
                    offer((0, 0), price + prices[before][last][0], text + " " if last else text)
                states = after
                continue
            repeat = i > 0 and token[i - 1] == c
            readings = [(c, KEPT_DOUBLE if repeat else 0.0)] if c.isalpha() else []
            readings += [(x, AS_LOOKALIKE) for x in LOOKALIKES.get(c, "")]
            for (before, last), (price, text) in states.items():
                for letter, cost in readings:
                    s = symbol(letter)
                    offer((last, s), price + cost + prices[before][last][s], text + letter)
                if not c.isalpha():
                    offer((before, last), price + AS_NOTHING, text)
                elif repeat:
                    offer((before, last), price + AS_REPEAT, text)
            states = after
        best = min((price + prices[b][l][0], text) for (b, l), (price, text) in states.items())
        return best[1].strip()


def spaced_words(text: bytes, between: bytes = b"") -> list[bytes]:
    """Runs of three or more single characters set apart by blanks, closed up."""
    return [between.join(m.split()) for m in _RUN.findall(text)]


def tokens_of(lowered: bytes, pieces: list[bytes]) -> set[bytes]:
    """Words, and runs of single characters with a blank between each."""
    return {*pieces, *spaced_words(lowered, b" ")}


def edge_readings(token: str) -> tuple[list[str], list[str]]:
    """The token with the sign before it read as letters, and with the sign after it."""
    core = token.strip(_EDGES)
    if not core or core == token:
        return [], []
    at = token.index(core)
    first, last = token[at - 1 : at], token[at + len(core) :][:1]
    heads = [x + core for x in LOOKALIKES.get(first, "")] if first else []
    return heads, [w + x for w in [core, *heads] for x in (LOOKALIKES.get(last, "") if last else "")]


# The signs that resemble letters as letters, with the last of those they resemble as well.
_AS_LETTERS = [
    bytes.maketrans(*(b"".join(x) for x in zip(*((c.encode(), v[k].encode()) for c, v in LOOKALIKES.items() if c.isascii()))))
    for k in (0, -1)
]


def word_starts(lexicon: dict[str, float]) -> dict[bytes, str]:
    """Every beginning of the words of ``lexicon``, with the word where it is whole."""
    words = [k for k in lexicon if not k.endswith("*")]
    starts = {w.encode()[:n]: "" for w in words for n in range(1, len(w.encode()))}
    return starts | {w.encode(): w for w in words}


class Beginnings(dict):
    """By piece of a text: its letters where a word of the evidence begins with them, nothing
    where none does. A worker looks at a piece once."""

    def __init__(self, starts: dict[bytes, str], table: bytes):
        super().__init__()
        self.starts, self.table = starts, table

    def letters(self, piece: bytes) -> bytes:
        return piece if piece.isalpha() else piece.strip(_EDGES.encode()).translate(self.table)

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) > CACHED_TOKENS:
            self.clear()
        letters = self.letters(piece)
        self[piece] = found = letters if letters in self.starts else b""
        return found


def closed_up(pieces: list[bytes], tables: list[Beginnings]) -> set[tuple[str, str]]:
    """``(pieces, word)`` of neighbouring lower-case pieces that make a whole word of the evidence."""
    found = set()
    for begins in tables:
        starts = begins.starts
        for i in [i for i, letters in enumerate(map(begins.__getitem__, pieces)) if letters]:
            joined = begins[pieces[i]]
            for j in range(i + 1, len(pieces)):
                letters = begins.letters(pieces[j])
                joined += letters
                if joined not in starts:
                    break
                if starts[joined] and letters:
                    found.add((b" ".join(map(begins.letters, pieces[i : j + 1])).decode(), starts[joined]))
    return found


def evidence_keys(word: str) -> list[str]:
    """The word and its beginnings, which are marked."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) > n]]


@dataclass
class ToxicityModel:
    prices: np.ndarray
    lexicon: dict[str, float]  # lower bound of the share of label 1
    base: float  # share of label 1 among documents without evidence
    known: dict[bytes, float] = field(default_factory=dict, repr=False)
    begins: list[Beginnings] = field(default_factory=list, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "begins": []}

    def decoder(self) -> Decoder:
        return Decoder(self.prices)

    def evidence(self, token: str, decoder: Decoder) -> float:
        """The strongest evidence of any reading of a token."""
        heads, tails = edge_readings(token)
        read = {token.strip(_EDGES), *(w for t in (token, *heads) for w in decoder.restore(t).split(" "))}
        # A sign at the end adds nothing to the beginnings of a word.
        keys = [k for w in read for k in evidence_keys(w)] + [decoder.restore(t) for t in tails]
        return max((self.lexicon.get(k, 0.0) for k in keys), default=0.0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Noisy-or of the evidence in each text."""
        known, decoder = self.known, None
        if not self.begins:
            starts = word_starts(self.lexicon)
            self.begins += [Beginnings(starts, table) for table in _AS_LETTERS]
        scores = np.empty(len(texts))
        for i, text in enumerate(texts):
            innocent = 1 - self.base
            lowered = text.lower()
            pieces_of = lowered.split()
            tokens = tokens_of(lowered, pieces_of)
            for token in tokens:
                share = known.get(token)
                if share is None:
                    decoder = decoder or self.decoder()
                    if len(known) > CACHED_TOKENS:
                        known.clear()
                    share = known[token] = self.evidence(token.decode(), decoder)
                if share:
                    innocent *= 1 - share
            tables = self.begins if b"1" in lowered or b"|" in lowered else self.begins[:1]
            for pieces, word in closed_up(pieces_of, tables):
                if any(b" " in t and pieces.encode() in t for t in tokens):
                    continue  # counted with its run
                share = known.get(b"+" + pieces.encode())
                if share is None:
                    decoder = decoder or self.decoder()
                    read = decoder.restore(pieces).split()
                    share = known[b"+" + pieces.encode()] = self.lexicon[word] if word in read else 0.0
                innocent *= 1 - share
            scores[i] = 1 - innocent
        return scores


def lower_bound(hits, seen, z: float = 1.64):
    """Wilson lower bound of a share."""
    share = hits / seen
    spread = z * np.sqrt(share * (1 - share) / seen + z * z / (4 * seen * seen))
    return (share + z * z / (2 * seen) - spread) / (1 + z * z / seen)


def train(
    docs: DataFrame, labels: DataFrame, held_out: Column, scratch: Scratch,
    key: str = "doc_id", text: str = "text", label: str = "toxic", most: int = TRAIN_DOCUMENTS,
) -> ToxicityModel:
    """Learn the character model from all words, the evidence from a bounded sample of labels."""
    prices = character_model(docs, text)
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out)
    known = usable.groupBy(key).agg(F.max(F.col(label)).cast("int").alias("_label"))
    chosen = known.orderBy(F.xxhash64(key), key).limit(most)
    texts = docs.select(key, F.col(text).alias("_text"))
    labelled = texts.join(F.broadcast(chosen), key).select("_text", "_label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, restored = Decoder(prices), {}
        held: dict[str, list[int]] = {}

        def flush():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(held), pa.string()),
                    pa.array([v[0] for v in held.values()], pa.int64()),
                    pa.array([v[1] for v in held.values()], pa.int64()),
                ],
                ["word", "seen", "hits"],
            )
            held.clear()

        for batch in slices(batches, 0):
            for data, hit in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
                keys = {""}
                lowered = data.lower()
                for token in tokens_of(lowered, lowered.split()):
                    found = restored.get(token)
                    if found is None:
                        if len(restored) > CACHED_TOKENS:
                            restored.clear()
                        read = decoder.restore(token.decode()).split(" ")
                        found = restored[token] = [k for w in read for k in evidence_keys(w)]
                    keys.update(found)
                for k in keys:
                    both = held.setdefault(k, [0, 0])
                    both[0] += 1
                    both[1] += hit
            if len(held) > CACHED_TOKENS:
                yield from flush()
        yield from flush()

    seen = scratch.save(
        labelled.mapInArrow(run, "word string, seen bigint, hits bigint")
        .groupBy("word")
        .agg(F.sum("seen").alias("seen"), F.sum("hits").alias("hits"))
        .where((F.col("word") == "") | ((F.col("seen") >= LEAST_DOCUMENTS) & (F.col("hits") * 2 > F.col("seen")))),
        "evidence",
    )
    strongest = seen.where("word != ''").orderBy(F.desc("hits"), "seen", "word").limit(LARGEST_LEXICON)
    lexicon = {}
    for r in strongest.collect():
        bound = float(lower_bound(r["hits"], r["seen"]))
        if bound >= LEAST_SHARE:
            lexicon[r["word"]] = bound
    scratch.drop(seen)
    model = ToxicityModel(prices, lexicon, 0.0)
    model.base = _unexplained(labelled, model)
    return model


def _unexplained(labelled: DataFrame, model: ToxicityModel) -> float:
    """Share of label 1 among labelled documents without evidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = hits = 0
        for batch in slices(batches, 0):
            clean = model.score(texts_of(batch.column(0))) == 0
            seen += int(clean.sum())
            hits += int(np.asarray(batch.column(1).to_pylist())[clean].sum())
        yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([hits])], ["seen", "hits"])

    total = labelled.mapInArrow(run, "seen bigint, hits bigint").agg(F.sum("seen"), F.sum("hits")).first()
    return min(0.25, (total[1] or 0) / total[0]) if total[0] else 0.0


ADDED = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def classify(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and prediction."""

    def compute(texts: list[bytes], _) -> list[pa.Array]:
        scores = model.score(texts)
        return [pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))]

    return with_columns(docs, ADDED, compute, text)
