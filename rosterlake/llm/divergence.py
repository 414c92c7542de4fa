"""Quality rules from how far a document's distributions are from those of languages.

A language reference is learned from all documents of that language: the shares of
character classes over the characters of words, and the shares of its most common
words, with one bin for all other words. A document is measured against every
reference by Jensen-Shannon distance (base 2, so between 0 and 1) and keeps the
nearest one's distances. Histograms of few words are noise, so each distance is used
from a minimum length on.

A document without any common word is only as far from a reference as the share of that
reference's common words puts it, so the limit on word distances is ``GONE`` of that
reach where this is below ``WORD_LIMIT``. A language of which more than ``FAR`` of the own
documents lie beyond has no words common to its documents, and only ``WORD_LIMIT`` holds.

``base_failed``: fewer than 50 words, or more than half of the words lie in three-word
windows that occur twice or more. ``kept`` is false then, or when a distance that is
long enough to count is above its limit.

Cases: a null or empty text has no words and fails the base; documents without a
language still are judged, but teach nothing; without any reference only the base
counts; texts are read whole; rows that repeat are judged one by one; other columns
pass through, those named like a result column are replaced; an empty table gives an
empty one.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.llm.common import Scratch, slices, texts_of, with_columns, word_counts

MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
COMMON_WORDS = 64
LANGUAGES = 256  # references compared at once
CHAR_LIMIT, CHAR_MIN_CHARS = 0.30, 200
WORD_LIMIT, WORD_MIN_WORDS = 0.48, 80
GONE = 0.9  # of the distance of a document without common words
FAR = 25  # per cent of a language's own documents

ADDED = [
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("language", T.StringType()),
    T.StructField("char_distance", T.DoubleType()),
    T.StructField("word_distance", T.DoubleType()),
]

SYMBOLS = b"#*$%&|<>"
# Continuation bytes of a character do not count.
CLASSES = ("lower vowel", "lower consonant", "upper", "digit", "stop", "symbol", "other sign", "beyond ascii")


def _class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.uint8)  # the last one is dropped
    for b in range(33, 127):
        c = chr(b)
        if c in "aeiou":
            kind = 0
        elif c.islower():
            kind = 1
        elif c.isupper():
            kind = 2
        elif c.isdigit():
            kind = 3
        elif c in ".,;:!?'\"":
            kind = 4
        elif b in SYMBOLS:
            kind = 5
        else:
            kind = 6
        table[b] = kind
    table[0xC0:] = 7
    return table


CLASS_OF = _class_table()


def class_counts(data: bytes) -> np.ndarray:
    kinds = CLASS_OF[np.frombuffer(data, np.uint8)]
    return np.bincount(kinds, minlength=len(CLASSES) + 1)[: len(CLASSES)]


@dataclass(frozen=True)
class References:
    """A row of fixed width for every language: small whatever the corpus."""

    languages: tuple[str, ...]
    chars: np.ndarray  # languages x classes, shares
    words: tuple[dict[bytes, int], ...]  # bin of each common word
    shares: np.ndarray  # languages x (common words + 1), shares
    limits: np.ndarray  # largest word distance of each


def references(
    docs: DataFrame, scratch: Scratch, text: str = "text", language: str = "lang"
) -> References:
    """Learn the references from every document with a language.

    Words are counted in the tasks first, so a language with most of the corpus is spread
    like any other.
    """
    counted = word_counts(docs.where(F.col(language).isNotNull()), language, text)
    counts = scratch.save(counted.withColumnRenamed("by", "lang"), "words")

    def classes(batches):
        for batch in batches:
            rows = [class_counts(w) * n for w, n in zip(_bytes(batch.column(1)), batch.column(2).to_pylist())]
            flat = np.array(rows, np.int64).reshape(-1)
            found = pa.FixedSizeListArray.from_arrays(pa.array(flat), len(CLASSES)).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["lang", "c"])

    per_word = counts.select("lang", "word", "n").mapInArrow(classes, "lang string, c array<bigint>")
    chars = per_word.groupBy("lang").agg(*[F.sum(F.col("c")[i]).alias(f"c{i}") for i in range(len(CLASSES))])
    lowered = counts.groupBy("lang", F.lower("word").alias("word")).agg(F.sum("n").alias("n"))
    ranked = lowered.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    )
    common = ranked.where(F.col("rank") <= COMMON_WORDS).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("common")
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rows = totals.join(chars, "lang").join(common, "lang").collect()
    scratch.drop(counts)
    rows.sort(key=lambda r: r["lang"])
    shape = np.array([[r[f"c{i}"] for i in range(len(CLASSES))] for r in rows], float).reshape(-1, len(CLASSES))
    shares = np.zeros((len(rows), COMMON_WORDS + 1))
    for i, r in enumerate(rows):
        for k, w in enumerate(r["common"]):
            shares[i, k] = w["n"] / r["total"]
        shares[i, COMMON_WORDS] = max(0.0, 1 - shares[i].sum())
    none = np.zeros_like(shares)
    none[:, COMMON_WORDS] = 1
    learned = References(
        tuple(r["lang"] for r in rows),
        shape / np.maximum(shape.sum(axis=1, keepdims=True), 1) if len(rows) else shape,
        tuple({w["word"].encode(): k for k, w in enumerate(r["common"])} for r in rows),
        shares,
        np.minimum(WORD_LIMIT, GONE * distances(none, shares)),
    )
    return replace(learned, limits=usable_limits(docs, learned, text, language))


def usable_limits(docs: DataFrame, learned: References, text: str, language: str) -> np.ndarray:
    """The limits, with ``WORD_LIMIT`` for languages whose own documents are beyond theirs too often."""
    number = {name: i for i, name in enumerate(learned.languages)}

    def run(batches):
        seen = np.zeros((len(number), 2), np.int64)
        for batch in slices(batches, 1):
            for name, data in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                words = data.lower().split()
                if len(words) >= WORD_MIN_WORDS:
                    i = number[name]  # a text with words has taught its language
                    bins = learned.words[i]
                    found = [bins[w] for w in words if w in bins]
                    row = np.bincount(found, minlength=COMMON_WORDS + 1) / len(words)
                    row[COMMON_WORDS] = 1 - len(found) / len(words)
                    seen[i] += 1, distances(row, learned.shares[i : i + 1])[0] > learned.limits[i]
        some = np.flatnonzero(seen[:, 0])
        columns = [pa.array(some), pa.array(seen[some, 0]), pa.array(seen[some, 1])]
        yield pa.RecordBatch.from_arrays(columns, ["i", "seen", "far"])

    if not number:
        return learned.limits
    own = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull())
    rows = own.select(F.col(language).cast("string"), text).mapInArrow(run, "i bigint, seen bigint, far bigint")
    limits = learned.limits.copy()
    for r in rows.groupBy("i").agg(F.sum("seen").alias("seen"), F.sum("far").alias("far")).collect():
        if 100 * r["far"] > FAR * r["seen"]:
            limits[r["i"]] = WORD_LIMIT
    return limits


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def distances(p: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of the shares ``p`` (one row, or one per reference) to each reference."""
    p = np.broadcast_to(p, references.shape)
    middle = (p + references) / 2

    def part(q):
        with np.errstate(divide="ignore", invalid="ignore"):
            terms = np.where(q > 0, q * np.log2(q / middle), 0.0)
        return terms.sum(axis=1)

    return np.sqrt(np.clip((part(p) + part(references)) / 2, 0.0, 1.0))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    n = len(number)
    if n < 1 << 20:
        windows = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:
        _, pairs = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)
        windows = pairs * n + ids[2:]
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[place] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def judge(docs: DataFrame, learned: References, text: str = "text") -> DataFrame:
    """``docs`` with the base figures, the verdict and the nearest language's distances."""
    # Every common word of any language once; where it counts as a bin of a reference.
    number = {w: i for i, w in enumerate(dict.fromkeys(w for bins in learned.words for w in bins))}
    cells = [(i, k, number[w]) for i, bins in enumerate(learned.words) for w, k in bins.items()]
    at_language, at_bin, at_word = np.array(cells, np.int64).reshape(-1, 3).T
    blocks = [slice(i, i + LANGUAGES) for i in range(0, len(learned.languages), LANGUAGES)]

    def to_all(p: np.ndarray, references: np.ndarray) -> np.ndarray:
        p = np.broadcast_to(p, references.shape)
        return np.concatenate([distances(p[b], references[b]) for b in blocks])

    def one(data: bytes):
        words = data.split()
        n = len(words)
        counts = class_counts(data)
        chars, symbols = int(np.count_nonzero(_points_of_words(data))), sum(data.count(bytes([s])) for s in SYMBOLS)
        repeats = repeated_words(words)
        failed = n < MIN_WORDS or 100 * repeats > MOST_REPEATED * n
        language = char_distance = word_distance = None
        kept = not failed
        if n and learned.languages:
            by_char = to_all(counts / max(1, counts.sum()), learned.chars)
            found = np.array([number[w] for w in data.lower().split() if w in number], np.int64)
            rows = np.zeros_like(learned.shares)
            rows[at_language, at_bin] = np.bincount(found, minlength=len(number))[at_word] / n
            rows[:, COMMON_WORDS] = 1 - rows.sum(axis=1)
            by_word = to_all(rows, learned.shares)
            nearest = int(np.argmin(by_char + by_word))
            language = learned.languages[nearest]
            char_distance, word_distance = float(by_char[nearest]), float(by_word[nearest])
            if chars >= CHAR_MIN_CHARS and char_distance > CHAR_LIMIT:
                kept = False
            if n >= WORD_MIN_WORDS and word_distance > learned.limits[nearest]:
                kept = False
        lines = duplicate_lines(data)
        return n, chars, symbols, lines, repeats, failed, kept, language, char_distance, word_distance

    def compute(texts: list[bytes], _) -> list[pa.Array]:
        columns = zip(*[one(t) for t in texts])
        types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string(), pa.float64(), pa.float64()]
        return [pa.array(list(c), t) for c, t in zip(columns, types)]

    return with_columns(docs, ADDED, compute, text)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _points_of_words(data: bytes) -> np.ndarray:
    """Where a character of a word starts."""
    array = np.frombuffer(data, np.uint8)
    return ((array & 0xC0) != 0x80) & ~_SPACE[array]
