"""Benchmark passages in documents, also edited ones.

Items and documents become sequences of words (lower case, signs dropped); of scripts
written without blanks (Han, kana, Thai, Lao, Tibetan, Burmese, Khmer) every character
is a word of its own. A document holds an item when some stretch of it is within ``ERRORS`` per cent of the item's words
in edit distance. Windows of an item's size slide over every document; the CGK
embedding, a random walk that repeats or advances on coin flips drawn per step and
word, turns their edit distance into Hamming distance; hashes of sampled places of
the embedding put windows and items that are near into the same bucket for at least
one of many samples. Whatever meets is confirmed by exact edit distance against the
document around the window.

The more edits, the fewer samples miss them all, so an item of more than ``PIECE`` words
is searched in pieces of about equal size: of an item with at most ``ERRORS`` per cent of
edits, one piece at least has no more than that. Items of fewer than ``LEAST_WORDS``
words leave the embedding no room; they are cut into one piece more than they may have
edits, so that one piece is whole, and windows at every word are compared with the
pieces by one hash. Where a piece is met, the whole item is confirmed.

Windows of the embedding start at every second word and are a word shorter than the
smallest piece of their class (sizes within a fifth of each other), since the
confirmation reaches beyond the window on both sides. A window that has too few words of
its class's pieces cannot be within the distance of any and is not embedded; that test
loses nothing.

Recall: items with up to ``ERRORS`` per cent of random word edits are found with at
least the target of 0.95 at every size; the tests measure it up to 400 words. Exact
passages always share every sample, and items below ``LEAST_WORDS`` are all found.

The benchmark is read in blocks of ``BLOCK`` items and a task holds one of them, so what
it holds is bounded whatever the size of the benchmark; each block is one pass over the
documents, or over those that the blocks before have left.

Cases: null and empty texts, on both sides, hold and are nothing; an item of one or a few
words is found in ordinary text too, so hits tell the item's words, and ``clean`` takes
the smallest number that counts (1 unless the caller says otherwise); an item that is repeated with its id counts once, repeated rows each count; null ids are carried along and filtered like others; texts are read whole; other
columns are not read; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import Scratch, slices, texts_of

ERRORS = 15  # per cent of an item's words
LEAST_WORDS = 8  # of an item that is embedded
PIECE = 28  # most words embedded at once
STRIDE = 2
CLASS = 1.2
WALKS, SAMPLES, PLACES = 8, 6, 6
BLOCK = 5000
SEED = 20240315
HITS = "doc_id bigint, item_id bigint, distance bigint, start bigint, end bigint, item_words bigint"


def _fold() -> bytes:
    table = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalnum() else 32
    return bytes(table)


FOLD = _fold()


# UTF-8 of single characters of scripts without blanks, and of the signs between them.
_ALONE = re.compile(
    rb"\xe0[\xb8-\xbf][\x80-\xbf]|\xe1[\x80-\x82\x9e\x9f][\x80-\xbf]|\xe3\x80[\x85-\x87]"
    rb"|\xe3[\x81-\x87\x90-\xbf][\x80-\xbf]|[\xe4-\xe9][\x80-\xbf]{2}|\xef[\xa4-\xab][\x80-\xbf]"
    rb"|\xef\xbd[\xa6-\xbf]|\xef\xbe[\x80-\x9f]|\xf0[\xa0-\xb3][\x80-\xbf]{2}"
)
_WIDE_SIGN = re.compile(
    rb"\xe3\x80[\x80-\x84\x88-\xbf]|\xef\xbc[\x80-\x8f\x9a-\xa0\xbb-\xbf]|\xef\xbd[\x80\x9b-\xa5]"
)


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case; ASCII signs separate, and a character of a script without blanks is a word."""
    text = text.translate(FOLD)
    if _ALONE.search(text):
        text = _ALONE.sub(rb" \g<0> ", _WIDE_SIGN.sub(b" ", text))
    return text.split()


def allowed(n: int, errors: int = ERRORS) -> int:
    """Edits that an item of ``n`` words may have."""
    return n * errors // 100


def best_stretch(item: list, text: list) -> tuple[int, int, int]:
    """``(distance, start, end)`` of the stretch of ``text`` nearest to ``item``; first of equals."""
    number = {w: i for i, w in enumerate(dict.fromkeys(item))}
    line = np.fromiter((number.get(w, -1) for w in text), np.int64, len(text))
    # Cost and start in one number, so the smaller cost and then the smaller start wins.
    one = len(text) + 1
    places = np.arange(one)
    cost = places.copy()
    for word in item:
        row = cost + one
        row[1:] = np.minimum(row[1:], cost[:-1] + one * (line != number[word]))
        # A cell may also follow any cell before it at one edit a place.
        cost = np.minimum.accumulate(row - places * one) + places * one
    end = int(np.argmin(cost // one))
    return int(cost[end] // one), int(cost[end] % one), end


class Embedding:
    """CGK walks and the sampled places of each."""

    def __init__(self, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.keys = draw.integers(1, 1 << 62, WALKS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        # Places are fractions of a walk, so that each class of sizes uses them all.
        self.places = np.sort(draw.random((WALKS, SAMPLES, PLACES)), axis=2)
        self.mix = draw.integers(1, 1 << 62, (WALKS, SAMPLES, PLACES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def buckets(self, windows: np.ndarray) -> np.ndarray:
        """One bucket per window and sample; ``windows`` are hashes of words, one row each."""
        n, size = windows.shape
        steps = 2 * size
        out = np.zeros((n, WALKS, SAMPLES), np.uint64)
        padded = np.concatenate([windows, np.zeros((n, 1), np.uint64)], axis=1)
        rows = np.arange(n)
        for k in range(WALKS):
            at = np.minimum((self.places[k] * steps).astype(int), steps - 1)
            wanted = defaultdict(list)
            for s in range(SAMPLES):
                for p in range(PLACES):
                    wanted[int(at[s, p])].append((s, p))
            here = np.zeros(n, np.int64)
            for step in range(max(wanted) + 1):
                now = padded[rows, here]
                for s, p in wanted.get(step, ()):
                    out[:, k, s] += now * self.mix[k, s, p]
                coin = ((now ^ np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * self.keys[k]) >> np.uint64(63)
                here = np.minimum(here + coin.astype(np.int64), size)
        number = np.arange(WALKS * SAMPLES, dtype=np.uint64).reshape(1, WALKS, SAMPLES)
        return (out * np.uint64(0x94D049BB133111EB) + number).reshape(n, WALKS * SAMPLES)


def whole_hash(windows: np.ndarray) -> np.ndarray:
    """One bucket per window, for equal windows only."""
    out = np.zeros(len(windows), np.uint64)
    for column in windows.T:
        out = (out ^ column) * np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(29)
    return out[:, None]


def cut(n: int, pieces: int) -> list[tuple[int, int]]:
    """Starts and ends of pieces of about one size."""
    ends = [n * i // pieces for i in range(pieces + 1)]
    return list(zip(ends, ends[1:]))


@dataclass
class SizeClass:
    """Pieces of about one size."""

    size: int  # words of a window
    whole: bool  # equal windows only, by one hash
    least: int  # words of these pieces in a window that can be near to one
    words: np.ndarray  # whether a word of the block's vocabulary is in one of these pieces
    keys: np.ndarray  # sorted buckets
    first: np.ndarray  # where the pieces of each bucket begin
    owners: np.ndarray  # (item, words before the piece), bucket by bucket


@dataclass
class Benchmark:
    """A block of items, ready for the search."""

    ids: list
    items: list[list[bytes]]
    vocabulary: dict[bytes, int]  # number of each word, from 1
    hashes: np.ndarray  # hash by number, 0 for unknown words
    classes: list[SizeClass]
    errors: int


def prepare(rows: list[tuple[int | None, bytes]], embedding: Embedding, errors: int = ERRORS) -> Benchmark:
    """Cut items into pieces, sort these into classes of sizes and hash each at its class's size."""
    items = [(i, words_of(t)) for i, t in rows]
    items = [(i, w) for i, w in items if w]
    vocabulary: dict[bytes, int] = {}
    for _, words in items:
        for w in words:
            vocabulary.setdefault(w, len(vocabulary) + 1)
    hashes = np.array([0, *[xxhash.xxh3_64_intdigest(w) | 1 for w in vocabulary]], np.uint64)
    numbers = [np.array([vocabulary[w] for w in words]) for _, words in items]
    short: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    embedded: list[tuple[int, int, int]] = []  # words, item, words before the piece
    for k, own in enumerate(numbers):
        n = len(own)
        if n < LEAST_WORDS:
            for start, end in cut(n, min(n, allowed(n, errors) + 1)):
                short[end - start].append((end - start, k, start))
        else:
            embedded += [(end - start, k, start) for start, end in cut(n, -(-n // PIECE))]
    groups: list[list[tuple[int, int, int]]] = []
    for piece in sorted(embedded):
        if not groups or piece[0] > groups[-1][0][0] * CLASS:
            groups.append([])
        groups[-1].append(piece)
    classes = []
    for whole, pieces in [*((True, p) for p in short.values()), *((False, g) for g in groups)]:
        # Windows of the embedding may start up to STRIDE - 1 words into a piece.
        shifts = 1 if whole else STRIDE
        size = pieces[0][0] - shifts + 1
        inside = np.zeros(len(hashes), bool)
        found: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for shift in range(shifts):
            heads = np.array([numbers[k][at + shift : at + shift + size] for _, k, at in pieces], np.int64)
            made = whole_hash(hashes[heads]) if whole else embedding.buckets(hashes[heads])
            for (n, k, at), buckets in zip(pieces, made):
                inside[numbers[k][at : at + n]] = True
                for b in buckets.tolist():
                    found[b].add((k, at))
        keys = np.array(sorted(found), np.uint64)
        lists = [sorted(found[int(b)]) for b in keys]
        first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(int)
        least = size if whole else max(1, size - allowed(pieces[-1][0], errors) - STRIDE + 1)
        owners = np.array([owner for x in lists for owner in x], int).reshape(-1, 2)
        classes.append(SizeClass(size, whole, least, inside, keys, first, owners))
    return Benchmark([i for i, _ in items], [w for _, w in items], vocabulary, hashes, classes, errors)


class Searcher:
    def __init__(self, bench: Benchmark, embedding: Embedding):
        self.bench, self.embedding = bench, embedding
        self.reach = max((c.size for c in bench.classes), default=0)

    def meetings(self, numbers: list[np.ndarray]) -> dict[tuple[int, int], list[int]]:
        """Windows that share a bucket with a piece: where the item would start by (text, item)."""
        found: dict[tuple[int, int], set[int]] = defaultdict(set)
        sizes = np.array([len(x) for x in numbers])
        gap = np.zeros(self.reach + 1, np.int64)
        # Texts side by side, each followed by unknown words that no window reaches beyond.
        line = np.concatenate([part for x in numbers for part in (x, gap)])
        begins = np.concatenate([[0], np.cumsum(sizes + len(gap))])
        text = np.repeat(np.arange(len(numbers)), sizes)
        inner = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        starts = begins[text] + inner
        even = inner % STRIDE == 0
        codes = self.bench.hashes[line]
        for c in self.bench.classes:
            known = np.concatenate([[0], np.cumsum(c.words[line])])
            near = known[starts + c.size] - known[starts] >= c.least
            passed = np.flatnonzero(near if c.whole else near & even)
            for at in range(0, len(passed), 4096):
                some = passed[at : at + 4096]
                windows = codes[starts[some][:, None] + np.arange(c.size)]
                buckets = whole_hash(windows) if c.whole else self.embedding.buckets(windows)
                place = np.minimum(np.searchsorted(c.keys, buckets), len(c.keys) - 1)
                for i, j in zip(*np.nonzero(c.keys[place] == buckets)):
                    w, p = some[i], place[i, j]
                    for k, at in c.owners[c.first[p] : c.first[p + 1]].tolist():
                        found[int(text[w]), k].add(int(inner[w]) - at)
        return {pair: sorted(places) for pair, places in found.items()}

    def hits(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """``(text, item, distance, start, end)`` of every item a text holds; places count words."""
        if not self.bench.classes or not texts:
            return []
        find = self.bench.vocabulary.get
        split = [words_of(t) for t in texts]
        numbers = [np.fromiter((find(w, 0) for w in words), np.int64, len(words)) for words in split]
        out = []
        for (t, k), places in sorted(self.meetings(numbers).items()):
            best = self.confirm(k, split[t], places)
            if best is not None:
                out.append((t, k, *best))
        return out

    def confirm(self, k: int, words: list[bytes], places: list[int]):
        """The nearest stretch around any of the windows, if it is near enough."""
        item = self.bench.items[k]
        limit = allowed(len(item), self.bench.errors)
        margin = limit + 2 * STRIDE
        best, reach = None, -1
        for start in places:
            low, high = max(0, start - margin), min(len(words), start + len(item) + margin)
            if high <= reach:
                continue
            reach = high + margin
            high = min(len(words), reach)
            # Words of the item that the stretch has not are an edit each.
            if (Counter(item) - Counter(words[low:high])).total() > limit:
                continue
            distance, a, b = best_stretch(item, words[low:high])
            if distance <= limit and (best is None or distance < best[0]):
                best = distance, low + a, low + b
                if not distance:
                    break
        return best


def searchers(
    benchmark: DataFrame, scratch: Scratch, errors: int, item_key: str, item_text: str
) -> Iterator[Searcher]:
    """A searcher per block of items; at most about ``BLOCK`` items come to the driver at once."""
    embedding = Embedding()
    named = benchmark.select(F.col(item_key).cast("long").alias("i"), F.col(item_text).alias("t"))
    stored = scratch.save(named.where("t is not null").distinct(), "items")
    blocks = max(1, -(-stored.count() // BLOCK))
    for b in range(blocks):
        mine = F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b
        rows = [(r["i"], r["t"].encode()) for r in stored.where(mine).collect()]
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield Searcher(prepare(rows, embedding, errors), embedding)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, errors: int = ERRORS,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document and item it holds: distance and the stretch, in words, nearest to it."""

    def search(searcher: Searcher) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bench = searcher.bench
            for batch in slices(batches, 1):
                ids = batch.column(0).cast(pa.int64()).to_pylist()
                out = [
                    (ids[t], bench.ids[k], distance, start, end, len(bench.items[k]))
                    for t, k, distance, start, end in searcher.hits(texts_of(batch.column(1)))
                ]
                columns = list(zip(*out)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    ["doc_id", "item_id", "distance", "start", "end", "item_words"],
                )

        return scratch.save(docs.select(key, text).mapInArrow(run, HITS), "hits")

    parts = [search(s) for s in searchers(benchmark, scratch, errors, item_key, item_text)]
    return reduce(DataFrame.unionByName, parts)


def clean(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, errors: int = ERRORS,
    text: str = "text", item_key: str = "item_id", item_text: str = "text", least_words: int = 1,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item of ``least_words`` words or more."""
    place = docs.columns.index(text)

    def without_items(rest: DataFrame, searcher: Searcher) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, place):
                hits = searcher.hits(texts_of(batch.column(place)))
                held = {t for t, k, *_ in hits if len(searcher.bench.items[k]) >= least_words}
                yield batch.filter(pa.array([t not in held for t in range(batch.num_rows)], pa.bool_()))

        return rest.mapInArrow(run, docs.schema)

    rest, before = docs, None
    for number, searcher in enumerate(searchers(benchmark, scratch, errors, item_key, item_text)):
        if number:  # a task holds one block, so what the last one left is written first
            saved = scratch.save(rest, "rest")
            if before is not None:
                scratch.drop(before)
            rest = before = saved
        rest = without_items(rest, searcher)
    return rest
