"""Benchmark decontamination by SimHash over windows of the size of each item.

1. An item's shingles are its five-word runs with their counts as weights; an item of fewer words is one shingle. Every
   window of as many words in a document is compared with it; a document shorter than an item is one window.
2. Windows that hold no shingle of any item have similarity 0 and are passed over. The others get a 64-bit SimHash
   from running sums of the bits of their shingles.
3. The 64 bits are cut into five blocks. The index holds, for each item and block, every value with at most three
   changed bits, so by the pigeonhole principle a look-up of the five blocks of a window finds every item
   whose fingerprint differs in at most 19 bits. At similarity 0.8 a window has 10 such bits on average, and more
   than 19 with a probability below one in a thousand; one window among its neighbours is enough.
4. The candidates are confirmed by the exact weighted similarity of the shingles, sum of minima over sum of maxima.

The items are read in blocks of bounded size, each sent to all tasks with its index.

Defined results: null and empty items and texts match nothing; rows without an id are checked as well and carry a
null id; repeated documents and items each give their rows; of equally similar windows the first counts; very
long texts are read whole. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from uidloom.llm import textops

SHINGLE_WORDS = 5
PERCENT = 80
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
"""First bit and number of bits of each block."""
BLOCK_ERRORS = 3
RADIUS = len(BLOCKS) * (BLOCK_ERRORS + 1) - 1
ITEMS_AT_ONCE = 2048
BYTES_AT_ONCE = 1 << 22
MATCHES = "doc_id bigint, item_id bigint, similarity double, first_word bigint, n_words bigint"


def _changes(bits: int) -> np.ndarray:
    """All patterns of at most ``BLOCK_ERRORS`` set bits."""
    return np.array([sum(1 << b for b in which) for k in range(BLOCK_ERRORS + 1) for which in combinations(range(bits), k)], np.uint64)


def grams(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = len(word_hashes)
    out = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size if len(out) else 0):
        out = out * np.uint64(0x2545F4914F6CDD1D) + word_hashes[k : k + len(out)]
    return textops.mix(out + np.uint64(size))


def _running_bits(shingles: np.ndarray) -> np.ndarray:
    """Sums of the bits, each as one up or down, of the shingles before each place."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits.astype(np.int8) * 2 - 1, axis=0, dtype=np.int32, out=out[1:])
    return out


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").reshape(-1)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted similarity of two lists of shingles."""
    keys, which = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = np.bincount(which[: len(a)], minlength=len(keys)), np.bincount(which[len(a) :], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum()) if len(keys) else 0.0


class ItemIndex:
    """Items with their block index: entries are sorted by (words, block, value)."""

    def __init__(self, items: list[tuple[int | None, str]], percent: int = PERCENT):
        self.percent = percent
        self.ids, self.shingles, words, prints = [], [], [], []
        for item_id, text in items:
            _, _, hashes, _ = textops.words(next(textops.chunks(pa.array([text], pa.string()))))
            if len(hashes):
                own = grams(hashes, min(SHINGLE_WORDS, len(hashes)))
                self.ids.append(item_id)
                self.shingles.append(own)
                words.append(len(hashes))
                prints.append(int(_fingerprints(_running_bits(own)[-1:])[0]))
        self.words, self.prints = np.array(words, np.int64), np.array(prints, np.uint64)
        self.lengths = np.unique(self.words)
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for k, (first, bits) in enumerate(BLOCKS):
            changes = _changes(bits)
            values = (self.prints >> np.uint64(first)) & np.uint64((1 << bits) - 1)
            keys.append((self._base(self.words, k)[:, None] | (values[:, None] ^ changes)).reshape(-1))
            owners.append(np.repeat(np.arange(len(values)), len(changes)))
        order = np.argsort(np.concatenate(keys), kind="stable")
        self.keys, self.owners = np.concatenate(keys)[order], np.concatenate(owners)[order]
        self.known = {
            size: textops.KeySet(np.concatenate([s for s, w in zip(self.shingles, words) if min(w, SHINGLE_WORDS) == size]))
            for size in {min(w, SHINGLE_WORDS) for w in words}
        }

    @staticmethod
    def _base(words: np.ndarray, block: int) -> np.ndarray:
        return words.astype(np.uint64) << np.uint64(20) | np.uint64(block << 16)

    def candidates(self, n_words: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, item) with at most ``RADIUS`` differing bits, for windows against items of ``n_words``."""
        pairs = []
        for k, (first, bits) in enumerate(BLOCKS):
            key = self._base(np.array([n_words]), k) | (prints >> np.uint64(first)) & np.uint64((1 << bits) - 1)
            low, high = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, side="right")
            count = high - low
            window = np.repeat(np.arange(len(prints)), count)
            entry = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + low[window]
            pairs.append(window * len(self.ids) + self.owners[entry])
        both = np.unique(np.concatenate(pairs))
        window, item = both // len(self.ids), both % len(self.ids)
        near = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[near], item[near]

    def in_text(self, hashes: np.ndarray, hits: dict[int, np.ndarray], first_only: bool = False) -> dict[int, tuple[float, int]]:
        """Per matching item its best similarity and window start, given where known shingles start in the text."""
        found: dict[int, tuple[float, int]] = {}
        own = {size: grams(hashes, size) for size in hits}
        sums = {size: _running_bits(g) for size, g in own.items()}
        for n_words in self.lengths.tolist():
            size = min(n_words, SHINGLE_WORDS)
            if size not in hits or len(hashes) < size:
                continue
            length = min(n_words, len(hashes)) - size + 1  # shingles in a window
            held = np.zeros(len(own[size]) + 1, np.int32)
            held[hits[size] + 1] = 1
            held = np.cumsum(held)
            start = np.flatnonzero(held[length:] > held[:-length])
            if not len(start):
                continue
            window, item = self.candidates(n_words, _fingerprints(sums[size][start + length] - sums[size][start]))
            for s, i in zip(start[window].tolist(), item.tolist()):
                alike = similarity(own[size][s : s + length], self.shingles[i])
                if 100 * alike >= self.percent - 1e-9 and alike > found.get(i, (0.0, 0))[0]:
                    found[i] = (alike, s)
                    if first_only:
                        return found
        return found

    def in_texts(self, texts: textops.Texts, first_only: bool = False) -> Iterator[tuple[int, dict[int, tuple[float, int]]]]:
        """The texts that match any item, each with its matches."""
        _, _, hashes, first = textops.words(texts)
        places = {size: known.find(grams(hashes, size))[0] for size, known in self.known.items()}
        last = {size: np.searchsorted(first, at, side="right") - 1 for size, at in places.items()}
        whole = {size: at[at + size <= first[last[size] + 1]] for size, at in places.items()}  # within one text
        touched = np.unique(np.concatenate([np.searchsorted(first, at, side="right") - 1 for at in whole.values()] or [np.zeros(0, np.int64)]))
        for k in touched.astype(np.int64).tolist():
            a, b = int(first[k]), int(first[k + 1])
            hits = {size: at[(at >= a) & (at < b)] - a for size, at in whole.items()}
            matches = self.in_text(hashes[a:b], hits, first_only)
            if matches:
                yield k, matches


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of bounded count and bytes; the driver holds one partition of items at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("bigint"), "text").where("text IS NOT NULL").toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1])
        if len(block) >= ITEMS_AT_ONCE or size >= BYTES_AT_ONCE:
            yield block
            block, size = [], 0
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document and item of at least ``percent`` similarity, with the place of the best window."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    result = spark.createDataFrame([], MATCHES)
    for block in item_blocks(benchmark):
        held = spark.sparkContext.broadcast(ItemIndex(block, percent))

        def find(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held.value
            for batch in batches:
                out: list[list] = [[], [], [], [], []]
                for texts in textops.chunks(batch.column(1)):
                    for k, found in index.in_texts(texts):
                        for item, (alike, start) in found.items():
                            row = (batch.column(0)[texts.first + k].as_py(), index.ids[item], alike, start, int(index.words[item]))
                            for column, value in zip(out, row):
                                column.append(value)
                types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, types)], names=["doc_id", "item_id", "similarity", "first_word", "n_words"]
                )

        result = result.unionByName(rows.mapInArrow(find, MATCHES))
    return result


def _leak_finder(held):
    """A function of a text column that says whether the text matches an item of the broadcast index."""

    @arrow_udf("boolean")
    def leaks(text: pa.Array) -> pa.Array:
        out = np.zeros(len(text), bool)
        for texts in textops.chunks(text):
            for k, _ in held.value.in_texts(texts, first_only=True):
                out[texts.first + k] = True
        return pa.array(out)

    return leaks


def without_matches(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that match no item, with all their columns."""
    for block in item_blocks(benchmark):
        leaks = _leak_finder(docs.sparkSession.sparkContext.broadcast(ItemIndex(block, percent)))
        docs = docs.where(~leaks("text"))
    return docs
