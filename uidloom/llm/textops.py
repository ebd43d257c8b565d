"""Vectorised work on the texts of an Arrow batch: words, shingles and their 64-bit hashes, in bounded chunks.

Texts are handled as UTF-8 bytes in one buffer. A word is a run of bytes other than space and the control
characters 9 to 13; a word never crosses the end of its text.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
"""Bytes of text worked on at once; a longer text makes a chunk of its own."""

_BASE = np.uint64(0x9E3779B97F4A7C15 & ~2 | 5)
_MASK = (1 << 64) - 1
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
BYTE_CODES = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_LETTER = np.zeros(256, bool)
IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64, kept for the next call."""
    table = _powers.get(int(base))
    if table is None or len(table) < n:
        size = max(CHUNK_BYTES + 1, 1 << int(n - 1).bit_length())
        table = np.full(size, base, np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        _powers[int(base)] = table
    return table[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Texts:
    """Some whole texts of a batch: ``data`` holds their bytes, text ``i`` is ``data[ends[i]:ends[i + 1]]``."""

    def __init__(self, first: int, data: np.ndarray, ends: np.ndarray):
        self.first, self.data, self.ends = first, data, ends

    def __len__(self) -> int:
        return len(self.ends) - 1


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Cut a string column into runs of whole texts of about ``most`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_string() if not pa.types.is_large_binary(column.type) else pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + most, side="right")) - 1)
        high = min(high, n)
        yield Texts(low, data[ends[low] : ends[high]], ends[low : high + 1] - ends[low])
        low = high


def prefix_hashes(data: np.ndarray, base: np.uint64 = _BASE, codes: np.ndarray = BYTE_CODES) -> np.ndarray:
    """Running sums of the coded bytes times powers of the base; two entries give the hash of any stretch."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(codes[data] * powers(base, len(data)), out=sums[1:])
    return sums


def stretch_hashes(
    sums: np.ndarray, start: np.ndarray, end: np.ndarray, inverse: np.uint64 = _INVERSE
) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(inverse, len(sums))[start])


LONG_BYTES = 32
"""Longer stretches are not told apart by ``stretch_hashes`` alone: modulo a power of two, some patterns of two
letters cancel out whatever the base is, the more the longer they are."""


def sure_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``stretch_hashes``, with a cryptographic hash of the bytes for long stretches."""
    hashes = stretch_hashes(prefix_hashes(data), start, end)
    long = np.flatnonzero(end - start > LONG_BYTES)
    if len(long):
        raw = memoryview(np.ascontiguousarray(data)).cast("B")
        for k, a, b in zip(long.tolist(), start[long].tolist(), end[long].tolist()):
            hashes[k] = int.from_bytes(blake2b(raw[a:b], digest_size=8).digest(), "little")
    return hashes


def words(texts: Texts, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte and hash of each word, and the first word of each text (one entry more than texts)."""
    data = LOWER[texts.data] if lower else texts.data
    space = IS_SPACE[data]
    n = len(data)
    before = np.empty(n + 1, bool)  # whether a word may start at a byte
    before[0] = True
    before[1:] = space
    before[texts.ends] = True
    start = np.flatnonzero(~space & before[:n])
    end = np.flatnonzero(~space & np.concatenate((space[1:] | before[1:n], [True]))[:n]) + 1 if n else start
    first = np.searchsorted(start, texts.ends)
    return start, end, sure_hashes(data, start, end), first


_STEP = np.uint64(0x2545F4914F6CDD1D)


def shingle_sets(word_hashes: np.ndarray, first: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles; a text with fewer words is one shingle, or none."""
    n = len(word_hashes)
    grams = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size if len(grams) else 0):
        grams *= _STEP
        grams += word_hashes[k : k + len(grams)]
    grams = mix(grams + np.uint64(size))
    out = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= size:
            out.append(np.unique(grams[low : high - size + 1]))
        elif high > low:
            whole = 0
            for h in word_hashes[low:high].tolist():
                whole = (whole * int(_STEP) + h) & _MASK
            out.append(mix(np.array([(whole + high - low) & _MASK], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


# Kinds of bytes in text tokens: a token is a run of word bytes or a run of ASCII marks.
GAP, WORD, MARK = range(3)
_KIND = np.full(256, MARK, np.uint8)
_KIND[:33] = GAP
_KIND[127] = GAP
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = WORD


class Tokens:
    """Word and mark tokens: start and end bytes, hashes in lower case, whether a word, first token of each text."""

    def __init__(self, texts: Texts):
        data = texts.data
        kind = _KIND[data]
        n = len(data)
        change = np.ones(n, bool)
        change[1:] = kind[1:] != kind[:-1]
        change[texts.ends[:-1][texts.ends[:-1] < n]] = True
        at = np.flatnonzero(change)
        kinds = kind[at]
        real = kinds != GAP
        self.start = at[real]
        self.end = np.append(at[1:], n)[real]
        self.is_word = kinds[real] == WORD
        self.hash = stretch_hashes(prefix_hashes(LOWER[data]), self.start, self.end)
        self.first = np.searchsorted(self.start, texts.ends)
        self.data = data

    def of_text(self) -> np.ndarray:
        """The text of each token."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def hash_word(word: str) -> int:
    """The hash of one token, as in ``Tokens``."""
    data = LOWER[np.frombuffer(word.encode(), np.uint8)]
    return int(stretch_hashes(prefix_hashes(data), np.array([0]), np.array([len(data)]))[0])


class KeySet:
    """Finds a few hashes among many: most of the many fail a bit test first."""

    BITS = 20

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(np.asarray(keys, np.uint64))
        self.bits = np.zeros(1 << self.BITS, bool)
        self.bits[self.keys >> np.uint64(64 - self.BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` of members, and which member each is."""
        maybe = np.flatnonzero(self.bits[hashes >> np.uint64(64 - self.BITS)])
        if not len(self.keys):
            return maybe[:0], maybe[:0]
        at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        sure = self.keys[at] == hashes[maybe]
        return maybe[sure], at[sure]


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Cut a stream sorted by its first ``keys`` columns into tables of rows with equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.zeros(n, bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        if held:
            new[0] = any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in range(keys))
        cuts = [*np.flatnonzero(new).tolist(), n]
        low = 0
        for cut in cuts[:-1]:
            if cut > low:
                held.append(batch.slice(low, cut - low))
            if held:
                yield pa.Table.from_batches(held)
            held, low = [], cut
        held.append(batch.slice(low))
    if held:
        yield pa.Table.from_batches(held)
