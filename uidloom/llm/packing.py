"""Word-aligned packing of ids: each 64-bit word has a 4-bit selector and 60 bits that hold as many ids as fit.

A selector says how many ids of how many bits a word holds. Selector 0 is the escape: the next word is one raw
64-bit id, for ids of more than 60 bits. Ids are packed in blocks of a fixed count; a word never crosses a
block, the last word of a block may be partly unused, and the word offsets of the blocks are stored beside them,
so blocks can be decoded on their own and all words of one selector at once.
"""

from __future__ import annotations

import numpy as np

BLOCK_IDS = 1024
STRIDE = BLOCK_IDS + 60
#: Ids per word and bits per id of the selectors 1 to 14; fixed values of the format.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs, 1 at least."""
    if len(ids) and int(ids.max()) >> 52 == 0:
        return np.maximum(np.frexp(ids.astype(np.float64))[1], 1).astype(np.uint8)
    high = ids >> np.uint64(32)
    halves = (np.frexp(x.astype(np.float64))[1] for x in (high, ids & np.uint64(0xFFFFFFFF)))
    return np.maximum(np.where(high != 0, next(halves) + 32, next(halves)), 1).astype(np.uint8)


def _padded(ids: np.ndarray) -> np.ndarray:
    """The ids by block, each block followed by zeros for the unused part of its last word."""
    blocks = -(-len(ids) // BLOCK_IDS)
    full = len(ids) // BLOCK_IDS
    out = np.zeros((blocks, STRIDE), ids.dtype)
    out[:full, :BLOCK_IDS] = ids[: full * BLOCK_IDS].reshape(full, BLOCK_IDS)
    out[full:, : len(ids) - full * BLOCK_IDS] = ids[full * BLOCK_IDS :]
    return out


def _selectors(ids: np.ndarray) -> np.ndarray:
    """Per id the selector of the fullest word that can start there, blocks apart.

    A selector that fits implies that all later ones fit, as these hold fewer ids of more bits. So blocks in which
    one fits nowhere need no look at those before it.
    """
    widest, count = _padded(_widths(ids)), 1
    fitting = (widest <= int(BITS[-1])).astype(np.uint8)
    blocks = np.arange(len(widest))
    for selector in range(len(COUNTS) - 2, 0, -1):
        step = int(COUNTS[selector]) - count
        while step:  # from the widest of `count` ids to the widest of more; beyond the block ids take no bits
            reach = min(step, count)
            widest[:, :-reach] = np.maximum(widest[:, :-reach], widest[:, reach:])
            count, step = count + reach, step - reach
        fits = widest <= int(BITS[selector])
        some = fits[:, :BLOCK_IDS].any(axis=1)
        if not some.all():
            blocks, widest, fits = blocks[some], widest[some], fits[some]
            if not len(blocks):
                break
        fitting[blocks] += fits
    return np.where(fitting, len(COUNTS) - fitting, 0)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, and the word offset of each block with the total as last entry."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int32)
    chosen = _selectors(ids)
    blocks = len(chosen)
    place = np.arange(blocks) * STRIDE
    end = place + BLOCK_IDS
    end[-1] += n - blocks * BLOCK_IDS
    after = np.minimum(np.arange(chosen.size).reshape(chosen.shape) + COUNTS[chosen], end[:, None]).reshape(-1)
    chosen, starts = chosen.reshape(-1), []
    while (place != end).any():
        for _ in range(16):  # one word of each block; those at their end stay there
            starts.append(place)
            place = after[place]
    starts = np.stack(starts, axis=1)
    start = starts[starts < end[:, None]]
    selector = chosen[start]
    padded = _padded(ids).reshape(-1)
    long = selector == 0
    at = np.arange(len(start)) + np.cumsum(long) - long
    words = np.zeros(len(start) + int(long.sum()), np.uint64)
    words[at[long] + 1] = padded[start[long]]
    for s in np.flatnonzero(np.bincount(selector)).tolist():
        if s:
            here = np.flatnonzero(selector == s)
            first = start[here]
            word = np.full(len(here), s, np.uint64)
            for k in range(int(COUNTS[s])):
                word |= padded[first + k] << np.uint64(4 + k * int(BITS[s]))
            words[at[here]] = word
    offsets = np.zeros(blocks + 1, np.int32)
    owner = start // STRIDE
    np.cumsum(np.bincount(owner, minlength=blocks) + np.bincount(owner[long], minlength=blocks), out=offsets[1:])
    return words, offsets


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """All ids of some packed blocks, ``n`` in total, every block but the last one full."""
    if not n:
        return np.zeros(0, np.uint64)
    blocks = len(offsets) - 1
    out = np.zeros(blocks * STRIDE, np.uint64)
    selector = (words & np.uint64(15)).astype(np.uint8)
    heads = np.arange(len(words))
    if not selector.all():
        raw = np.zeros(len(words), bool)  # words that an escape announces
        for i in np.flatnonzero(selector == 0).tolist():
            raw[i + 1 : i + 2] = not raw[i]
        heads = np.flatnonzero(~raw)
        selector = selector[heads]
    count = COUNTS[selector]
    before = np.concatenate(([0], np.cumsum(count)))
    first = np.searchsorted(heads, offsets)
    shift = np.arange(blocks) * STRIDE - before[first[:-1]]
    start = before[:-1] + np.repeat(shift, np.diff(first))
    for s in np.flatnonzero(np.bincount(selector)).tolist():
        here = np.flatnonzero(selector == s)
        if s == 0:
            out[start[here]] = words[heads[here] + 1]
            continue
        word, place = words[heads[here]] >> np.uint64(4), start[here]
        bits = np.uint64(BITS[s])
        mask = np.uint64((1 << int(bits)) - 1)
        for _ in range(int(COUNTS[s])):
            out[place] = word & mask
            word >>= bits
            place += 1
    return out.reshape(blocks, STRIDE)[:, :BLOCK_IDS].reshape(-1)[:n]
