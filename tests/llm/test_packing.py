from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from uidloom.llm.packing import BITS, BLOCK_IDS, COUNTS, pack, unpack


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=3000))
def test_round_trip(ids):
    words, offsets = pack(np.array(ids, np.uint64))
    assert unpack(words, offsets, len(ids)).tolist() == ids
    assert offsets[-1] == len(words)


@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, BLOCK_IDS - 1, BLOCK_IDS, BLOCK_IDS + 1, 3 * BLOCK_IDS])
@pytest.mark.parametrize("value", [0, 1, 50_256, 2**60 - 1, 2**60, 2**64 - 1])
def test_block_edges_and_escapes(n, value):
    ids = np.full(n, value, np.uint64)
    words, offsets = pack(ids)
    assert (unpack(words, offsets, n) == ids).all()
    if value == 2**64 - 1:
        assert len(words) == 2 * n


def test_blocks_decode_on_their_own():
    ids = np.random.default_rng(1).integers(0, 50_257, 5000).astype(np.uint64)
    words, offsets = pack(ids)
    for k in range(len(offsets) - 1):
        own = ids[k * BLOCK_IDS : (k + 1) * BLOCK_IDS]
        part = words[offsets[k] : offsets[k + 1]]
        assert (unpack(part, np.array([0, len(part)]), len(own)) == own).all()


def test_selectors_fill_the_sixty_bits():
    assert all(c * b <= 60 and (c + 1) * b > 60 for c, b in zip(COUNTS[1:].tolist(), BITS[1:].tolist()))


def test_small_ids_take_few_words():
    assert len(pack(np.zeros(600, np.uint64))[0]) == 10
