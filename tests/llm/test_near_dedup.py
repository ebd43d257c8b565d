from __future__ import annotations

import random
import re

import pytest

from tests.llm.data import edited, frame, odd_rows, sentence
from uidloom.llm import near_dedup

LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def expected(rows, percent):
    """All pairs compared; rows with one id are one node; rows without an id are left out."""
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    above = {d: d for d, _ in sets}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(a), root(b)
                above[max(p, q)] = min(p, q)
    return {d: root(d) for d in above}


def check(spark, rows, percent=85):
    found = near_dedup.near_duplicates(frame(spark, rows), percent).collect()
    real = expected(rows, percent)
    assert len(found) == len(rows)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found]
    want = [(d, len(shingles(t)), None if d is None else real[d], d is None or real[d] == d) for d, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def corpus(seed, families=30, size=6, words=60):
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = sentence(rng, rng.randint(5, words))
        for _ in range(rng.randint(1, size)):
            rows.append(" ".join(edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3]))))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("percent", [80, 85])
def test_families_against_all_pairs(spark, percent):
    check(spark, corpus(percent), percent)


def test_large_clusters_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE_ROWS", 8)
    rng = random.Random(4)
    base = sentence(rng, 80)
    rows = [" ".join(edited(rng, base, rng.choice([0, 1, 1, 2, 3, 4]))) for _ in range(160)]
    check(spark, list(enumerate(rows)))


def test_chains_link_what_is_not_alike(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE_ROWS", 4)
    words, rows = sentence(random.Random(7), 100), []
    for k in range(20):
        words = words[:4 * k] + [f"n{k}{j}" for j in range(1)] + words[4 * k + 1:]
        rows.append((40 - k, " ".join(words)))
    check(spark, rows)


def test_odd_rows(spark):
    check(spark, odd_rows())


def test_no_rows(spark):
    assert near_dedup.near_duplicates(frame(spark, [(1, "a")]).where("doc_id = 2")).collect() == []


def test_pairs_within_the_radius_share_a_key():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, near_dedup.COMPONENTS, dtype=np.uint16)
        b = a.copy()
        at = rng.choice(near_dedup.COMPONENTS, near_dedup.RADIUS, replace=False)
        b[at] ^= np.uint16(1)
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([a.tobytes(), b.tobytes()])], names=["doc_id", "signature"])
        assert not near_dedup._keys_of(batch)[2].all()


def test_words_that_cancel_out_modulo_powers_of_two_are_not_linked(spark):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    found = near_dedup.near_duplicates(frame(spark, [(1, word), (2, other), (3, other)])).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {1: 1, 2: 2, 3: 2}
