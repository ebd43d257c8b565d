from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tests.llm.data import edited, frame, odd_rows, sentence
from uidloom.llm import repeats


def expected(rows):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            piece = data[k : k + 100]
            gone[k : k + 100] |= piece in seen
            seen.add(piece)
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[:1].sum())
        rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc_id or -1, len(data), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def check(spark, rows):
    found = repeats.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r[0] or -1, *r[1:]) for r in map(tuple, found)) == expected(rows)


@pytest.mark.parametrize("many", [4096, 2])
def test_passages_against_all_strings(spark, monkeypatch, many):
    monkeypatch.setattr(repeats, "MANY", many)
    rng = random.Random(many)
    passages = [" ".join(sentence(rng, rng.randint(20, 60))) for _ in range(6)]
    rows = []
    for k in range(1, 70):
        parts = [" ".join(sentence(rng, rng.randint(0, 30))) for _ in range(3)]
        middle = rng.choice(passages).split(" ")
        rows.append((k, "\n".join([parts[0], " ".join(edited(rng, middle, rng.choice([0, 0, 1, 2]))), parts[1], rng.choice(passages)[:150], parts[2]])))
    rows += [(100 + k, rows[k % 5][1]) for k in range(12)]
    check(spark, rows)


def test_strings_that_overlap_themselves(spark):
    rows = [(1, "a" * 500), (2, "ab" * 90 + "a" * 120), (3, "xyz " * 60), (4, "a" * 99), (5, "a" * 100), (6, "é" * 80)]
    check(spark, rows)


def test_exact_lengths_at_the_limit(spark):
    rng = random.Random(3)
    core = "".join(rng.choice("abcdefgh ") for _ in range(100))
    rows = [(1, "left " + core + " right"), (2, "other" + core + "more"), (3, core), (4, core[:99] + "!"), (5, "?" + core[1:])]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [r for r in odd_rows() if not r[1] or len(r[1]) < 1000]
    rng = random.Random(1)
    text = " ".join(sentence(rng, 100))
    check(spark, rows + [(30, text), (30, text), (30, text + " x"), (None, text), (31, text), (29, text[50:])])


def test_no_rows(spark):
    assert repeats.remove_repeats(frame(spark, [(1, "a")]).where("doc_id = 2")).collect() == []


def test_neighbours_share_their_gram():
    import pyarrow as pa

    from uidloom.llm import textops

    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgh") for _ in range(130))
    texts = ["".join(rng.choice("abcdefgh") for _ in range(n)) + shared + "x" * n for n in (0, 7, 50, 113)]
    chunk = next(textops.chunks(pa.array(texts)))
    text, gram, at, first, last, _ = repeats.anchors(chunk)
    for k, t in enumerate(texts):
        own = text == k
        assert (last[own] - first[own] + 1).sum() == len(t) - 99  # each suffix has one row
    found = []
    for k, t in enumerate(texts):
        start = t.index(shared)
        own = (text == k) & (first <= start + 30) & (last >= start)
        found.append({(int(g), int(a) - start) for g, a in zip(gram[own], at[own])})
    assert all(f == found[0] for f in found)


def test_rows_without_an_id_are_not_gathered(spark, monkeypatch):
    kept, write = {}, repeats.materialize

    def spy(df, name):
        kept[name] = write(df, name)
        return kept[name]

    monkeypatch.setattr(repeats, "materialize", spy)
    rng = random.Random(7)
    passage = " ".join(sentence(rng, 60))
    rows = [(None if k % 3 else 5, f"{' '.join(sentence(rng, 20))} {passage} {k}") for k in range(120)]
    rows += [(None, passage)] * 40 + [(None, None), (5, None), (6, passage), ((1 << 63) - 1, passage)]
    check(spark, rows)
    assert kept["copies"].count() == 41  # a row for each copy, not a list for each id
    keyed = repeats._keyed(frame(spark, rows)).repartition(8, "doc", "dup")
    found = keyed.selectExpr("spark_partition_id() AS p", "doc_id", "doc", "dup", "text").where("doc_id IS NULL").collect()
    assert len({r["p"] for r in found}) == 8
    found.sort(key=lambda r: r["dup"])
    assert [r["text"] or "" for r in found] == sorted(r["text"] or "" for r in found)
    assert [r["dup"] for r in found] == list(range(1, len(found) + 1))  # after the row with the largest id
