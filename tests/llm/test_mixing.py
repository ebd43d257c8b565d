from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.data import frame, odd_rows, sentence
from uidloom.llm import mixing


def targets_by_rounds(sizes: dict, weights=(5, 2, 1), most=3):
    """Share by weight; fill what is above its cap; share the rest again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in full]
        rest = total - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        above = [s for s in left if share[s] > most * sizes[s] + 1e-9]
        if not above:
            return full | share
        full |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_taken_words(spark, seed):
    rng = random.Random(seed)
    sources = ["a", "b", "ä", "Z", None, "z"][: 2 + seed]
    rows = [(k, " ".join(sentence(rng, rng.randint(0, 30))), rng.choice(sources + sources[:1] * 6)) for k in range(1500)]
    found = mixing.mix(frame(spark, rows)).toPandas()
    size = {k: len(t.split()) for k, t, _ in rows}
    by_source: dict = {}
    for k, _, s in rows:
        by_source[s] = by_source.get(s, 0) + size[k]
    expected = targets_by_rounds(by_source)
    source_of = {k: s for k, _, s in rows}
    assert dict(zip(found.doc_id, found["size"])) == size
    taken: dict = {}
    for row in found.itertuples():
        s = source_of[row.doc_id]
        assert row.source_size == by_source[s]
        assert row.target == pytest.approx(expected[s])
        assert row.taken % max(row.size, 1) == 0 and row.taken <= 3 * row.size
        taken[s] = taken.get(s, 0) + row.taken
    assert sum(expected.values()) == pytest.approx(sum(size.values()))
    for s in taken:
        assert abs(taken[s] - expected[s]) <= 31
    again = mixing.mix(frame(spark, rows).repartition(5)).toPandas()
    assert dict(zip(found.doc_id, found.taken)) == dict(zip(again.doc_id, again.taken))


def test_rounding_keeps_the_words_and_is_fair():
    rng = np.random.default_rng(1)
    sizes, keys = rng.integers(1, 50, 400), rng.integers(-(2**62), 2**62, 400)
    total = np.zeros(400)
    for k in range(300):
        out = mixing.round_in_pairs(sizes, np.full(400, 0.3), keys + k * 7919)
        open_rows = (out > 0) & (out < 1)
        assert open_rows.sum() <= 1
        assert (out * sizes).sum() == pytest.approx(0.3 * sizes.sum(), rel=1e-6)
        total += out
    assert abs(total.mean() / 300 - 0.3) < 0.03 and total.min() > 30


def test_levels_of_the_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 4)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rows = [(k, "w " * (1 + k % 7), "s" if k % 3 else "t") for k in range(300)]
    found = mixing.mix(frame(spark, rows)).toPandas()
    assert len(found) == 300
    for _, part in found.groupby("target"):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 7


def test_odd_rows_and_repeats(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    taken = mixing.mix(docs)
    found = taken.collect()
    assert len(found) == len(rows)
    assert all(r["size"] == 0 and r["taken"] == 0 for r in found if r["doc_id"] in (1, 2, 3))
    repeated = mixing.repeat_rows(docs, taken, ["doc_id", "text", "source"]).collect()
    assert len(repeated) == sum(r["copies"] for r in found)


def test_no_rows(spark):
    empty = frame(spark, [(1, "a")]).where("doc_id = 2")
    assert mixing.mix(empty).collect() == []


def test_rows_that_differ_in_other_columns_only_get_the_copies_of_the_mix(spark):
    same = [(7, "one two three", lang, "s", k) for k, lang in enumerate(["en", "en", "de", "fr", "es", "it", None, "nl"])]
    other = [(8, "four five", "en", "t", 1)] * 3 + [(9, "six seven eight nine", "en", "t", 1)]
    df = spark.createDataFrame(same + other, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    taken = mixing.mix(df)
    rows = mixing.repeat_rows(df, taken, ("doc_id", "text", "lang", "source", "n_chars")).collect()
    copies = {d: sum(r["copies"] for r in taken.where(f"doc_id = {d}").collect()) for d in (7, 8, 9)}
    assert {d: sum(r["doc_id"] == d for r in rows) for d in (7, 8, 9)} == copies
