from __future__ import annotations

import random
import re
from collections import Counter

from tests.llm.data import edited, frame, odd_rows, sentence
from uidloom.llm import decontaminate

LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def runs(words):
    return [tuple(words[k : k + 5]) for k in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []


def expected(docs, items, percent=80):
    out = {}
    for n, (doc_id, text) in enumerate(docs):
        words = words_of(text)
        for m, (item_id, item) in enumerate(items):
            item = words_of(item)
            size = min(len(item), len(words))
            best = (0.0, 0)
            for s in range(len(words) - size + 1) if size else ():
                a, b = Counter(runs(words[s : s + size])), Counter(runs(item))
                alike = sum((a & b).values()) / sum((a | b).values())
                if alike > best[0]:
                    best = (alike, s)
            if 100 * best[0] >= percent - 1e-9:
                out[n, m] = (doc_id, item_id, round(best[0], 9), best[1], len(item))
    return sorted(out.values(), key=repr)


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")


def check(spark, docs, items):
    found = decontaminate.matches(frame(spark, docs), benchmark(spark, items)).collect()
    got = sorted(((r[0], r[1], round(r[2], 9), r[3], r[4]) for r in map(tuple, found)), key=repr)
    want = expected(docs, items)
    assert got == want
    return want


def corpus(seed):
    rng = random.Random(seed)
    items = [(k, " ".join(sentence(rng, rng.choice([2, 4, 5, 18, 18, 30, 59])))) for k in range(25)]
    items += [(90, None), (91, ""), (92, items[3][1]), (None, items[4][1])]
    docs = []
    for k in range(120):
        words = sentence(rng, rng.randint(0, 80))
        if k % 2:
            item = words_of(rng.choice(items[:25])[1])
            at = rng.randint(0, len(words))
            words[at:at] = edited(rng, item, rng.choice([0, 0, 0, 1, 2])) if len(item) > 20 else item
        docs.append((k, " ".join(words).upper() if k % 5 == 0 else "\n".join(words)))
    return docs, items


def test_planted_items_against_all_windows(spark):
    docs, items = corpus(1)
    assert len(check(spark, docs, items)) > 30


def test_items_in_several_blocks(spark, monkeypatch):
    docs, items = corpus(2)
    whole = check(spark, docs, items)
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 4)
    assert check(spark, docs, items) == whole


def test_filter_keeps_rows_whole(spark):
    docs, items = corpus(3)
    dirty = {r[0] for r in expected(docs, items)}
    kept = decontaminate.without_matches(frame(spark, docs), benchmark(spark, items))
    assert kept.columns == frame(spark, docs[:1]).columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - dirty


def test_odd_rows_and_no_items(spark):
    check(spark, [r for r in odd_rows() if not r[1] or len(r[1]) < 1000], corpus(1)[1][:3] + [(7, "other text of the same id here")])
    assert decontaminate.matches(frame(spark, odd_rows()[:4]), benchmark(spark, [(1, "a")]).where("item_id = 2")).collect() == []
    assert decontaminate.matches(frame(spark, [(1, "a")]).where("doc_id = 2"), benchmark(spark, [(1, "a")])).collect() == []
    assert decontaminate.without_matches(frame(spark, odd_rows()), benchmark(spark, [(1, None)])).count() == len(odd_rows())


def test_block_look_ups_find_all_within_the_radius():
    import numpy as np

    index = decontaminate.ItemIndex([(1, " ".join(sentence(random.Random(1), 30)))])
    rng = np.random.default_rng(1)
    for _ in range(300):
        flips = sum(1 << int(b) for b in rng.choice(64, decontaminate.RADIUS, replace=False))
        window, item = index.candidates(30, index.prints ^ np.uint64(flips))
        assert window.tolist() == [0] and item.tolist() == [0]
