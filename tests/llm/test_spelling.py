from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.data import frame, odd_rows
from uidloom.llm import spelling


def words_of(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            n[word] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def brute(rows):
    n = words_of(rows)
    found, form = {}, {}
    for w in n:
        found[w] = [v for v in n if near(w, v)]
        best = min(found[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(found[w]), n.get(form[w])))
    return sorted(out)


def got(spark, rows):
    df = spelling.spelling_variants(frame(spark, rows))
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def changed(rng, word, alphabet):
    at = rng.randrange(len(word) + 1)
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(alphabet) + word[at:], word[:at] + rng.choice(alphabet) + word[at + 1 :]])


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh", "aÀéÿ×z"])
def test_like_brute_force(spark, alphabet):
    rng = random.Random(len(alphabet))
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(7, 11))) for _ in range(60)]
    pool = base + [changed(rng, w, alphabet) for w in base for _ in range(3)]
    weight = [rng.choice([1, 1, 2, 5, 40]) for _ in pool]
    rows = [(d, " ".join(rng.choices(pool, weight, k=60)) + rng.choice(["", ".", "1", " Ā"])) for d in range(40)]
    expected = brute(rows)
    assert sum(r[1] is not None for r in expected) > 3 and len(expected) > 100
    assert got(spark, rows) == expected


def test_chains_of_forms_and_ties(spark):
    words = ["abcdefg"] * 3 + ["abcdefgh"] * 40 + ["abcdefghi"] * 700 + ["xbcdefghi"] * 7500 + ["zzzzzzzb"] * 60 + ["zzzzzzza"] * 60 + ["zzzzzzzz"] * 2
    rows = [(k, w) for k, w in enumerate(words)]
    expected = brute(rows)
    assert got(spark, rows) == expected
    roots = {r[0]: r[2] for r in expected}
    assert roots["abcdefg"] == "xbcdefghi" and roots["zzzzzzzz"] == "zzzzzzza"


def test_long_words_prefixes_of_each_other_and_odd_rows(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abc") for _ in range(20_000))
    own = [long, long[:-1], long[1:], long[:9000] + "z" + long[9001:], long[:9000] + "y" + long[9001:], long[:300] + long[301:]]
    own += ["a" * k for k in range(7, 30)] + ["ÀÉÎõüÿß", "ÀÉÎõüÿ", "ÀÉÎõüÿßé"]
    rows = [(100 + k, w) for k, w in enumerate(own * 3)] + odd_rows()
    rows = [r for r in rows if len(r[1] or "") < 100_000]
    expected = {r[0]: r for r in brute(rows) if len(r[0]) < 100}
    found = {r[0]: r for r in got(spark, rows)}
    assert {w: r for w, r in found.items() if len(w) < 100} == expected
    n = words_of(rows)
    for w, r in found.items():
        if len(w) >= 100:
            assert r[3] == n[w] and r[4] == sum(near(w, v) for v in n if abs(len(v) - len(w)) < 2)


def test_no_rows_and_no_frequent_words(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None), (2, ""), (3, "abcdefgh once abcdefgi"), (4, "short short short")]) == []


def test_the_walk_narrows(spark):
    """States are pruned level by level: far fewer than all pairs, and all levels end."""
    rng = random.Random(4)
    rows = [(w,) for w in {"".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(3000)}]
    words = spark.createDataFrame([(k, w[0], 2) for k, w in enumerate(rows)], "wid bigint, word string, n bigint")
    with spelling.scratch(spark, "test") as folder:
        trie = spelling.Trie(words, 3, folder)
        assert trie.edges.count() < 5 * len(rows)
        assert spelling.one_edit_pairs(trie, folder).count() < len(rows)
