from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from uidloom.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, depth int, part int, words string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(5)


def sequences(rows):
    """The rebuilt turns of each conversation."""
    turns: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            turns.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", digest, text or ""))
    turns = {c: [(t[1], t[3]) for t in sorted(own)] for c, own in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def brute(rows):
    said = sequences(rows)
    members: dict = {}
    for c, turns in said.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids: dict = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    words = {n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0 for n in members}
    out = []
    for node, own in members.items():
        subtree = [n for n in members if n[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(own) if len(said[c]) == len(node))
        out.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(kids.get(node, [])),
            sum(n not in kids for n in subtree), sum((len(members[n]) - 1) * words[n] for n in subtree),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(spark, rows, **how):
    df = prefix_trie.conversation_trie(prefix_trie.rebuilt(frame(spark, rows)), **how)
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some_rows(seed, convs=150, longest=5):
    rng = random.Random(seed)
    texts = ["", "a", "a b", "one two  three", "é x \t y", None]
    rows = []
    for c in rng.sample(range(-60, 400), convs):
        for turn in range(rng.randint(1, longest)):
            role, text = rng.choice([("user", rng.choice(texts)), (None, "only " + str(rng.randint(0, 40)))])
            rows.append((c, turn, role, text))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_nodes_like_brute_force(spark, seed):
    rows = some_rows(seed)
    assert found(spark, rows) == brute(rows)


def test_null_turns_ties_repeats_and_null_ids(spark):
    rows = [
        (1, None, "b", "x"), (1, 1, "a", "y"), (1, 1, "a", "y"), (1, 1, "a", "z"), (1, 1, None, None), (1, -5, "q", "first"),
        (None, 1, "a", "lost"), (0, 0, "", ""), (0, 0, "", ""), (20, 0, "", ""), (20, 1, "", ""), (41, 3, None, "z z"), (7, 0, "u", "t"),
    ]
    assert found(spark, rows) == brute(rows)


def test_turnless_conversations_and_no_rows(spark):
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1)
    rows = [(short, 0, "user", "hi")]
    assert found(spark, rows) == brute(rows)
    (root,) = brute(rows)
    assert root[1] == 0 and root[5] == 1
    assert found(spark, []) == []


def test_a_full_sketch_changes_nothing(spark):
    rows = some_rows(5, convs=60)
    assert prefix_trie.Sketch.for_items(10**9, 1 << 20).cells == 1 << 20
    assert found(spark, rows, most_cells=64) == brute(rows)  # far fewer cells than prefixes, nearly all look shared


def test_no_count_is_too_low(spark):
    rng = random.Random(3)
    digests = [hashlib.md5(str(rng.randint(0, 900)).encode()).digest() for _ in range(1500)]
    df = spark.createDataFrame([(d,) for d in digests], "node binary").repartition(7)
    sketch = prefix_trie.Sketch.for_items(len(digests))
    import pyarrow as pa

    single = sketch.single(sketch.build(df), pa.array(digests))
    truly = [digests.count(d) == 1 for d in digests]
    assert all(t for s, t in zip(single, truly) if s)
    assert sum(single) > 0.95 * sum(truly)


def test_one_long_conversation_and_a_crowd_of_copies_over_many_parts(spark):
    rows = [(40, k, "user", f"turn {k % 7}") for k in range(500)] + [(45, k, "user", f"turn {k % 7}") for k in range(490)]
    rows += [(c, k, "user", f"turn {k}") for c in range(1000, 1400) for k in range(3)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = prefix_trie.rebuilt(frame(spark, rows))
        with prefix_trie.scratch(spark, "test") as folder:
            parts = prefix_trie._cut(turns, ["conv_id"], folder)
            spread = parts.where("conv_id = 40").select("part").distinct().count()
        assert spread > 1
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_ends_are_hashed_in_order_over_several_packs(spark):
    ids = list(range(-5, 30_000, 3))
    df = spark.createDataFrame([(b"n", i) for i in ids] + [(b"", 4)], "node binary, conv_id bigint").repartition(9)
    got = {bytes(r[0]): r[1] for r in prefix_trie.hashed_ends(df).collect()}
    assert got[b"n"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[b""] == hashlib.sha256(b"4").hexdigest()


def test_compose_of_words_counts_white_space_as_the_contract(spark):
    rows = [(20, 0, "a", "x y z w \x1c v"), (40, 0, "a", "x y z w \x1c v")]
    assert found(spark, rows) == brute(rows)
