from __future__ import annotations

import hashlib
import re

import pytest

from tests.llm.data import frame, odd_rows
from uidloom.llm.exact_dedup import DigestIndex


@pytest.fixture()
def index(spark, tmp_path):
    made = DigestIndex(spark, f"digests_{abs(hash(str(tmp_path)))}", buckets=4)
    yield made
    made.drop()


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(digest(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return {d: (min(g)[3], len(g)) for d, g in groups.items()}


def test_groups_of_odd_rows(spark, index):
    rows = odd_rows() + [(20, "a b"), (21, "ab"), (19, "a\n b"), (22, "a  b"), (18, "a  b")]
    found = index.add(frame(spark, rows)).collect()
    groups = expected(rows)
    assert len(found) == len(rows)
    assert all((r["keep_id"], r["group_size"]) == groups[r["text_sha256"]] for r in found)
    kept = [r["text_sha256"] for r in found if r["kept"]]
    assert sorted(kept) == sorted(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])
    assert {r["text_sha256"] for r in found} == {digest(t) for _, t in rows}


def test_the_index_persists(spark, index):
    index.add(frame(spark, [(5, "x y"), (6, "z")])).collect()
    later = {r["doc_id"]: r for r in index.add(frame(spark, [(1, "xy"), (2, "new"), (3, "n ew")])).collect()}
    assert (later[1]["keep_id"], later[1]["kept"], later[1]["group_size"]) == (5, False, 2)
    assert (later[2]["keep_id"], later[2]["kept"]) == (3, False) and later[3]["kept"]
    assert index.entries().count() == 3
    assert not any(r["kept"] for r in index.add(frame(spark, [(9, "new"), (8, "z")])).collect())


def test_new_digests_are_found_without_moving_the_index(spark, index):
    index.add(frame(spark, [(5, "x y")])).collect()
    plan = spark.table(index.table).groupBy("text_sha256").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_no_rows(spark, index):
    assert index.add(frame(spark, [(1, "a")]).where("doc_id = 2")).collect() == []


def test_group_size_counts_all_batches(spark, index):
    for k in range(1, 5):
        rows = index.add(frame(spark, [(10 * k, "a b"), (10 * k + 1, "ab"), (10 * k + 2, f"own {k}")])).collect()
        assert sorted(r["group_size"] for r in rows) == [1, 2 * k, 2 * k]
        assert {r["keep_id"] for r in rows if r["group_size"] > 1} == {10}
    assert {r["n_rows"] for r in index.entries().collect()} == {1, 8}


def test_a_batch_added_again_is_judged_as_the_first_time(spark, index):
    index.add(frame(spark, [(1, "old")]), batch="a").collect()
    rows = [(2, "old"), (3, "new"), (4, "n ew")]
    first = sorted(map(tuple, index.add(frame(spark, rows), batch="b").collect()))
    held = sorted(map(tuple, index.entries().collect()))
    assert sorted(map(tuple, index.add(frame(spark, rows), batch="b").collect())) == first
    assert sorted(map(tuple, index.entries().collect())) == held


def test_one_text_in_half_of_the_rows(spark, index):
    rows = [(k, "the same" if k % 2 else f"text {k}") for k in range(4000)]
    found = index.add(frame(spark, rows))
    assert "Broadcast" in found._jdf.queryExecution().executedPlan().toString()
    groups = expected(rows)
    assert all((r["keep_id"], r["group_size"]) == groups[r["text_sha256"]] for r in found.collect())
