from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.data import frame, odd_rows
from uidloom.llm import queries, stages

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables not present")


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_points.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(queries.QUERIES) <= set(names)


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given, sizes = docs.columns, [docs.count()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "token_output"]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), f"test_{name}")
        sizes.append(docs.count())
        if name != "token_output":
            assert sorted(docs.columns) == sorted(given)
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0 and sizes[4] == sizes[5]


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and found.count() > 50


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_each_stage_on_odd_rows_and_no_rows(spark, name, stage):
    docs = frame(spark, odd_rows())
    assert stage(spark, docs.where("doc_id = 99"), SMALL).collect() == []
    found = stage(spark, docs, SMALL)
    if name != "token_output":
        assert tuple(found.columns) == stages.COLUMNS
    if name == "decontamination":
        assert found.count() == len(odd_rows())
    if name == "near_dedup":
        ids = sorted(r["doc_id"] for r in found.where("doc_id IS NOT NULL").collect())
        assert ids == [1, 2, 3, 4, 5, 7, 10, 11, 12, 12, 13, 14]  # two unrelated texts have the id 12
    found.collect()


def test_near_dedup_tells_texts_of_one_id_apart_and_drops_copies_without_ids(spark):
    long = [" ".join(f"w{k}{j}" for j in range(30)) for k in range(4)]
    rows = [(1, long[0]), (1, long[1]), (None, long[2]), (None, long[2]), (5, long[3]), (5, long[3]), (3, long[3] + " x"), (None, None), (None, None)]
    found = stages.deduplicated(spark, frame(spark, rows), SMALL).collect()
    assert sorted((repr(r["doc_id"]), r["text"] or "") for r in found) == sorted(
        [("1", long[0]), ("1", long[1]), ("None", long[2]), ("3", long[3] + " x"), ("None", ""), ("None", "")]
    )
