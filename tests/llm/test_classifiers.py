"""The learned operators: held-out accuracy on the given tables, and defined results for odd rows."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.data import SCHEMA, frame, odd_rows
from uidloom.llm import language, learning, quality, queries, toxicity

LARGE = "/root/testdata/sf0.1"
needs_tables = pytest.mark.skipif(not os.path.isdir(LARGE), reason="given tables not present")


def labels(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, quality int, toxic int, text string")


def truth(column, name="labels"):
    return pd.read_parquet(f"{LARGE}/{name}.parquet").set_index("doc_id")[column].dropna()


@needs_tables
@pytest.mark.parametrize("name, column, at", [("op7_quality", "quality", 0.7), ("op8_toxicity", "toxic", 0.5)])
def test_held_out_labels(spark, name, column, at):
    found = queries.QUERIES[name](spark, LARGE).toPandas().set_index("doc_id")
    assert len(found) == 10_000 and found.score.between(0, 1).all()
    assert (found.predicted == (found.score >= at)).all()
    both = found.join(truth(column), how="inner")
    held = both[both.held_out]
    wrong = held[held.predicted != held[column]]
    assert len(held) > 300 and len(wrong) <= 0.02 * len(held)
    rare = held[held[column] == (0 if column == "quality" else 1)]
    assert (rare.predicted == rare[column]).mean() > 0.93


@needs_tables
def test_held_out_languages(spark):
    found = queries.QUERIES["op9_language"](spark, LARGE).toPandas().set_index("doc_id")
    both = found.join(truth("lang", "documents"), how="inner")
    assert both.held_out.sum() > 2000
    assert (both[both.held_out].lang_pred == both[both.held_out].lang).mean() > 0.99
    assert found.score.between(0, 1).all()


GOOD = "A plain sentence of words, and one more of them. It goes on for a while"
BAD = "BUY NOW!! CHEAP!! CLICK!! HERE!! NOW!! FREE!! OFFER!!"


def test_quality_of_odd_rows(spark):
    rows = [(k, f"{GOOD} {k}" if k % 2 else f"{BAD} {k}!!") for k in range(100, 180)] + odd_rows()
    docs = frame(spark, rows)
    known = [(k, k % 2, 0) for k in range(100, 170)] + [(170, None, None), (None, 1, 1), (9999, 1, 0), (100, 0, 0)]
    model = quality.train(docs, labels(spark, known))
    found = docs.select("doc_id", "text", quality.scorer(spark, model)("text").alias("s")).collect()
    assert len(found) == len(rows) and all(0 <= r["s"] <= 1 for r in found)
    scores = {r["text"]: r["s"] for r in found}
    assert all((scores[t] >= 0.7) == bool(k % 2) for k, t in rows[:80])
    assert scores[None] == scores[""] == scores[" \t\n"]


def test_toxicity_of_odd_rows(spark):
    rows = [(k, f"you are such an idiot and a loser {k}" if k % 4 == 0 else f"{GOOD} {k}") for k in range(100, 200)] + odd_rows()
    docs = frame(spark, rows)
    model = toxicity.train(docs, labels(spark, [(k, 1, int(k % 4 == 0)) for k in range(100, 180)] + [(None, 1, 1), (181, 1, None)]))
    found = docs.select("doc_id", "text", toxicity.scorer(spark, model)("text").alias("s")).collect()
    scores = {r["text"]: r["s"] for r in found}
    assert len(found) == len(rows) and all(0 <= s <= 1 for s in scores.values())
    assert all((scores[t] >= 0.5) == (k % 4 == 0) for k, t in rows[:100])
    assert scores[None] == scores[""] < 0.5


@pytest.mark.parametrize("operator, label", [(quality, "quality"), (toxicity, "toxic")])
def test_without_labels_or_rows(spark, operator, label):
    none = labels(spark, [(1, 1, 1)]).where("doc_id = 2")
    for docs in (frame(spark, odd_rows()), frame(spark, [(1, "a")]).where("doc_id = 2")):
        score = operator.scorer(spark, operator.train(docs, none))
        found = docs.select(score("text").alias("s")).collect()
        assert len(found) == docs.count() and all(0 <= r["s"] <= 1 for r in found)


def test_label_model_finds_good_voters_and_shares_weight_of_copies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.2
    fire = lambda yes, no: rng.random(len(truth)) < np.where(truth, yes, no)
    good, noise, copy = fire(0.9, 0.02), fire(0.3, 0.3), None
    copy = good.copy()
    votes = np.stack([good, fire(0.8, 0.05), noise, copy], 1)
    patterns = (votes << np.arange(4)).sum(1)
    known = np.where(rng.random(len(truth)) < 0.05, truth, -1)
    table = pd.Series(1, index=range(len(truth))).groupby([patterns, known]).sum().reset_index()
    model = toxicity.LabelModel(table.iloc[:, 0].to_numpy(), table.iloc[:, 1].to_numpy(), table.iloc[:, 2].to_numpy(float), 4)
    clean, toxic = model.fires
    assert toxic[0] > 0.8 and clean[0] < 0.05 and abs(toxic[2] - clean[2]) < 0.1
    assert model.shares[0] < 0.6 and model.shares[3] < 0.6 and model.shares[1] > 0.75
    assert ((model.posterior(patterns) >= 0.5) == truth).mean() > 0.95


def test_languages_of_odd_rows(spark):
    texts = {"en": "the house and the garden with a tree", "de": "das Haus und der Garten mit einem Baum", "fr": "la maison et le jardin avec un arbre"}
    rows = [(k * 3 + j, f"{text} {'x' * (k % 3)}", lang) for k in range(30) for j, (lang, text) in enumerate(sorted(texts.items()))]
    full = [(d, t, lang, "s", 1, "a", 1, "b", "c") for d, t, lang in rows]
    full += [(d, t, None, "s", 1, "a", 1, "b", "c") for d, t in odd_rows()] + [(500, "123 !!", "en", "s", 1, "a", 1, "b", "c")]
    docs = spark.createDataFrame(full, SCHEMA)
    found = language.identify(docs, language.train(docs.where("doc_id < 60 OR doc_id IS NULL"))).collect()
    assert len(found) == len(full)
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], set()).add(r["lang_pred"])
        assert 0 <= r["score"] <= 1
    assert all(by_id[d] == {lang} for d, _, lang in rows if d >= 60)
    assert by_id[500] == {"und"} and "und" in by_id[1] & by_id[2] & by_id[3]
    unseen = spark.createDataFrame([(1, "gardens houses"), (2, "Gärten Häuser")], "doc_id bigint, text string")
    assert all(r["lang_pred"] in texts for r in language.identify(unseen, language.train(docs)).collect())


def test_language_without_rows(spark):
    docs = frame(spark, odd_rows())
    nothing = language.train(docs.where("doc_id = 99"))
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs.where("doc_id = 99"), language.train(docs)).collect() == []


def test_updates_are_those_of_the_formula():
    rng = np.random.default_rng(2)
    model = learning.Ftrl(20, alpha=0.2, beta=1.0, l1=0.1, l2=0.3)
    z, n = [0.0] * 21, [0.0] * 21
    for _ in range(200):
        at = np.sort(rng.choice(20, 5, replace=False))
        x, y = rng.random(5), float(rng.random() < 0.5)
        w = {}
        for i in [*at.tolist(), 20]:
            l1, l2 = (0.1, 0.3) if i < 20 else (0.0, 0.0)
            w[i] = 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((1 + n[i] ** 0.5) / 0.2 + l2)
        p = 1 / (1 + np.exp(-(sum(w[i] * v for i, v in zip(at.tolist(), x)) + w[20])))
        for i, v in [*zip(at.tolist(), x), (20, 1.0)]:
            g = (p - y) * v
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.2 * w[i]
            n[i] += g * g
        model.learn(at, x, y)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_sample_is_bounded_and_by_hash(spark):
    rows = labels(spark, [(k, k % 2, 0) for k in range(1000)] + [(5, 0, 0)])
    picked = learning.labelled_sample(rows, "quality", F.lit(True), 50).collect()
    assert len(picked) == 100 and len({r["doc_id"] for r in picked}) == 100
