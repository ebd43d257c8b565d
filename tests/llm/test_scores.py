"""Scores against a plain sum over each text's features, one text at a time, and the targets that are learned."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.data import frame, odd_rows, sentence
from tests.llm.test_classifiers import BAD, GOOD, labels
from uidloom.llm import learning, quality, textops, toxicity


def texts():
    rng = random.Random(4)
    made = [" ".join(sentence(rng, rng.randint(0, 60))) for _ in range(60)]
    insulted = [f"{text} you are such an idiot, {text[:20]} loser" for text in made[:20]]
    return made + insulted + [f"{GOOD} {k}. {BAD}" for k in range(5)] + [t for _, t in odd_rows()]


def alone(text):
    return next(textops.chunks(pa.array([text], pa.string())))


def plain_scores(features, weight_of, bias):
    out = []
    for text in texts():
        at, values = next(iter(features(alone(text))))
        total = sum(weight_of(int(b)) * float(v) for b, v in zip(at, values)) + bias
        out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, total)))))
    return out


def spark_scores(spark, score):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts())], "k int, text string").repartition(3)
    found = {r["k"]: r["s"] for r in df.select("k", score("text").alias("s")).collect()}
    return [found[k] for k in range(len(found))]


def test_quality_scores_are_the_sums_of_the_features(spark):
    rng = np.random.default_rng(5)
    weights = (rng.normal(size=1 << quality.BUCKET_BITS) * (rng.random(1 << quality.BUCKET_BITS) < 0.5)).astype(np.float32)
    model = quality.QualityModel(weights, 0.3)
    plain = plain_scores(quality.features, lambda b: float(weights[b]), 0.3)
    assert np.allclose(spark_scores(spark, quality.scorer(spark, model)), plain, atol=1e-6)
    assert len(set(plain)) > 60


def test_toxicity_scores_are_the_sums_of_the_distinct_features(spark):
    rng = np.random.default_rng(6)
    size = (1 << toxicity.BUCKET_BITS) + 64
    buckets = np.flatnonzero(rng.random(size) < 0.3)
    buckets = np.union1d(buckets, np.arange(1 << toxicity.BUCKET_BITS, size))
    weights = rng.normal(size=len(buckets)).astype(np.float32)
    learned = [np.sort(np.array([textops.hash_word(w) for w in sentence(random.Random(k), 9)], np.uint64)) for k in range(8)]
    held = dict(zip(buckets.tolist(), weights.tolist()))
    model = toxicity.ToxicityModel(buckets, weights, -0.4, learned)
    plain = plain_scores(toxicity.features_of(learned), lambda b: held.get(b, 0.0), -0.4)
    assert np.allclose(spark_scores(spark, toxicity.scorer(spark, model)), plain, atol=1e-5)
    assert len(set(plain)) > 60


def test_words_of_the_lexicon_are_votes():
    """The votes of each list, from the words themselves."""
    voters = toxicity.Voters([])
    for text in ["you idiot", "such rubbish and filth", "a vile moron , you know", "nothing here", "Your a LOSER", ""]:
        words = text.lower().replace(",", " ").split()
        expected = {name for name, held in toxicity.LEXICON.items() if set(words) & set(held.split())}
        found = int(voters.patterns(alone(text))[0])
        assert {name for k, name in enumerate(voters.names) if found >> k & 1 and name in toxicity.LEXICON} == expected


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_labelled_rows_learn_the_posterior_of_their_votes(spark, monkeypatch, broadcast_rows):
    """Rows of one vote pattern have one target, whatever their labels, and a few wrong labels do not turn it."""
    rows = [(k, f"you are such an idiot and a loser {k}" if k % 4 == 0 else f"{GOOD} {k}") for k in range(200)]
    wrong = {8, 12, 13, 17}
    known = [(k, 1, int((k % 4 == 0) != (k in wrong))) for k in range(160)]
    seen = []

    def capture(sample, *args, **kwargs):
        seen.extend((r["text"], r["target"]) for r in sample.select("text", "target").collect())
        return learning.fit(sample, *args, **kwargs)

    monkeypatch.setattr(toxicity, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(toxicity, "fit", capture)
    docs = frame(spark, rows)
    model = toxicity.train(docs, labels(spark, known))
    assert len(seen) == 200
    voters, by_votes = toxicity.Voters(model.lists), {}
    for text, target in seen:
        by_votes.setdefault(int(voters.patterns(alone(text))[0]), set()).add(target)
    assert all(len(targets) == 1 for targets in by_votes.values())
    assert all((target >= 0.5) == text.startswith("you") for text, target in seen)
    assert Counter(0 < target < 1 for _, target in seen) == {True: 200}
