"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are words and runs of marks. Their n-grams are taken twice: of the tokens themselves in lower case, of one
and two, and of their forms (case, digits, length, the marks, whether the token came just before) of one to three.
A feature's value is its share of the tokens; a score is the sparse dot product of values and weights.

Defined results: a null or empty text has no features, so its score comes from the bias alone; repeated rows get
equal scores; rows without an id are never learned from. Without labels of both classes the weights are those
that the rows there give, or 0 and a score of one half. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from uidloom.llm import textops
from uidloom.llm.learning import Ftrl, crc_of_id, fit, labelled_sample

BUCKET_BITS = 18
PER_CLASS = 3000
"""Bound of the training sample: labelled rows of each class, those with the smallest hash of their id."""
SCALE = 10.0
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _forms(tokens: textops.Tokens) -> np.ndarray:
    """A hash of the form of each token: marks are their own form."""
    data, start, end = tokens.data, tokens.start, tokens.end

    def share(low: int, high: int) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int32)
        np.cumsum((data >= low) & (data < high), out=total[1:])
        return total[end] - total[start]

    size = end - start
    upper, lower, digits = share(65, 91), share(97, 123), share(48, 58)
    case = np.where(digits > 0, 4, np.where(upper == 0, 1, np.where(lower > 0, 2, np.where(size > 1, 3, 2))))
    form = (case * 8 + np.minimum(size // 4, 7)).astype(np.uint64) * _STEP
    form = np.where(tokens.is_word, form, tokens.hash)
    again = np.zeros(len(size), bool)
    again[1:] = tokens.hash[1:] == tokens.hash[:-1]
    again[2:] |= (tokens.hash[2:] == tokens.hash[:-2]) & tokens.is_word[2:]
    return textops.mix(form + again * np.uint64(0xABCDEF12345))


def occurrences(texts: textops.Texts) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each n-gram that ends at each token, one row for each kind, -1 if cut off by the text's start."""
    tokens = textops.Tokens(texts)
    n = len(tokens.start)
    place = np.arange(n) - np.repeat(tokens.first[:-1], np.diff(tokens.first))
    out = np.full((5, n), -1, np.int32)
    kind = 0
    for grams, longest in ((tokens.hash, 2), (_forms(tokens), 3)):
        gram = np.zeros(n, np.uint64)
        for size in range(1, longest + 1):
            late = np.zeros(n, np.uint64)
            late[size - 1 :] = grams[: n - size + 1]
            gram = gram * _STEP + late
            bucket = textops.mix(gram + np.uint64(kind)) >> np.uint64(64 - BUCKET_BITS)
            out[kind] = np.where(place >= size - 1, bucket.astype(np.int32), -1)
            kind += 1
    return out, tokens.first


def features(texts: textops.Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    out, first = occurrences(texts)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        own = out[:, a:b].reshape(-1)
        at, count = np.unique(own[own >= 0], return_counts=True)
        yield at, count * (SCALE / max(b - a, 1))


class QualityModel:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = np.append(weights, 0.0), bias

    def scores(self, texts: textops.Texts) -> np.ndarray:
        out, first = occurrences(texts)
        sums = np.concatenate(([0.0], np.cumsum(self.weights[out].sum(0))))
        total = (sums[first[1:]] - sums[first[:-1]]) * SCALE / np.maximum(np.diff(first), 1)
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", allowed: Column | None = None, per_class: int = PER_CLASS
) -> QualityModel:
    """``allowed`` says of a label row whether it may be learned from."""
    picked = labelled_sample(labels, label, F.lit(True) if allowed is None else allowed, per_class)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    buckets, values, bias = fit(rows, features, lambda: Ftrl(1 << BUCKET_BITS, alpha=0.3, l1=0.02, l2=0.05))
    weights = np.zeros(1 << BUCKET_BITS, np.float32)
    weights[buckets] = values
    return QualityModel(weights, bias)


def scorer(spark: SparkSession, model: QualityModel):
    """A function of a text column that gives scores from 0 to 1; the model has a fixed size."""
    held = spark.sparkContext.broadcast((model.weights[:-1], model.bias))

    @arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        own = QualityModel(*held.value)
        found = [own.scores(texts) for texts in textops.chunks(text)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return score


def may_learn(doc_id: Column) -> Column:
    """The rows that the query may learn labels from."""
    return crc_of_id(doc_id) % 4 != 2
