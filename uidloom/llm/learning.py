"""Follow-the-regularised-leader updates for sparse logistic regression, and samples of labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from uidloom.llm import textops

STATE = "bucket int, weight double"
BIAS = -1


class Ftrl:
    """Weights of hashed features, learned one row at a time; the last bucket is the bias, without penalty."""

    def __init__(self, buckets: int, alpha: float = 0.1, beta: float = 1.0, l1: float = 1.0, l2: float = 1.0):
        self.z, self.n = np.zeros(buckets + 1), np.zeros(buckets + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def bias(self) -> float:
        return float(-self.z[-1] / ((self.beta + np.sqrt(self.n[-1])) / self.alpha))

    def learn(self, at: np.ndarray, values: np.ndarray, target: float) -> None:
        """``at`` holds distinct buckets."""
        w, bias = self.weights(at), self.bias()
        p = 1 / (1 + np.exp(-np.clip(w @ values + bias, -30, 30)))
        for where, g, old in ((at, (p - target) * values, w), (np.array([-1]), np.array([p - target]), bias)):
            n = self.n[where]
            self.z[where] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * old
            self.n[where] = n + g * g


Features = Callable[[textops.Texts], Iterator[tuple[np.ndarray, np.ndarray]]]
"""Per text its distinct buckets and their values."""


def fit(sample: DataFrame, features: Features, model: Callable[[], Ftrl], epochs: int = 2) -> tuple[np.ndarray, np.ndarray, float]:
    """Buckets with a weight, their weights, and the bias, from a bounded sample (text, target, turn).

    One task reads the sample as a stream, as often as there are epochs, each time in the order of ``turn``. Only
    the weights that the penalty leaves reach the driver.
    """
    repeated = sample.select("text", "target", "turn", F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"))
    ordered = repeated.repartition(1).sortWithinPartitions("epoch", "turn", "text").select("text", "target")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ftrl = model()
        for batch in batches:
            targets = batch.column(1).to_pylist()
            for texts in textops.chunks(batch.column(0)):
                for k, (at, values) in enumerate(features(texts)):
                    ftrl.learn(at, values, targets[texts.first + k])
        weights = ftrl.weights()[:-1]
        at = np.flatnonzero(weights)
        buckets, values = np.append(at, BIAS), np.append(weights[at], ftrl.bias())
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(values)], names=["bucket", "weight"])

    found = ordered.mapInArrow(learn, STATE).toArrow()
    buckets, values = found.column("bucket").to_numpy(), found.column("weight").to_numpy()
    real = buckets != BIAS
    return buckets[real], values[real], float(values[~real].sum())


def crc_of_id(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string"))


def labelled_sample(labels: DataFrame, label: str, allowed: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` ids of each class, those with the smallest hashes: doc_id, target, turn.

    Ids and labels that are null are left out; an id with both labels counts as 1.
    """
    rows = (
        labels.where(allowed & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("double").alias("target"))
        .withColumn("turn", F.xxhash64(F.col("doc_id").cast("bigint")))
    )
    picks = [rows.where(F.col("target") == y).orderBy("turn", "doc_id").limit(per_class) for y in (0.0, 1.0)]
    return picks[0].unionByName(picks[1])
