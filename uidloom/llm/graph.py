"""Connected components of an edge table by contraction, with every step written to the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from uidloom.sources.session import materialize

SMALL = 1_000_000
"""Edges that one task settles at once; a larger graph is contracted over the cluster until it has no more."""


def smallest_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of some edges, and the smallest node that each can reach."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        for end in (left, right):
            np.minimum.at(new, end, low)
            np.minimum.at(new, label[end], low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
    if ends:
        nodes, found = smallest_reachable(*(np.concatenate(x) for x in zip(*ends)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(found)], names=["node", "into"])


def _contract(edges: DataFrame, turn: int) -> DataFrame:
    """(node, into): every node joins the first of its neighbours and itself.

    The order is by number and by a new random order in turn: the first settles stars around a small node at
    once, the second shortens long paths by a constant part on average.
    """
    rank = F.xxhash64("other", F.lit(turn)) if turn % 2 else F.col("other")
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    first = both.groupBy("node").agg(F.min(F.struct(rank.alias("rank"), "other")).alias("first"))
    own = F.xxhash64("node", F.lit(turn)) if turn % 2 else F.col("node")
    joins = F.col("first") < F.struct(own.alias("rank"), F.col("node").alias("other"))
    return first.select("node", F.when(joins, F.col("first.other")).otherwise(F.col("node")).alias("into"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): component is the smallest node that is reachable."""
    edges = materialize(edges.where("a <> b").select("a", "b").distinct(), "edges")
    steps: list[DataFrame] = []
    while edges.count() > SMALL:
        step = materialize(_contract(edges, len(steps)), "joined")
        steps.append(step)
        for end in ("a", "b"):
            edges = edges.join(step.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("into", end)
        edges = materialize(edges.where("a <> b").select("a", "b").distinct(), "edges")
    settled = materialize(edges.repartition(1).mapInArrow(_settle, "node bigint, into bigint"), "settled")
    if not steps:
        return settled.withColumnRenamed("into", "component")
    found = steps[0]
    for step in [*steps[1:], settled]:
        later = step.select(F.col("node").alias("into"), F.col("into").alias("later"))
        found = found.join(later, "into", "left").select("node", F.coalesce("later", "into").alias("into"))
    smallest = found.groupBy("into").agg(F.min("node").alias("component"))
    return materialize(found.join(smallest, "into").select("node", "component"), "components")
