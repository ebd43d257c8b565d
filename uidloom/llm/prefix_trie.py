"""The prefix trie of conversations: one row per distinct sequence of first turns, with counts over its subtree.

Turns are reduced to digests where they are read. A prefix is known by two sums of 64-bit hashes of its turns, each
hashed with its place, so a long conversation can be cut anywhere and the sums of its parts are added.

A count-min sketch of all prefixes, two rows of cells with counters up to two, is made in each task, combined block by
block and broadcast. Where one of a prefix's counters is one, a single conversation has it. What follows such a prefix
is a tail, and its nodes are made from its own rows. Only the other, possibly shared prefixes are shuffled and counted
exactly. The size of the sketch follows the number of prefixes up to ``MOST_CELLS``; beyond it more prefixes are
counted that prove single, and the result is the same.

The owner of a node is its smallest member. If a conversation owns a node it owns all below on its way, so it is
described by the depth from which it owns, and all sums over a subtree are sums over the members of its top.

Defined results: turns are ordered by number (null first), then role, then digest of the text; a null role or text is
empty; repeated rows are turns of their own; rows without a conversation id belong to no conversation and are left
out; no conversations give no rows. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from uidloom.sources.session import materialize, scratch

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_CELLS = 1 << 16
MOST_CELLS = 1 << 27
"""Cells of one row of the sketch: 32 MB are broadcast for both rows at most."""
PART_BYTES = 1 << 16
ENDS_NONE = hashlib.sha256(b"").hexdigest()
_SUM = "decimal(38,0)"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, said, words): each turn with a digest of its role and text, and the words of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)).alias("said"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )


def rebuilt(conversations: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """(conv_id, place, turn, role, said, words, dropped): all turns that conversations are rebuilt from.

    Conversation c starts with the first h turns of c - c % group, where h is its checksum modulo ``most``, which
    have ``place`` 0; its own turns have place 1, and ``dropped`` says how many of them go, from the first on.
    """
    turns = turns_of(conversations)
    c = F.col("conv_id")
    base = c - c % group
    takes = F.when(c == base, 0).otherwise(F.crc32(c.cast("string")) % most).cast("int")
    first = Window.partitionBy("conv_id").orderBy("turn", "role", "said")
    # Spark keeps the few first rows of each conversation before it shuffles.
    starts = turns.where(c == base).withColumn("k", F.row_number().over(first)).where(F.col("k") < most)
    starts = starts.select(F.col("conv_id").alias("base"), "k", "role", "said", "words")
    takers = turns.select("conv_id").distinct().select("conv_id", base.alias("base"), takes.alias("dropped"))
    given = takers.where("dropped > 0").join(starts, "base").where("k <= dropped")
    return turns.select("conv_id", F.lit(1).alias("place"), "turn", "role", "said", "words", takes.alias("dropped")).unionByName(
        given.select("conv_id", F.lit(0).alias("place"), F.col("k").cast("bigint").alias("turn"), "role", "said", "words", "dropped")
    )


def _cut(rows: DataFrame, names: list[str], folder: str) -> DataFrame:
    """Rows with ``part``: conversations in order, cut into even parts, the long ones too."""
    order = ["conv_id", "place", "turn", "role", "said"]
    ranged = materialize(rows, "turns", folder).repartitionByRange(*order)
    return materialize(ranged.withColumn("part", F.spark_partition_id()), "parts", folder).select("part", *names)


def _earlier(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """(part, conv_id, and a sum over the earlier parts of the conversation each), for conversations in several parts.

    No more than the parts hold one of their two ends, so there are few of them.
    """
    spans = rows.groupBy("conv_id").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    split = F.broadcast(spans.where("low < high").select("conv_id"))
    per_part = rows.join(split, "conv_id").groupBy("part", "conv_id").agg(*[f.alias(n) for n, f in sums.items()])
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(per_part.select("part", "conv_id", *[F.sum(n).over(before).alias(n) for n in sums]))


def prefixes(rows: DataFrame, folder: str) -> DataFrame:
    """(conv_id, depth, node, parent, words, before, is_end): a row per conversation and prefix of it.

    ``before`` counts the words of the turns before the last; nodes are digests of 16 bytes.
    """
    names = ["conv_id", "place", "turn", "role", "said", "words", "dropped"]
    parts = _cut(rows, names, folder)
    here = Window.partitionBy("part", "conv_id").orderBy("place", "turn", "role", "said")
    whole = Window.partitionBy("part", "conv_id")
    zero = F.lit(0).cast("bigint")

    counts = _earlier(parts, {"e_given": F.sum(1 - F.col("place")), "e_rows": F.count("*")})
    placed = (
        parts.join(counts, ["part", "conv_id"], "left")
        .withColumn("row", F.row_number().over(here) + F.coalesce("e_rows", zero))
        .withColumn("given", F.sum(1 - F.col("place")).over(whole) + F.coalesce("e_given", zero))
        .withColumn("own", F.col("row") - F.col("given"))
        .where("place = 0 OR own > dropped")
        .withColumn("depth", F.when(F.col("place") == 0, F.col("row")).otherwise(F.col("given") + F.col("own") - F.col("dropped")))
        .select("part", "conv_id", "place", "turn", "role", "said", "depth", "words")
    )
    placed = materialize(placed, "placed", folder)
    hashes = {f"sum{k}": F.xxhash64("depth", "said", F.lit(k)).cast(_SUM) for k in (1, 2)}
    placed = placed.select("part", "conv_id", "depth", "words", *[h.alias(n) for n, h in hashes.items()])
    later = _earlier(placed, {f"e_{n}": F.sum(n) for n in ("sum1", "sum2", "words")})
    by_depth = Window.partitionBy("part", "conv_id").orderBy("depth")
    until = by_depth.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    deepest = placed.groupBy("conv_id").agg(F.max("depth").alias("deepest"), F.min("part").alias("low"), F.max("part").alias("high"))
    deepest = F.broadcast(deepest.where("low < high").select("conv_id", "deepest"))
    none = F.lit(0).cast(_SUM)
    sums = (
        placed.join(later, ["part", "conv_id"], "left")
        .join(deepest, "conv_id", "left")
        .withColumn("p1", (F.sum("sum1").over(until) + F.coalesce("e_sum1", none)).cast(_SUM))
        .withColumn("p2", (F.sum("sum2").over(until) + F.coalesce("e_sum2", none)).cast(_SUM))
        .withColumn("read", F.sum("words").over(until) + F.coalesce("e_words", zero))
        .withColumn("last", F.coalesce("deepest", F.max("depth").over(Window.partitionBy("part", "conv_id"))))
    )

    def digest(depth: Column, p1: Column, p2: Column) -> Column:
        return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), p1.cast("string"), p2.cast("string"))))

    depth = F.col("depth")
    less = [(F.col(f"p{k}") - F.col(f"sum{k}")).cast(_SUM) for k in (1, 2)]
    return materialize(
        sums.select(
            "conv_id",
            depth.cast("bigint").alias("depth"),
            digest(depth, F.col("p1"), F.col("p2")).alias("node"),
            digest(depth - 1, *less).alias("parent"),
            "words",
            (F.col("read") - F.col("words")).alias("before"),
            (depth == F.col("last")).alias("is_end"),
        ),
        "prefixes",
        folder,
    )


class Sketch:
    """A count-min sketch with two rows and counters up to two, kept as the bits of the cells that hold two."""

    ROWS = 2

    def __init__(self, cells: int):
        self.cells = cells

    @classmethod
    def for_items(cls, n: int, most: int = MOST_CELLS) -> Sketch:
        """Four cells a row for each item, in whole blocks."""
        return cls(min(most, max(BLOCK_CELLS, 1 << (4 * max(n, 1) - 1).bit_length())))

    def cells_of(self, nodes: pa.Array) -> list[np.ndarray]:
        """The cell of each digest in each row; one row follows the other."""
        # Digests are bits at random, so each half is a hash of its own.
        raw = np.frombuffer(b"".join(nodes.to_pylist()), "<u8").reshape(-1, 2)
        return [(raw[:, k] & np.uint64(self.cells - 1)).astype(np.int64) + k * self.cells for k in range(self.ROWS)]

    def build(self, prefixes: DataFrame) -> np.ndarray:
        """The bits of all cells with two or more, from sketches of the tasks that are combined block by block."""

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    cells, n = np.unique(np.concatenate(self.cells_of(batch.column(0))), return_counts=True)
                    cuts = np.flatnonzero(np.diff(cells >> 16, prepend=-1))
                    for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(cells)]):
                        places = (cells[low:high] & 0xFFFF).astype("<u2")
                        twice = n[low:high] > 1
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([int(cells[low] >> 16)]), pa.array([places.tobytes()]), pa.array([places[twice].tobytes()])],
                            names=["block", "once", "more"],
                        )

        def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, count = None, np.zeros(BLOCK_CELLS, np.uint8)
            out = lambda: pa.RecordBatch.from_arrays([pa.array([at]), pa.array([np.packbits(count > 1).tobytes()])], names=["block", "bits"])
            for batch in batches:
                for block, once, more in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    if block != at:
                        if at is not None:
                            yield out()
                        at, count = block, np.zeros(BLOCK_CELLS, np.uint8)
                    for places in (once, more):
                        own = np.frombuffer(places, "<u2")
                        count[own] = np.minimum(count[own] + 1, 2)
            if at is not None:
                yield out()

        parts = prefixes.select("node").mapInArrow(partial, "block bigint, once binary, more binary")
        blocks = parts.repartition("block").sortWithinPartitions("block").mapInArrow(combined, "block bigint, bits binary")
        bits = np.zeros(max(self.ROWS * self.cells, BLOCK_CELLS) // 8, np.uint8)
        for row in blocks.toLocalIterator():
            low = row["block"] * BLOCK_CELLS // 8
            bits[low : low + BLOCK_CELLS // 8] = np.frombuffer(row["bits"], np.uint8)
        return bits

    def single(self, bits: np.ndarray, nodes: pa.Array) -> np.ndarray:
        """Whether a counter of the item is one, so that the item was put in once."""
        out = np.zeros(len(nodes), bool)
        for cells in self.cells_of(nodes):
            out |= bits[cells >> 3] & (128 >> (cells & 7)).astype(np.uint8) == 0
        return out


def screened(prefixes: DataFrame, most_cells: int, folder: str) -> DataFrame:
    """The prefixes with ``single``: proven by the sketch to belong to one conversation."""
    sketch = Sketch.for_items(prefixes.count(), most_cells)
    bits = prefixes.sparkSession.sparkContext.broadcast(sketch.build(prefixes))

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            single = sketch.single(bits.value, batch.column(2)) if batch.num_rows else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(single)], names=[*batch.schema.names, "single"])

    schema = "conv_id bigint, depth bigint, node binary, parent binary, words bigint, before bigint, is_end boolean, single boolean"
    return materialize(prefixes.mapInArrow(screen, schema), "screened", folder)


def hashed_ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of rows (node, conv_id): the hash of the ids in order, joined by commas.

    The ids of a node are sorted across tasks and packed into strings there; what one task hashes in order are these
    strings, one after the other, so neither its rows nor its memory follow the number of ids.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, 0, [], 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([first]), pa.array([",".join(held)])], names=["node", "first", "ids"])
        for batch in batches:
            for own, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (own != node or size > PART_BYTES):
                    yield out()
                    held, size = [], 0
                if not held:
                    node, first = own, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, h = None, None
        out = lambda: pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([h.hexdigest()])], names=["node", "ends_sha256"])
        for batch in batches:
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if h is not None and own == node:
                    h.update(b"," + ids.encode())
                    continue
                if h is not None:
                    yield out()
                node, h = own, hashlib.sha256(ids.encode())
        if h is not None:
            yield out()

    in_order = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    packed = in_order.mapInArrow(pack, "node binary, first bigint, ids string")
    return packed.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def conversation_trie(rows: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """The nodes of the trie over the conversations that ``rows`` (from ``rebuilt``) make up."""
    spark = rows.sparkSession
    with scratch(spark, "trie") as folder:
        everyone = materialize(rows.select("conv_id").distinct(), "ids", folder)
        found = screened(prefixes(rows, folder), most_cells, folder)
        # A tail starts at the first prefix that is proven single; whatever lies below is single too.
        tails = found.where("single")
        open_rows = found.where("NOT single")
        shared = open_rows.groupBy("node").agg(
            F.min("conv_id").alias("owner"),
            F.first("depth").alias("depth"),
            F.first("parent").alias("parent"),
            F.first("words").alias("words"),
            F.first("before").alias("before"),
            F.count("*").alias("n_convs"),
            F.count_if("is_end").alias("n_ends"),
            F.max(F.when(F.col("is_end"), F.col("conv_id"))).alias("an_end"),
        )
        shared = materialize(shared, "shared", folder)

        # Of each conversation: the depth from which it owns, the words before that, whether it owns a leaf.
        own = shared.select(F.col("owner").alias("conv_id"), "depth", "before", (F.col("n_convs") == F.col("n_ends")).alias("leaf"))
        alone = tails.select("conv_id", "depth", "before", F.col("is_end").alias("leaf"))
        past = found.where("is_end").select(
            "conv_id", (F.col("depth") + 1).alias("depth"), (F.col("before") + F.col("words")).alias("before"), F.lit(False).alias("leaf")
        )
        members = (
            own.unionByName(alone)
            .unionByName(past)
            .groupBy("conv_id")
            .agg(F.min("depth").alias("owns"), F.min_by("before", "depth").alias("others"), F.max("leaf").alias("leaf"))
        )
        members = materialize(members, "members", folder)

        below = (
            open_rows.select("conv_id", "node", "depth", "is_end")
            .join(members, "conv_id")
            .groupBy("node")
            .agg(
                F.sum(F.when(F.col("owns") > F.col("depth"), F.col("others")).otherwise(0)).alias("others"),
                F.count_if(~F.col("is_end") & (F.col("owns") <= F.col("depth") + 1)).alias("n_children"),
                F.count_if("leaf").alias("n_leaves"),
            )
        )
        turnless = everyone.join(members.select("conv_id"), "conv_id", "left_anti")
        root = F.lit(b"").cast("binary")
        ends = open_rows.where("is_end").select("node", "conv_id").unionByName(turnless.select(root.alias("node"), "conv_id"))
        hashes = materialize(hashed_ends(ends), "ends", folder)
        smallest, n_convs = everyone.agg(F.min("conv_id"), F.count("*")).first()
        root_ends = hashes.where(F.length("node") == 0).select("ends_sha256").first()
        owners = shared.select(F.col("node").alias("parent"), F.col("owner").alias("p_owner"))

        def parent_id(nodes: DataFrame, own_id: str) -> DataFrame:
            """Depth 1 hangs from the root; else the parent is shared, or single as the node itself."""
            upper = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(smallest).cast("bigint"))
            lower = nodes.where("depth > 1").join(owners, "parent", "left")
            lower = lower.withColumn("parent_conv_id", F.coalesce("p_owner", own_id)).drop("p_owner")
            return upper.unionByName(lower)

        joined = parent_id(shared.withColumnRenamed("owner", "conv_id"), "conv_id").join(below, "node").join(hashes, "node", "left")
        columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        saved = F.col("others") - (F.col("n_convs") - 1) * F.col("before")
        nodes = joined.withColumn("saved_tokens", saved)
        none = F.lit(ENDS_NONE)
        nodes = nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", none)).select(*columns)
        one = F.lit(1).cast("bigint")
        alone = (
            parent_id(tails, "conv_id")
            .withColumn("n_convs", one)
            .withColumn("n_children", F.when(F.col("is_end"), 0).otherwise(1).cast("bigint"))
            .withColumn("n_leaves", one)
            .withColumn("saved_tokens", F.lit(0).cast("bigint"))
            .withColumn("ends_sha256", F.when(F.col("is_end"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(none))
            .select(*columns)
        )
        top = members.agg(
            F.lit(smallest).cast("bigint").alias("conv_id"),
            F.lit(0).cast("bigint").alias("depth"),
            F.lit(None).cast("bigint").alias("parent_conv_id"),
            F.lit(n_convs).cast("bigint").alias("n_convs"),
            F.count_if(F.col("owns") == 1).alias("n_children"),
            F.greatest(F.count_if("leaf"), F.lit(1).cast("bigint")).alias("n_leaves"),
            F.coalesce(F.sum("others"), F.lit(0).cast("bigint")).alias("saved_tokens"),
            F.lit(root_ends[0] if root_ends else ENDS_NONE).alias("ends_sha256"),
        ).where(F.col("n_convs") > 0)
        return materialize(nodes.unionByName(alone).unionByName(top), "trie_nodes")
