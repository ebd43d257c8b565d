"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures, confirmed on full shingle sets.

1. A document's set holds its distinct five-word shingles. Documents with equal sets are one class, represented by
   the smallest id, so large groups of copies take part once.
2. A signature has 60 components of 16 bits, cut into 10 chunks of 6. For each chunk and each of its components a
   key leaves that component out, so two signatures share a key wherever a chunk differs in at most one
   component. By the pigeonhole principle all pairs that differ in at most 19 components share one. Pairs
   further apart are found as well if one chunk is close enough: at similarity 0.85 all ten chunks fail with
   probability 3e-7, at 0.8 with 2e-5.
3. Signatures that share a key are tied to the first holder of that key, never pair by pair, and the connected
   ties are the clusters within which links are looked for.
4. Within a cluster pairs are compared in tiles of bounded size: signatures first, then the full sets. A
   cluster of more than one tile is first compared with one block of leaders, then every document outside the
   largest component found is compared with all others. So no link between two components is missed, and pairs
   already known to be connected are not compared again.

Defined results: null and empty texts and texts without words have no set and are linked with nothing; a row
without an id is linked with nothing and has no component; rows that repeat an id are one node with the sets of
all these rows; very long texts are read whole. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from uidloom.llm import textops
from uidloom.llm.graph import components
from uidloom.sources.session import materialize

SHINGLE_WORDS = 5
CHUNKS = 10
PER_CHUNK = 6
COMPONENTS = CHUNKS * PER_CHUNK
RADIUS = 2 * CHUNKS - 1
"""Differing components up to which all pairs are sure to share a key."""
LOOK = 27
"""Differing components up to which a pair that met in a cluster is compared in full; more than that have a
probability of 3e-6 at similarity 0.8, and of 1e-9 at 0.85."""
TILE_ROWS = 512
TILE_SHINGLES = 1 << 19

_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, COMPONENTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.random.default_rng(6).integers(0, 1 << 63, (CHUNKS, PER_CHUNK, PER_CHUNK), dtype=np.uint64) | np.uint64(1)
_PLACES[:, np.arange(PER_CHUNK), np.arange(PER_CHUNK)] = 0
_KEY_SALT = np.arange(COMPONENTS, dtype=np.uint64).reshape(CHUNKS, PER_CHUNK) * np.uint64(0x9E3779B97F4A7C15)
_SIGNED = "doc_id bigint, n_shingles bigint, digest_a bigint, digest_b bigint, signature binary"


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16 bits of the smallest hash under each of the 60 orders; the sets are not empty."""
    flat = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), COMPONENTS), np.uint16)
    for k, factor in enumerate(_FACTORS):
        out[:, k] = textops.mix(np.minimum.reduceat(flat * factor, first)) >> np.uint64(48)
    return out


def sign(docs: DataFrame) -> DataFrame:
    """Per document the size, digest and signature of its set, all null or 0 for an empty one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            size, digests = np.zeros(n, np.int64), np.zeros((2, n), np.uint64)
            packed: list[bytes | None] = [None] * n
            for texts in textops.chunks(batch.column(1)):
                _, _, hashes, first = textops.words(texts)
                sets = textops.shingle_sets(hashes, first, SHINGLE_WORDS)
                own = [k for k, s in enumerate(sets) if len(s)]
                if not own:
                    continue
                full = [sets[k] for k in own]
                at = np.array(own) + texts.first
                size[at] = [len(s) for s in full]
                flat = np.concatenate(full)
                starts = np.cumsum([0, *map(len, full[:-1])])
                digests[0, at] = np.add.reduceat(textops.mix(flat ^ np.uint64(0x51ED270B)), starts)
                digests[1, at] = np.add.reduceat(textops.mix(flat + np.uint64(0x7F4A7C15F39C)), starts)
                for k, signature in zip(at.tolist(), signatures(full)):
                    packed[k] = signature.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), *(pa.array(d.view(np.int64)) for d in digests), pa.array(packed, pa.binary())],
                names=["doc_id", "n_shingles", "digest_a", "digest_b", "signature"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, _SIGNED)


def _keys_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all rows, in order; the row of each; whether it is the first of its key; and that first row."""
    raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, CHUNKS, 1, PER_CHUNK)
    keys = textops.mix((raw.astype(np.uint64) + np.uint64(1)) * _PLACES).sum(3, dtype=np.uint64)
    keys = textops.mix(keys + _KEY_SALT).reshape(-1)
    row = np.repeat(np.arange(batch.num_rows), COMPONENTS)
    order = np.argsort(keys, kind="stable")
    keys, row = keys[order], row[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    leader = row[new][np.cumsum(new) - 1]
    return keys, row, new, leader


def ties(signed: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all holders of a key, from rows (doc_id, signature).

    Holders within one batch are tied to its first one, which alone is shuffled by the key, so a key held by
    many documents makes few rows.
    """

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            _, row, new, leader = _keys_of(batch)
            pairs = np.unique(np.stack([leader[~new], row[~new]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(ids[pairs[0]]), pa.array(ids[pairs[1]])], names=["a", "b"])

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            keys, row, new, _ = _keys_of(batch)
            yield pa.RecordBatch.from_arrays([pa.array(keys[new].view(np.int64)), pa.array(ids[row[new]])], names=["key", "b"])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_lead = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            new[0] = last_key is None or keys[0] != last_key
            lead = np.where(new, ids, 0)
            place = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
            lead = np.where(place >= 0, ids[np.maximum(place, 0)], last_lead if last_lead is not None else 0)
            last_key, last_lead = keys[-1], lead[-1]
            yield pa.RecordBatch.from_arrays([pa.array(lead[~new]), pa.array(ids[~new])], names=["a", "b"])

    rows = signed.select("doc_id", "signature")
    keyed = rows.mapInArrow(firsts, "key bigint, b bigint").repartition("key").sortWithinPartitions("key", "b")
    edges = keyed.mapInArrow(across, "a bigint, b bigint")
    return edges.unionByName(rows.mapInArrow(within, "a bigint, b bigint"))


def shingle_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, cluster, blocks, signature, shingles, n) from (doc_id, text, cluster, blocks)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in textops.chunks(batch.column(1)):
                _, _, hashes, first = textops.words(texts)
                sets = textops.shingle_sets(hashes, first, SHINGLE_WORDS)
                own = np.array([k for k, s in enumerate(sets) if len(s)], np.int64)
                if not len(own):
                    continue
                full = [sets[k] for k in own]
                at = pa.array(own + texts.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at), batch.column(3).take(at),
                     pa.array([s.tobytes() for s in signatures(full)], pa.binary()),
                     pa.array([s.tobytes() for s in full], pa.binary()), pa.array([len(s) for s in full], pa.int64())],
                    names=["doc_id", "cluster", "blocks", "signature", "shingles", "n"],
                )

    return docs.mapInArrow(work, "doc_id bigint, cluster bigint, blocks int, signature binary, shingles binary, n bigint")


def _links_in_tile(tile: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links that connect the nodes of a tile as far as its pairs do. ``side`` 1 is compared with ``side`` 0 and 1."""
    ids = tile.column("doc_id").to_numpy()
    known = tile.column("component").to_numpy()
    side = tile.column("side").to_numpy()
    signature = np.frombuffer(b"".join(tile.column("signature").to_pylist()), np.uint16).reshape(-1, COMPONENTS)
    sets = [np.frombuffer(s, np.uint64) for s in tile.column("shingles").to_pylist()]
    size = np.array([len(s) for s in sets], np.int64)
    above = {int(c): int(c) for c in known}

    def root(x: int) -> int:
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    links = []
    everything = np.arange(len(ids))
    for i in np.flatnonzero(side == 1).tolist():
        small = np.minimum(size[i], size)
        fits = (known != known[i]) & (100 * small >= percent * np.maximum(size[i], size))
        fits &= (side == 0) | (everything > i)
        near = np.flatnonzero(fits)
        if not len(near):
            continue
        apart = (signature[near] != signature[i]).sum(1)
        close = np.argsort(apart, kind="stable")
        for k in close[: int((apart <= LOOK).sum())].tolist():
            j = int(near[k])
            a, b = root(int(known[i])), root(int(known[j]))
            if a == b:
                continue
            short, long = (sets[i], sets[j]) if size[i] <= size[j] else (sets[j], sets[i])
            at = np.searchsorted(long, short)
            at[at == len(long)] = 0
            common = int((long[at] == short).sum())
            if 100 * common >= percent * (len(short) + len(long) - common):
                above[max(a, b)] = min(a, b)
                links.append((int(ids[i]), int(ids[j])))
    return links


def tile_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) from rows (tile, other, doc_id, component, side, signature, shingles); a tile is bounded."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in textops.runs(batches, 3):
            found = _links_in_tile(tile, percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    by = ["cluster", "block", "other"]
    columns = [*by, "doc_id", "component", "side", "signature", "shingles"]
    return rows.select(*columns).repartition(*by).sortWithinPartitions(*by, "doc_id").mapInArrow(work, "a bigint, b bigint")


def links(docs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """Enough links (a, b) between class representatives ``signed`` to connect what all their links connect."""
    cluster = components(ties(signed)).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
    members = signed.select("doc_id", "n_shingles").join(cluster, "doc_id").groupBy("doc_id", "cluster").agg(F.sum("n_shingles").alias("n"))
    sizes = members.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("rows") / TILE_ROWS), F.ceil(F.col("shingles") / TILE_SHINGLES)).cast("int")
    placed = members.join(sizes.select("cluster", blocks.alias("blocks")), "cluster").select("doc_id", "cluster", "blocks")
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").join(placed, "doc_id").select("doc_id", "text", "cluster", "blocks")
    rows = materialize(shingle_rows(texts), "shingles").withColumn("place", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))

    # The leaders, block 0, meet each block; a cluster of one block is done with that.
    leads = F.col("place") == 0
    first = rows.select(
        "cluster", F.lit(0).alias("block"), "doc_id", F.col("doc_id").alias("component"), "place", "signature", "shingles",
        F.explode(F.when(leads, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("place"))).alias("other"),
    ).withColumn("side", F.when(leads & (F.col("other") > 0), 0).otherwise(1))
    found = materialize(tile_links(first, percent), "links")

    # In larger clusters, what is outside the largest component so far meets everything.
    large = rows.where("blocks > 1")
    if large.isEmpty():
        return found
    joined = components(found).withColumnRenamed("node", "doc_id")
    large = large.join(joined, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    counted = large.groupBy("cluster", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    largest = counted.groupBy("cluster").agg(
        F.max(F.struct("rows", "component"))["component"].alias("largest"), F.sum("rows").alias("all"),
        F.max("rows").alias("most"), F.sum("shingles").alias("shingles"),
    )
    rest = F.col("all") - F.col("most")
    outer = F.greatest(F.ceil(rest / TILE_ROWS), F.ceil(F.col("shingles") / TILE_SHINGLES * rest / F.col("all")))
    large = large.join(largest.select("cluster", "largest", outer.cast("int").alias("outer")).where("outer > 0"), "cluster")
    columns = ["cluster", "block", "other", "doc_id", "component", "side", "signature", "shingles"]
    against = large.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("outer") - 1))).withColumn("other", F.col("place"))
    outside = (
        large.where("component <> largest")
        .withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("outer")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    second = against.withColumn("side", F.lit(0)).select(*columns).unionByName(outside.withColumn("side", F.lit(1)).select(*columns))
    return found.unionByName(materialize(tile_links(second, percent), "links"))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Per document its component under links of at least ``percent`` similarity; the smallest id of each is kept."""
    signed = materialize(sign(docs), "signatures")
    by = ["digest_a", "digest_b", "n_shingles"]
    filled = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    best = filled.groupBy(*by).agg(F.min(F.struct("doc_id", "signature")).alias("best"))
    classes = materialize(best.select(*by, F.col("best.doc_id").alias("class_id"), F.col("best.signature").alias("signature")), "classes")
    chosen = classes.select(F.col("class_id").alias("doc_id"), "n_shingles", "signature")
    pairs = links(docs, chosen, percent)
    # Rows that repeat an id belong to one node, whatever their classes.
    repeated = filled.join(classes.drop("signature"), by).where("doc_id <> class_id").select(F.col("class_id").alias("a"), F.col("doc_id").alias("b"))
    twice = filled.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("b"))
    found = components(pairs.unionByName(repeated.join(twice, "b", "left_semi").select("a", "b")))
    found = found.select(F.col("node").alias("class_id"), "component")
    of_class = classes.drop("signature").join(found, "class_id", "left").select(*by, "class_id", F.coalesce("component", "class_id").alias("component_id"))
    linked = filled.select("doc_id", *by).join(of_class, by).select("doc_id", "n_shingles", "component_id")
    alone = signed.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    result = linked.unionByName(alone)
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
