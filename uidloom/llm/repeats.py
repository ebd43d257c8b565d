"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Every byte covered by a string of 100 bytes that also starts earlier is removed. Suffixes are compared through 100
bytes only, most significant digit first, and a suffix leaves as soon as its group has no other member:

1. The first digit of a suffix is the smallest 24-byte gram of its first 100 bytes and the offset of that gram. Equal
   strings have equal digits, and neighbouring suffixes share their gram, so one row (an anchor) stands for a
   run of 39 suffixes on average. Rows are grouped by gram; groups of one leave.
2. The second digit is the whole stretch that the suffixes of a row span. Rows with equal stretches are equal
   groups: all but the earliest are repeats. If the gram has one stretch only, the earliest leaves as well.
3. The last digit is each suffix of the rows that are left, to its full depth. Of equal ones all but the earliest
   are repeats. A gram with very many such rows is dealt out suffix by suffix first.

Whole texts that equal an earlier one are found by digest before the passes and take no part in them.

Earlier means a smaller document id, or an earlier start in the same document. Defined results: null text is empty;
rows without an id come last; rows that repeat an id come one after another, ordered by text; texts under 100 bytes
keep all bytes; very long texts are read whole. No rows give no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from uidloom.llm import textops
from uidloom.sources.session import materialize

LENGTH = 100
GRAM = 24
MANY = 4096
"""Rows of one gram that one task compares; the rows of larger groups are dealt out suffix by suffix."""

_LAST_ID = (1 << 63) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)
_ANCHORS = "again boolean, gram bigint, stretch bigint, doc bigint, at bigint, reach int"
_PASSED = "open boolean, gram bigint, doc bigint, at bigint, reach int"
_STRETCHES = "gram bigint, doc bigint, at bigint, reach int, stretch binary"
_SPANS = "doc bigint, dup bigint, low bigint, high bigint"


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    step = width - reach
    return np.minimum(values[: len(values) - step], values[step:]) if step else values


def anchors(texts: textops.Texts) -> tuple[np.ndarray, ...]:
    """Text, gram hash, place of the gram, first and last suffix, and stretch hash of each row of the first pass."""
    n = len(texts.data)
    sizes = np.diff(texts.ends)
    if n < LENGTH or sizes.max(initial=0) < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    sums = textops.prefix_hashes(texts.data)
    gram = (sums[GRAM:] - sums[:-GRAM]) * textops.powers(textops._INVERSE, n)[: n - GRAM + 1]
    bits = np.uint64(int(n).bit_length())
    place = np.arange(n - GRAM + 1, dtype=np.uint64)
    best = _smallest((gram >> bits << bits) | place, LENGTH - GRAM + 1)
    owner = (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    inside = np.zeros(n + 1, np.int32)  # suffixes with 100 bytes before the end of their text
    full = sizes >= LENGTH
    inside[texts.ends[:-1][full]] += 1
    inside[texts.ends[1:][full] - LENGTH + 1] -= 1
    suffix = np.flatnonzero(np.cumsum(inside[: len(owner)]))
    own = owner[suffix]
    new = np.ones(len(suffix), bool)
    new[1:] = (own[1:] != own[:-1]) | (suffix[1:] != suffix[:-1] + 1)
    begin = np.flatnonzero(new)
    first, last = suffix[begin], suffix[np.append(begin[1:], len(suffix)) - 1]
    at = own[begin]
    text = np.searchsorted(texts.ends, first, side="right") - 1
    stretch = textops.stretch_hashes(sums, first, last + LENGTH)
    stretch = textops.mix(stretch + (at - first).astype(np.uint64) * _ODD + (at - last).astype(np.uint64) * _ODD2)
    return text, textops.mix(gram[at]), at - texts.ends[text], first - texts.ends[text], last - texts.ends[text], stretch


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the first pass from (doc, dup, text).

    ``again`` marks rows with the gram and stretch of an earlier row of the batch. These are repeats already and are
    not shuffled, so a passage that very many documents share sends few rows to the task of its gram.
    """
    for batch in batches:
        docs, dups = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
        parts = []
        for texts in textops.chunks(batch.column(2)):
            text, gram, at, first, last, stretch = anchors(texts)
            row = text + texts.first
            reach = ((at - last) << 16 | (at - first)).astype(np.int32)
            parts.append((gram.view(np.int64), stretch.view(np.int64), docs[row], dups[row] << 32 | at, reach))
        if not parts:
            continue
        gram, stretch, doc, at, reach = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((at, doc, stretch, gram))
        same = (gram[order][1:] == gram[order][:-1]) & (stretch[order][1:] == stretch[order][:-1])
        again = np.zeros(len(order), bool)
        again[order[1:][same]] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (again, gram, stretch, doc, at, reach)], names=["again", "gram", "stretch", "doc", "at", "reach"]
        )


def _second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by gram, stretch, doc, at: repeats, and open rows of grams with several stretches.

    The state between batches is the last row, the stretches of its gram so far, and the one row that waits.
    """
    last: tuple[int, int] | None = None
    stretches, waiting = 0, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        gram, stretch = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        same_gram, same = np.zeros(n, bool), np.zeros(n, bool)
        same_gram[1:] = gram[1:] == gram[:-1]
        same[1:] = same_gram[1:] & (stretch[1:] == stretch[:-1])
        if last is not None:
            same_gram[0] = gram[0] == last[0]
            same[0] = same_gram[0] and stretch[0] == last[1]
        run = np.cumsum(~same_gram)
        count = np.bincount(run, ~same, minlength=int(run[-1]) + 1)
        count[0] += stretches if same_gram[0] else 0
        is_open = ~same & (count[run] > 1)
        rows = batch.select([0, 2, 3, 4])
        out = [(False, rows.filter(pa.array(same))), (True, rows.filter(pa.array(is_open)))]
        if waiting is not None and same_gram[0] and count[0] > 1:
            out.append((True, waiting))
        for kind, part in out:
            if part.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, kind)), *part.columns], names=["open", "gram", "doc", "at", "reach"])
        if run[-1] > 0 or not same_gram[0] or count[0] > 1:
            waiting = None
        own = np.flatnonzero((run == run[-1]) & ~same)
        if count[-1] == 1 and len(own):
            waiting = rows.slice(int(own[0]), 1)
        last, stretches = (gram[-1], stretch[-1]), int(count[-1])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the open rows of each text, from (doc, dup, text, rows); one of a large group becomes one row per suffix."""
    for batch in batches:
        docs, dups = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = batch.column(2).fill_null("")
        for k, rows in enumerate(batch.column(3)):
            values = rows.values
            raw = texts[k].as_buffer()
            data = memoryview(raw) if raw is not None else memoryview(b"")
            at, gram, reach = (values.field(c).to_numpy() for c in ("at", "gram", "reach"))
            large = values.field("large").to_numpy(zero_copy_only=False)
            grams, places, reaches, pieces = [], [], [], []
            for a, g, r, split in zip((at & 0xFFFFFFFF).tolist(), gram.tolist(), reach.tolist(), large.tolist()):
                low, high = r >> 16, r & 0xFFFF
                for lo, hi in [(o, o) for o in range(low, high + 1)] if split else [(low, high)]:
                    piece = bytes(data[a - hi : a - lo + LENGTH])
                    if split:
                        g = int.from_bytes(hashlib.blake2b(piece + bytes([lo]), digest_size=8).digest(), "little", signed=True)
                    grams.append(g)
                    places.append(int(dups[k]) << 32 | a)
                    reaches.append(lo << 16 | hi)
                    pieces.append(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.int64()), pa.array([int(docs[k])] * len(grams), pa.int64()), pa.array(places, pa.int64()),
                 pa.array(reaches, pa.int32()), pa.array(pieces, pa.binary())],
                names=["gram", "doc", "at", "reach", "stretch"],
            )


def _last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated stretches of documents from rows sorted by gram, doc, at. State: the suffixes of the last gram."""
    last, seen = None, np.zeros(0, np.uint64)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        gram, doc, at = (batch.column(k).to_numpy() for k in range(3))
        reach = batch.column(3).to_numpy().astype(np.int64)
        low, high = reach >> 16, reach & 0xFFFF
        data = textops.Texts(0, np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8), np.zeros(0))
        sums = textops.prefix_hashes(data.data)
        count = high - low + 1
        begin = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
        row = np.repeat(np.arange(n), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        suffix = textops.stretch_hashes(sums, begin[row] + step, begin[row] + step + LENGTH)
        offset = high[row] - step
        digit = textops.mix(suffix + gram.view(np.uint64)[row] * _ODD + offset.astype(np.uint64) * _ODD2)
        again = np.ones(len(digit), bool)
        again[np.unique(digit, return_index=True)[1]] = False
        goes_on = gram[row] == last if last is not None else np.zeros(len(row), bool)
        if goes_on.any():
            again[goes_on] |= np.isin(digit[goes_on], seen)
        ends = gram[row] == gram[-1]
        own = np.unique(digit[ends])
        seen = np.union1d(seen, own) if last is not None and gram[-1] == last else own
        last = gram[-1]
        hit = np.flatnonzero(again)
        if not len(hit):
            continue
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])
        first, final = hit[new], hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1]
        place = at[row[first]] & 0xFFFFFFFF
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[row[first]]), pa.array(at[row[first]] >> 32), pa.array(place - offset[first]),
             pa.array(place - offset[final] + LENGTH)],
            names=["doc", "dup", "low", "high"],
        )


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The result from (doc_id, text, copy, spans)."""
    for batch in batches:
        texts = batch.column(1).fill_null("")
        out: list[list] = [[], [], [], []]
        for k in range(batch.num_rows):
            raw = texts[k].as_buffer()
            data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
            copy, spans = batch.column(2)[k], batch.column(3)[k]
            change = np.zeros(len(data) + 1, np.int32)
            if copy.is_valid:
                change[0], change[-1] = 1, -1
            elif spans.is_valid:
                np.add.at(change, spans.values.field("low").to_numpy(), 1)
                np.add.at(change, spans.values.field("high").to_numpy(), -1)
            gone = np.cumsum(change)[:-1] > 0
            starts = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
            for column, value in zip(out, (len(data), int(gone.sum()), starts, hashlib.sha256(data[~gone].tobytes()).hexdigest())):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, doc, dup): a key of each row in the order of rows.

    ``dup`` counts the rows without an id, and those of a repeated id. Only these are sorted, over the whole cluster.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint"), "text", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST_ID)).alias("doc")
    )
    repeated = materialize(rows.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc"), "repeated_ids")
    if repeated.isEmpty():
        return rows.withColumn("dup", F.lit(0).cast("bigint"))
    order = [F.col("doc"), F.col("doc_id").isNull()]
    several = rows.join(repeated, "doc", "left_semi").repartitionByRange(*order, F.substring("text", 1, 64))
    several = several.sortWithinPartitions(*order, "text").withColumn("place", F.monotonically_increasing_id())
    several = materialize(several, "repeated_rows").withColumn("part", F.shiftright("place", 33))
    parts = several.groupBy("doc", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy("doc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    dup = (F.col("before") + F.col("place") - F.col("first")).alias("dup")
    several = several.join(parts, ["doc", "part"]).select("doc_id", "text", "doc", dup)
    return rows.join(repeated, "doc", "left_anti").select("doc_id", "text", "doc", F.lit(0).cast("bigint").alias("dup")).unionByName(several)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document what is left when all repeated strings are removed.

    The texts are written once, bucketed by row, so that every later pass reads them without a shuffle.
    """
    spark = docs.sparkSession
    table = f"repeat_texts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = ["doc", "dup"]
    (
        _keyed(docs).repartition(buckets, *row)
        .withColumn("digest", F.when(F.octet_length("text") >= LENGTH, F.sha2("text", 256)))
        .write.format("parquet").option("compression", "zstd")
        .bucketBy(buckets, *row).sortBy(*row).saveAsTable(table)
    )
    texts = spark.table(table)

    digests = texts.where("digest IS NOT NULL").select("doc", "dup", "digest")
    first = digests.groupBy("digest").agg(F.min(F.struct("doc", "dup")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = digests.join(first, "digest").where(F.struct("doc", "dup") != F.col("first"))
    copies = materialize(later.select(*row, F.lit(True).alias("copy")), "copies")

    fresh = texts.join(copies, row, "left_anti")
    sort = ["gram", "stretch", "doc", "at"]
    found = materialize(fresh.select("doc", "dup", "text").mapInArrow(_first_pass, _ANCHORS), "anchors")
    passed = found.where("NOT again").drop("again").repartition("gram").sortWithinPartitions(*sort)
    passed = materialize(passed.mapInArrow(_second_pass, _PASSED), "passed")

    left = passed.where("open").select("gram", "doc", "at", "reach")
    large = left.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > MANY).select("gram", F.lit(True).alias("large"))
    left = left.join(large, "gram", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    dup = F.shiftright("at", 32).alias("dup")
    by_row = left.groupBy("doc", dup).agg(F.collect_list(F.struct("gram", "at", "reach", "large")).alias("rows"))
    stretches = texts.join(by_row, row).select("doc", "dup", "text", "rows").mapInArrow(_stretches, _STRETCHES)
    spans = stretches.repartition("gram").sortWithinPartitions("gram", "doc", "at").mapInArrow(_last_pass, _SPANS)
    place, reach = F.col("at").bitwiseAND(0xFFFFFFFF), F.col("reach").cast("bigint")
    repeated = found.where("again").select("doc", "at", "reach").unionByName(passed.where("NOT open").select("doc", "at", "reach"))
    known = repeated.select(
        "doc",
        dup,
        (place - reach.bitwiseAND(0xFFFF)).alias("low"),
        (place - F.shiftright(reach, 16) + LENGTH).alias("high"),
    )
    gone = known.unionByName(spans).groupBy(*row).agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    answer = (
        texts.join(copies, row, "left").join(gone, row, "left")
        .select("doc_id", "text", "copy", "spans")
        .mapInArrow(_remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    )
    answer = materialize(answer, "repeats")
    spark.sql(f"DROP TABLE {table}")
    return answer
