"""Token ids of documents, packed into files in ascending order of their ids, and read back.

A text is cut into pieces at places where every pre-token ends, whatever stands around them; the library encodes
each distinct piece once, and equal pieces share its ids. The strings of added tokens, such as an end mark, are found
as the library finds them, each as a piece of its own. The files are Parquet rows, written by Spark to any
store it knows: a row is a page of whole documents with their ids in word-aligned packed blocks (``packing``),
the word offset of each block, the id and length of each document, and the count of ids in earlier pages of the
shard. Pages are ordered by (shard, page).

Defined results: a null text is empty, so its ids are the end id alone; null document ids come first; documents
with the same id are ordered by text; repeated rows are all written. No rows give no pages. Only the id and
text columns are read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from uidloom.llm import textops
from uidloom.llm.packing import pack, unpack
from uidloom.sources.session import shared_folder

PAGE_IDS = 1 << 16
CACHED_PIECES = 1 << 21
CACHED_BYTES = 1 << 26  # of long pieces
MOST_PIECES = 1 << 20  # looked up at once
SLOT_BITS = 22  # more slots than CACHED_PIECES + MOST_PIECES
CHUNK_BYTES = 1 << 22
SHORT_BYTES = 15
_LOW_BYTES = np.array([(1 << 8 * min(k, 8)) - 1 for k in range(SHORT_BYTES + 1)], np.uint64)
_HIGH_BYTES = np.array([(1 << 8 * max(k - 8, 0)) - 1 for k in range(SHORT_BYTES + 1)], np.uint64)
_LENGTH = np.arange(SHORT_BYTES + 1, dtype=np.uint64) << np.uint64(56)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)
PAGES = (
    "shard int, page int, first bigint, doc_ids array<bigint>, lengths array<int>, n_ids bigint, "
    "offsets array<int>, words binary"
)
DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

# Classes of bytes that decide where a pre-token surely ends. Other bytes make no claim.
_OTHER, _LETTER, _DIGIT, _MARK, _WHITE = range(5)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = _MARK
_CLASS[[32, 9, 10, 11, 12, 13]] = _WHITE
_LATIN_LEAD = 0xC3
_LATIN_MARKS = (0x97, 0xB7)


def piece_starts(texts: textops.Texts) -> np.ndarray:
    """Byte positions at which pieces start, all text starts among them.

    A pre-token is one run of letters, digits or marks with at most one space before it, or white space. So one
    ends (1) where white space follows anything else, (2) between a letter and a mark other than an apostrophe,
    and (3) after a single white space other than a space, as white space of two or more splits by what follows.
    """
    data, n = texts.data, len(texts.data)
    kind = _CLASS[data]
    letter = kind == _LETTER
    if n > 1:
        accented = (data[:-1] == _LATIN_LEAD) & (data[1:] >= 0x80)
        for mark in _LATIN_MARKS:
            accented &= data[1:] != mark
        letter[1:] |= accented
    known = letter | (kind == _DIGIT) | (kind == _MARK)
    opens = (kind != _OTHER) & (kind != _WHITE)
    opens[:-1] |= accented if n > 1 else False
    start = np.zeros(n + 1, bool)
    white = kind == _WHITE
    start[1:n] = known[:-1] & white[1:] | letter[:-1] & (kind[1:] == _MARK)
    alone = white & (data != 32)
    before = np.zeros(n, bool)
    before[1:] = known[:-1]
    before[texts.ends[:-1][texts.ends[:-1] < n]] = True
    start[1:n] |= (alone & before)[:-1] & opens[1:]
    start[texts.ends] = True
    return np.flatnonzero(start[:n])


def _short_keys(raw: bytes, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two words for each short piece that tell it from all others: its first 8 bytes, and the next 7 with its length."""
    padded = np.frombuffer(raw + bytes(16), np.uint8)
    words = np.ndarray(len(raw) + 9, "<u8", padded, strides=(1,))  # one from every byte on
    return words[start] & _LOW_BYTES[length], words[start + 8] & _HIGH_BYTES[length] | _LENGTH[length]


def _with_room(a: np.ndarray, n: int) -> np.ndarray:
    """The array, or a longer one that starts with it, for ``n`` entries at least."""
    return a if n <= len(a) else np.concatenate((a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)))


class Encoder:
    """Encodes texts with a tokenizer given as its JSON text; remembers the ids of pieces.

    With ``encode_special_tokens`` the strings of special tokens are ordinary text, as with the library's own setting.
    """

    def __init__(self, tokenizer_json: str, encode_special_tokens: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = encode_special_tokens
        added = [t for t in json.loads(tokenizer_json).get("added_tokens") or () if not (encode_special_tokens and t["special"])]
        found = sorted({t["content"].encode() for t in added if t["content"]}, key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, found))) if found else None
        #: What stands around such a token decides as well, so texts that hold one are not cut.
        self.whole = any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized"))
        self.forget()

    def forget(self) -> None:
        self.slots = np.zeros(1 << SLOT_BITS, np.int32)  # numbers of short pieces by hash, 0 where free
        self.long: dict[bytes, int] = {}  # numbers of the others
        self.long_bytes = 0
        self.numbers = 1
        self.low, self.high = np.zeros((2, 1 << 16), np.uint64)
        self.first, self.count = np.zeros((2, 1 << 16), np.int64)
        self.pool, self.pooled = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, number: int, pieces: list[str]) -> None:
        """Encode pieces whose numbers ascend from ``number``."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        stop = self.pooled + np.cumsum(count)
        self.first = _with_room(self.first, number + len(found))
        self.count = _with_room(self.count, number + len(found))
        self.first[number : number + len(found)] = stop - count
        self.count[number : number + len(found)] = count
        self.pool = _with_room(self.pool, int(stop[-1]))
        self.pool[self.pooled : stop[-1]] = np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum()))
        self.pooled = int(stop[-1])

    def _short(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each short piece, and places of the pieces that are new, in the order of their numbers."""
        h = low * _MIX[0] + high * _MIX[1]
        h ^= h >> np.uint64(32)
        h *= _MIX[2]
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        number, left, new = np.empty(len(low), np.int32), np.arange(len(low)), []
        while len(left):
            at = self.slots[slot]
            free = np.flatnonzero(at == 0)
            if len(free):  # of those that want a slot the last to write gets it
                self.slots[slot[free]] = free
                won = free[self.slots[slot[free]] == free]
                stop = self.numbers + len(won)
                self.slots[slot[won]] = np.arange(self.numbers, stop)
                self.low, self.high = _with_room(self.low, stop), _with_room(self.high, stop)
                self.low[self.numbers : stop], self.high[self.numbers : stop] = low[won], high[won]
                self.numbers = stop
                new.append(left[won])
                at[free] = self.slots[slot[free]]
            number[left] = at
            other = np.flatnonzero((self.low[at] != low) | (self.high[at] != high))
            left, low, high = left[other], low[other], high[other]
            slot = slot[other] + 1 & (1 << SLOT_BITS) - 1
        return number, np.concatenate(new) if new else left

    def _ids(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and how many each piece has."""
        if self.numbers > CACHED_PIECES or self.long_bytes > CACHED_BYTES:
            self.forget()
        known, raw = self.numbers, data[start[0] : end[-1]].tobytes()
        start, end = start - start[0], end - start[0]
        length = end - start
        short = np.flatnonzero(length <= SHORT_BYTES)
        number = np.empty(len(start), np.int64)
        number[short], new = self._short(*_short_keys(raw, start[short], length[short]))
        new = short[new].tolist()
        others = np.flatnonzero(length > SHORT_BYTES)
        for k, a, b in zip(others.tolist(), start[others].tolist(), end[others].tolist()):
            piece = raw[a:b]
            if piece not in self.long:
                self.long[piece] = self.numbers
                self.long_bytes += b - a
                self.numbers += 1
                new.append(k)
            number[k] = self.long[piece]
        if new:
            self._learn(known, [raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist())])
        count = self.count[number]
        take = np.repeat(self.first[number] - np.cumsum(count) + count, count)
        take += np.arange(len(take))
        return self.pool[take], count

    def _uncut(self, texts: textops.Texts) -> np.ndarray:
        """Start and end of each stretch that stays one piece: added tokens, the longest where several start."""
        raw, at, spans = texts.data.tobytes(), 0, []
        while self.added and (found := self.added.search(raw, at)):
            at = found.start()
            k = int(np.searchsorted(texts.ends, at, side="right"))
            end = int(texts.ends[k])
            found = self.added.match(raw, at, end)  # not across two texts
            if not found:
                at += 1
            elif self.whole:
                spans.append((int(texts.ends[k - 1]), end))
                at = end
            else:
                spans.append(found.span())
                at = found.end()
        return np.array(spans, np.int64).reshape(-1, 2)

    def _starts(self, texts: textops.Texts) -> np.ndarray:
        uncut = self._uncut(texts)
        if not len(uncut):
            return piece_starts(texts)
        start = piece_starts(textops.Texts(texts.first, texts.data, np.union1d(texts.ends, uncut)))
        low, high = uncut[np.maximum(np.searchsorted(uncut[:, 0], start, side="right") - 1, 0)].T
        return start[(start <= low) | (start >= high)]

    def encode(self, texts: textops.Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        if not len(texts.data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        start = self._starts(texts)
        end = np.append(start[1:], len(texts.data))
        found = [self._ids(texts.data, start[k : k + MOST_PIECES], end[k : k + MOST_PIECES]) for k in range(0, len(start), MOST_PIECES)]
        stop = np.cumsum(np.concatenate([count for _, count in found]))
        at_text = np.append(stop, 0)[np.searchsorted(start, texts.ends) - 1]
        return np.concatenate([ids for ids, _ in found]), np.diff(at_text, prepend=0)[1:]


_encoders: dict[int, Encoder] = {}


def encoder_of(tokenizer_json: str) -> Encoder:
    """One encoder for each Python worker, so that its pieces outlast a task."""
    key = hash(tokenizer_json)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer_json, encode_special_tokens=False)
    return _encoders[key]


def _page(shard: int, page: int, first: int, docs: list[tuple[int | None, np.ndarray]]) -> dict:
    ids = np.concatenate([x for _, x in docs])
    words, offsets = pack(ids)
    lengths = [len(x) for _, x in docs]
    return {
        "shard": shard, "page": page, "first": first, "doc_ids": [d for d, _ in docs], "lengths": lengths,
        "n_ids": len(ids), "offsets": offsets, "words": words.astype("<u8").tobytes(),
    }


_PAGE_TYPE = pa.schema([
    ("shard", pa.int32()), ("page", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("offsets", pa.list_(pa.int32())), ("words", pa.binary()),
])


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every text, add the end id, and write the pages to ``path``. The vocabulary file is read here only."""
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = encoder_of(vocabulary.value), TaskContext.get().partitionId()
        page, first, held, n = 0, 0, [], 0
        end = np.array([end_id], np.uint32)
        for batch in batches:
            keys, rows = batch.column(0).to_pylist(), []
            for texts in textops.chunks(batch.column(1), CHUNK_BYTES):
                ids, counts = encoder.encode(texts)
                for k, own in enumerate(np.split(ids, np.cumsum(counts)[:-1])):
                    held.append((keys[texts.first + k], np.concatenate((own, end))))
                    n += len(own) + 1
                    if n >= PAGE_IDS:
                        rows.append(_page(shard, page, first, held))
                        page, first, held, n = page + 1, first + n, [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _PAGE_TYPE)
                    rows = []
        if held:
            yield pa.RecordBatch.from_pylist([_page(shard, page, first, held)], _PAGE_TYPE)

    ordered = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    ordered = ordered.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, PAGES).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document its place in the ids of all files, its count, and the checksum of its ids.

    The driver holds one number for each shard, the ids in it.
    """
    pages = spark.read.schema(PAGES).parquet(path)
    totals = {r["shard"]: r["n"] for r in pages.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    before = dict(zip(sorted(totals), np.cumsum([0, *(totals[s] for s in sorted(totals))]).tolist()))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                words = np.frombuffer(row["words"], "<u8")
                ids = unpack(words, np.array(row["offsets"]), row["n_ids"]).astype("<u4")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                first = before[row["shard"]] + row["first"]
                raw, sums = memoryview(ids.tobytes()), []
                for a, b in zip((ends - lengths).tolist(), ends.tolist()):
                    sums.append(zlib.crc32(raw[4 * a : 4 * b]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(first + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return pages.mapInArrow(decode, DOCS)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/uidloom/{name}-{uuid.uuid4().hex}"
