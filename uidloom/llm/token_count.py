"""Token counts of texts by two finite-state transducers compiled from a byte-level BPE tokenizer.

The first one finds where a pre-token starts. Its letters are classes of code points with one code point of lookahead,
and it has nine states, so the effect of a chunk of text is a map from nine states to nine. The chunks of a batch are
run side by side from every state, their maps are composed by a parallel prefix scan, and with each chunk's true
first state known they are run once more for the starts.

The second one reads the bytes of a pre-token, and its transitions carry the change in the number of tokens. After
each byte the encoding of what was read ends in one token, and that token is the one whose start is the end of a
shorter prefix with a last token that it may follow. So a state holds, for every earlier place at which an unfinished
token may have started, its place in the trie of tokens, the last token before it, and the number of tokens there
against the present one. States and transitions are compiled when a text first needs them, and kept by each Python
worker up to a bound; beyond it they are dropped and compiled anew, which changes no result.

Which class a code point has is asked of the tokenizer library; its vocabulary file is read by the driver.

Defined results: null text counts as empty and has 0 tokens; ids may be null or repeated, each row gives one row;
strings of added tokens inside a text count as one token each, as with the library's plain call; no rows give no
rows. Only the id and text columns are read. Rows stay where they are, there is no shuffle.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from uidloom.llm import textops

CHUNK_BYTES = 1 << 20
MOST_STATES = 1 << 18
FEW = 24
"""Pre-tokens still open below which they are read one after the other."""
COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"

# Classes of code points, the letters of the first transducer.
LETTER, DIGIT, MARK, QUOTE, BLANK, LAST_BLANK, WHITE, LAST_WHITE, SHORT, OPENS, ADDED = range(11)
N_CLASSES = 11
FIRST = N_CLASSES
"""Added to the class of a text's first code point, which forgets the state."""

# Its states: what the open pre-token is.
BEGIN, IN_LETTERS, IN_DIGITS, IN_MARKS, AT_QUOTE, IN_PAIR, DONE, JOINS, IN_WHITE = range(9)
N_STATES = 9
_UNKNOWN = 255


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a pre-token starts at the code point, by class and state.

    Pre-tokens are runs of letters, digits or other marks with at most one blank before them; the endings 's 't 'm 'd
    're 've 'll after no mark or blank; and white space, of which the last one before a text stands apart.
    """
    follow = np.zeros((2 * N_CLASSES, N_STATES), np.uint8)
    starts = np.ones((2 * N_CLASSES, N_STATES), bool)
    opened = {LETTER: IN_LETTERS, SHORT: IN_LETTERS, OPENS: IN_LETTERS, DIGIT: IN_DIGITS, MARK: IN_MARKS, QUOTE: AT_QUOTE}
    stays = {
        IN_LETTERS: dict.fromkeys((LETTER, SHORT, OPENS), IN_LETTERS),
        IN_DIGITS: {DIGIT: IN_DIGITS},
        IN_MARKS: {MARK: IN_MARKS, QUOTE: IN_MARKS},
        AT_QUOTE: {MARK: IN_MARKS, QUOTE: IN_MARKS, SHORT: DONE, OPENS: IN_PAIR},
        IN_PAIR: dict.fromkeys((LETTER, SHORT, OPENS), DONE),
        JOINS: opened | {QUOTE: IN_MARKS},
    }
    for state in range(N_STATES):
        for kind, into in opened.items():
            follow[kind, state] = stays.get(state, {}).get(kind, into)
            starts[kind, state] = kind not in stays.get(state, {})
        for kind in (BLANK, WHITE, LAST_BLANK, LAST_WHITE):
            follow[kind, state] = JOINS if kind == LAST_BLANK else IN_WHITE
            starts[kind, state] = state not in (JOINS, IN_WHITE) or kind in (LAST_BLANK, LAST_WHITE)
        follow[ADDED, state] = BEGIN
    follow[N_CLASSES:] = follow[:N_CLASSES, BEGIN : BEGIN + 1]
    return follow, starts


_FOLLOW, _STARTS = _splitter()


def compose(maps: np.ndarray) -> np.ndarray:
    """Row k of the result applies the rows 0 to k in turn: a prefix scan in as many steps as the count has bits."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], axis=1)
        step *= 2
    return out


def start_flags(kinds: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point, from their classes."""
    n = len(kinds)
    width = max(16, int(n**0.5))
    lanes = -(-n // width)
    padded = np.full(lanes * width, FIRST + ADDED, np.intp)
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(lanes, width).T) * N_STATES
    follow = _FOLLOW.ravel()
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8), (lanes, 1))
    for column in columns:
        maps = follow[column[:, None] + maps]
    state = np.zeros(lanes, np.uint8)
    state[1:] = compose(maps)[:-1, BEGIN]
    flags, starts = np.empty((width, lanes), bool), _STARTS.ravel()
    for k, column in enumerate(columns):
        at = column + state
        flags[k] = starts[at]
        state = follow[at]
    return flags.T.ravel()[:n]


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible Latin-1 as it is, the rest from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Merges:
    """The merge rules, and which token may stand after which."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        letters = byte_of_letter()
        raw = lambda token: bytes(letters[c] for c in token)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
        self.made = {a + b: (a, b) for a, b in self.rank}
        born = {a + b: k for (a, b), k in self.rank.items()}
        # Each token comes of one rule, which stands after the rules of its parts.
        self.in_order = len(born) == len(self.rank) and all(
            born.get(a, -1) < k and born.get(b, -1) < k for (a, b), k in self.rank.items()
        )
        self.edges: dict[tuple[bytes, int], list[tuple[bytes, int]]] = {}
        self.follows: dict[tuple[bytes, bytes], bool] = {}
        self.kids: list[dict[int, int]] = [{}]
        self.token: list[bytes | None] = [None]
        for name in vocabulary:
            node, token = 0, raw(name)
            for byte in token:
                if byte not in self.kids[node]:
                    self.kids[node][byte] = len(self.kids)
                    self.kids.append({})
                    self.token.append(None)
                node = self.kids[node][byte]
            self.token[node] = token

    def encode(self, text: bytes) -> list[bytes]:
        """Merge the pair of lowest rank, the first of equal ones, until none is left."""
        parts = [text[k : k + 1] for k in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self.rank.get(p, 1 << 60), k) for k, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, last: bytes, token: bytes) -> bool:
        key = (last, token)
        found = self.follows.get(key)
        if found is None:
            if not last or not self.in_order:
                found = self.encode(last + token) == ([last, token] if last else [token])
            else:
                found = self.may_follow(b"", token) and not self._meet(last, token)
            self.follows[key] = found
        return found

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at one end of a token while it is made, each with the rank of the rule that ends it."""
        found = self.edges.get((token, side))
        if found is None:
            part, until, found = token, 1 << 60, []
            while part in self.made:
                found.append((part, until))
                until = self.rank[self.made[part]]
                part = self.made[part][side]
            found.append((part, until))
            found.reverse()
            self.edges[token, side] = found
        return found

    def _meet(self, last: bytes, token: bytes) -> bool:
        """Whether a rule joins the right end of one token with the left end of the next while both are made.

        Of equal ranks the rule that stands first in the text is taken first.
        """
        left, right = self._edge(last, 1), self._edge(token, 0)
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = left[i], right[j]
            rank = self.rank.get((a, b))
            if rank is not None and rank < a_until and rank <= b_until:
                return True
            if i + 1 == len(left) and j + 1 == len(right):
                return False
            if a_until <= b_until and i + 1 < len(left):
                i += 1
            else:
                j += 1


_SHIFT = 16
_ZERO = 1 << (_SHIFT - 1)


class Transducer:
    """Counts the tokens of pre-tokens; compiled as far as the texts have needed.

    A state is a tuple of (trie node, last token, tokens there less tokens now) for each place where an unfinished
    token may have started, the present place last. ``moves`` give, by state and byte, the next state and the change
    in one number. ``keys`` and ``values`` hold the same moves in a hash table that numpy reads.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        self.forget()

    def forget(self) -> None:
        start = ((0, b"", 0),)
        self.ids, self.states = {start: 0}, [start]
        self.moves: dict[int, int] = {}
        self.merges.follows.clear()
        self._table(1 << 14)

    def _table(self, size: int) -> None:
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        self.bits, self.used = 64 - int(size).bit_length() + 1, 0
        if n := len(self.moves):
            self._insert(np.fromiter(self.moves.keys(), np.int64, n), np.fromiter(self.moves.values(), np.int64, n))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.bits)).astype(np.int64)

    def _insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.used += len(keys)
        slots, mask = self._slots(keys), len(self.keys) - 1
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys  # of several that met in a free slot one has it
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & mask

    def move(self, state: int, byte: int) -> int:
        """The next state and the change in the number of tokens, as one number."""
        found = self.moves.get(state << 8 | byte)
        if found is not None:
            return found
        kids, tokens, may_follow = self.merges.kids, self.merges.token, self.merges.may_follow
        token, change, live = None, 0, []
        for node, last, less in self.states[state]:
            child = kids[node].get(byte)
            if child is None:
                continue
            if token is None and tokens[child] is not None and may_follow(last, tokens[child]):
                token, change = tokens[child], less + 1
            if kids[child]:
                live.append((child, last, less))
        if token is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        if change:
            live = [(node, last, less - change) for node, last, less in live]
        live.append((0, token, 0))
        at = self.ids.setdefault(tuple(live), len(self.states))
        if at == len(self.states):
            self.states.append(tuple(live))
        found = self.moves[state << 8 | byte] = at << _SHIFT | change + _ZERO
        return found

    def _steps(self, keys: np.ndarray) -> np.ndarray:
        """The moves of many keys (state * 256 + byte), new ones compiled on the way."""
        out, mask = np.empty(len(keys), np.int64), len(self.keys) - 1
        slots, left = self._slots(keys), None
        while True:
            mine = keys if left is None else keys[left]
            there = self.keys[slots]
            hit = there == mine
            if left is None:
                np.copyto(out, self.values[slots], where=hit)
            else:
                out[left[hit]] = self.values[slots[hit]]
            if hit.all():
                return out
            rest = np.flatnonzero(~hit)
            absent = there[rest] == -1
            if absent.any():
                fresh = np.unique(mine[rest[absent]])
                made = np.array([self.move(k >> 8, k & 255) for k in fresh.tolist()], np.int64)
                if 2 * (self.used + len(fresh)) > len(self.keys):
                    self._table(4 * len(self.keys))
                else:
                    self._insert(fresh, made)
                left = rest if left is None else left[rest]
                slots, mask = self._slots(keys[left]), len(self.keys) - 1
                continue
            left, slots = (rest if left is None else left[rest]), (slots[rest] + 1) & mask

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of tokens of each stretch of ``data``."""
        if len(self.states) > MOST_STATES:
            self.forget()
        length = end - start
        order = np.argsort(-length, kind="stable")
        start, falling = start[order], -length[order]
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        k, many = 0, len(order)
        while many:
            many = int(np.searchsorted(falling, -k, side="left"))
            if many <= FEW:
                break
            found = self._steps(state[:many] * 256 + data[start[:many] + k])
            state[:many] = found >> _SHIFT
            total[:many] += (found & ((1 << _SHIFT) - 1)) - _ZERO
            k += 1
        for i in range(many):
            at, tokens = int(state[i]), 0
            for byte in data[start[i] + k : start[i] - falling[i]].tolist():
                found = self.moves.get(at << 8 | byte) or self.move(at, byte)
                at = found >> _SHIFT
                tokens += (found & ((1 << _SHIFT) - 1)) - _ZERO
            total[i] += tokens
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


class Counter:
    """Both transducers of a tokenizer given as its JSON text."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        split, model = spec["pre_tokenizer"] or {}, spec["model"]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if not plain or spec["normalizer"] or model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only byte-level BPE without normalizer, prefix space or dropout can be compiled")
        added = [t for t in spec.get("added_tokens") or () if t["content"]]
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that depend on what stands around them can't be compiled")
        longest_first = sorted((t["content"].encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, longest_first))) if added else None
        self.split = Tokenizer.from_str(tokenizer_json).pre_tokenizer.pre_tokenize_str
        self.kinds = np.full(0x110000, _UNKNOWN, np.uint8)
        self.transducer = Transducer(Merges(model["vocab"], model["merges"]))

    def _kind(self, code: int) -> int:
        for before, kind in (("a", LETTER), ("1", DIGIT), ("!", MARK)):
            if len(self.split(before + chr(code))) == 1:
                return QUOTE if code == 39 else kind
        return BLANK if code == 32 else WHITE

    def _classes(self, codes: np.ndarray, first: np.ndarray, added: np.ndarray) -> np.ndarray:
        kinds = self.kinds[codes]
        if (unknown := kinds == _UNKNOWN).any():
            for code in np.unique(codes[unknown]).tolist():
                self.kinds[code] = self._kind(code)
            kinds = self.kinds[codes]
        text = (kinds != BLANK) & (kinds != WHITE)
        followed = np.zeros(len(codes), bool)
        followed[:-1] = text[1:] & ~first[1:] & ~added[1:]
        kinds[followed & ~text] += 1  # the last white space before a text
        after = np.zeros(len(codes), codes.dtype)
        after[:-1] = np.where(followed[:-1], codes[1:], 0)
        kinds[(codes == 115) | (codes == 116) | (codes == 109) | (codes == 100)] = SHORT
        kinds[((codes == 114) | (codes == 118)) & (after == 101) | (codes == 108) & (after == 108)] = OPENS
        kinds[added] = ADDED
        kinds[first] += FIRST
        return kinds

    def pieces(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of each pre-token of some texts, and the start bytes of added tokens.

        The last entries of the starts and ends close the data.
        """
        lead = (data & 0xC0) != 0x80
        at = np.flatnonzero(lead)
        codes = code_points(data, at)
        first, added = np.zeros(len(at), bool), np.zeros(len(at), bool)
        text_starts = ends[:-1][ends[:-1] < ends[1:]]
        first[np.searchsorted(at, text_starts)] = True
        marks = []
        raw = data.tobytes() if self.added else b""
        if self.added and self.added.search(raw):
            for low, high in zip(ends[:-1].tolist(), ends[1:].tolist()):
                for m in self.added.finditer(raw, low, high):
                    added[np.searchsorted(at, m.start()) : np.searchsorted(at, m.end())] = True
                    marks.append(m.start())
        kinds = self._classes(codes, first, added)
        cuts = np.flatnonzero(start_flags(kinds))
        bounds = np.append(at[cuts], len(data))
        real = ~added[cuts]
        return bounds[:-1][real], bounds[1:][real], np.array(marks, np.int64)

    def count(self, texts: textops.Texts) -> np.ndarray:
        """The number of tokens of each text."""
        total = np.zeros(len(texts), np.int64)
        if len(texts) == 1 and len(texts.data) > CHUNK_BYTES:
            total[0] = self._count_long(texts.data)
        elif len(texts.data):
            start, end, marks = self.pieces(texts.data, texts.ends)
            tokens = self.transducer.count(texts.data, start, end)
            of = np.searchsorted(texts.ends, start, side="right") - 1
            total += np.bincount(of, tokens, len(texts)).astype(np.int64)
            if len(marks):
                total += np.bincount(np.searchsorted(texts.ends, marks, side="right") - 1, minlength=len(texts))
        return total

    def _count_long(self, data: np.ndarray) -> int:
        """A long text in sections that end where a pre-token surely starts, so memory follows the section."""
        longest = 64 + max((len(t) for t in re.findall(rb"[^|]+", self.added.pattern)), default=0) if self.added else 64
        low, size, total = 0, CHUNK_BYTES, 0
        while low < len(data):
            high = min(low + size, len(data))
            while high < len(data) and data[high] & 0xC0 == 0x80:
                high += 1
            start, end, marks = self.pieces(data[low:high], np.array([0, high - low]))
            stop = high - low
            if high < len(data):
                # What stands at the end of a section may read otherwise with what follows it.
                safe = np.concatenate((start, marks))
                safe = safe[(safe > 0) & (safe < stop - longest)]
                if not len(safe):
                    size *= 2
                    continue
                stop = int(safe.max())
            inside = start < stop
            total += int(self.transducer.count(data[low:high], start[inside], end[inside]).sum()) + int((marks < stop).sum())
            low, size = low + stop, CHUNK_BYTES
        return total


def code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points of UTF-8 whose first bytes stand at ``at``."""
    head = data[at].astype(np.int32)
    codes = head.copy()
    padded = np.concatenate((data, np.zeros(3, np.uint8)))
    for lowest, bits, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        wide = np.flatnonzero((head >= lowest) & (head < (lowest | (bits + 1))))
        code = head[wide] & bits
        for k in range(1, more + 1):
            code = code << 6 | (padded[at[wide] + k].astype(np.int32) & 0x3F)
        codes[wide] = np.minimum(code, 0x10FFFF)
    return codes


_counters: dict[int, Counter] = {}


def counter_of(tokenizer_json: str) -> Counter:
    """One counter for each Python worker, so that what is compiled outlasts a task."""
    key = hash(tokenizer_json)
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(tokenizer_json)
    return _counters[key]


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row its id, UTF-8 bytes, tokens, and whether these are more than ``limit``."""
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary.value)
        for batch in batches:
            tokens, sizes = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for texts in textops.chunks(batch.column(1), CHUNK_BYTES):
                rows = slice(texts.first, texts.first + len(texts))
                tokens[rows], sizes[rows] = counter.count(texts), np.diff(texts.ends)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.selectExpr(f"CAST(`{id_column}` AS bigint) AS doc_id", f"`{text_column}` AS text")
    return rows.mapInArrow(run, COUNTS)
