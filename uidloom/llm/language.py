"""Language identification by words first: known words count by their log frequency in each language.

A word that the model does not know is looked up by its character n-grams, the longest that are known: n-grams
of five characters, else four, down to one, of the word with its two ends marked. A text gets the language with
the largest sum over its words; the score is that language's share when the sums are spread over the root of
the number of words.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is a text when no language
was learned; ties go to the language that is first by name; repeated rows get equal results; very long texts are
read whole. Rows without an id or language are not learned from. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from uidloom.llm import textops
from uidloom.llm.learning import crc_of_id

PER_LANGUAGE = 2000
"""Bound of the training sample: expected rows of each language, chosen by hash of their id."""
BROADCAST_ROWS = 100_000
LONGEST = 5
LEAST_COUNT = 2
UNKNOWN = "und"
RESULT = "doc_id bigint, lang_pred string, score double"
_COUNTS = "key bigint, size int, lang string, n bigint"
_STEP = np.uint64(0x2545F4914F6CDD1D)


def _grams(tokens: textops.Tokens, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of some words, and the position in ``rows`` of the word of each."""
    data = textops.LOWER[tokens.data]
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    low, high = np.searchsorted(lead, tokens.start[rows]), np.searchsorted(lead, tokens.end[rows])
    count = np.maximum(high - low + 2 - size + 1, 1)  # with a mark at either end
    owner = np.repeat(np.arange(len(rows)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    a, b = at - 1 + low[owner], at - 1 + low[owner] + size
    edge = (a < low[owner]).astype(np.uint64) + np.uint64(2) * (b > high[owner])
    a, b = np.maximum(a, low[owner]), np.minimum(b, high[owner])
    place = np.append(lead, len(data))
    h = textops.stretch_hashes(textops.prefix_hashes(data), place[a], np.maximum(place[b], place[a]))
    return textops.mix(h * _STEP + edge * np.uint64(8) + np.uint64(size)), owner


def _words(texts: textops.Texts) -> tuple[textops.Tokens, np.ndarray]:
    """All tokens, and which of them are words with something other than digits."""
    tokens = textops.Tokens(texts)
    digit = np.zeros(len(texts.data) + 1, np.int32)
    np.cumsum((texts.data >= 48) & (texts.data < 58), out=digit[1:])
    own = tokens.is_word & (digit[tokens.end] - digit[tokens.start] < tokens.end - tokens.start)
    return tokens, np.flatnonzero(own)


def count_words_and_grams(docs: DataFrame) -> DataFrame:
    """How often each word (size 0) and n-gram of a word occurs in each language of (text, lang) rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            names = sorted(set(langs))
            number = {name: i for i, name in enumerate(names)}
            for texts in textops.chunks(batch.column(0)):
                tokens, rows = _words(texts)
                own = np.array([number[langs[texts.first + k]] for k in range(len(texts))])[tokens.of_text()[rows]]
                for size in range(LONGEST + 1):
                    keys, owner = (tokens.hash[rows], np.arange(len(rows))) if size == 0 else _grams(tokens, rows, size)
                    for i, name in enumerate(names):
                        found, n = np.unique(keys[own[owner] == i], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(found.view(np.int64)), pa.array(np.full(len(found), size, np.int32)),
                             pa.array([name] * len(found), pa.string()), pa.array(n, pa.int64())],
                            names=["key", "size", "lang", "n"],
                        )

    return docs.mapInArrow(count, _COUNTS).groupBy("key", "size", "lang").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Per size a sorted table of keys with one log frequency for each language."""

    def __init__(self, languages: list[str], tables: list[tuple[np.ndarray, np.ndarray]]):
        self.languages, self.tables = languages, tables

    def _look_up(self, size: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, scores = self.tables[size]
        if not len(known):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys, at

    def word_scores(self, tokens: textops.Tokens, rows: np.ndarray) -> np.ndarray:
        """Log frequencies of some words, by language."""
        out = np.zeros((len(rows), len(self.languages)))
        found, at = self._look_up(0, tokens.hash[rows])
        out[found] = self.tables[0][1][at[found]]
        left = np.flatnonzero(~found)
        for size in range(LONGEST, 0, -1):
            if not len(left):
                break
            keys, owner = _grams(tokens, rows[left], size)
            found, at = self._look_up(size, keys)
            known = np.bincount(owner[found], minlength=len(left))
            for k in range(len(self.languages)):
                total = np.bincount(owner[found], self.tables[size][1][at[found], k], len(left))
                out[left, k] = total / np.maximum(known, 1)
            left = left[known == 0]
        return out

    def predict(self, texts: textops.Texts) -> tuple[list[str], np.ndarray]:
        tokens, rows = _words(texts)
        n, labels = len(texts), len(self.languages)
        if not labels:
            return [UNKNOWN] * n, np.zeros(n)
        _, sample, which = np.unique(tokens.hash[rows], return_index=True, return_inverse=True)
        by_word = self.word_scores(tokens, rows[sample])
        owner = tokens.of_text()[rows]
        totals = np.stack([np.bincount(owner, by_word[which, k], n) for k in range(labels)], 1)
        count = np.bincount(owner, minlength=n)
        best = totals.argmax(1)
        spread = (totals - totals.max(1, keepdims=True)) / np.sqrt(np.maximum(count, 1))[:, None]
        score = 1 / np.exp(spread).sum(1)
        plain = np.zeros(len(texts.data) + 1, np.int64)
        np.cumsum(textops.IS_LETTER[texts.data], out=plain[1:])
        letters = np.diff(plain[texts.ends]) > 0
        for k in np.flatnonzero(~letters).tolist():  # no ASCII letter: look at the characters
            text = texts.data[texts.ends[k] : texts.ends[k + 1]].tobytes().decode()
            letters[k] = any(c.isalpha() for c in text)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist())]
        return names, np.where(letters, score, 0.0)


def train(docs: DataFrame, allowed: Column | None = None, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Learn from a sample by hash of the id of rows with a language; ``allowed`` says which may be learned from."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(allowed) if allowed is not None else rows
    sizes = rows.groupBy("lang").agg(F.count("*").alias("_rows"))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.select("doc_id", "lang", place.alias("_place")).join(sizes, "lang")
    chosen = chosen.where(F.col("_place") * F.col("_rows") < per_language).select("doc_id").distinct()
    if len(chosen.take(BROADCAST_ROWS + 1)) <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    counts = count_words_and_grams(rows.select("doc_id", "text", "lang").join(chosen, "doc_id").select("text", "lang"))
    totals = counts.groupBy("key", "size").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    kept = totals.where(F.col("all") >= LEAST_COUNT).drop("all").toArrow()
    size = kept.column("size").to_numpy()
    keys = kept.column("key").to_numpy().view(np.uint64)
    by = kept.column("by").combine_chunks()
    lists = by.offsets.to_numpy()
    owner = np.repeat(np.arange(len(size)), np.diff(lists))
    entry_lang, entry_n = by.keys.to_pylist(), by.items.to_numpy()
    languages = sorted(set(entry_lang))
    number = {name: i for i, name in enumerate(languages)}
    column = np.fromiter((number[x] for x in entry_lang), np.int64, len(entry_lang))
    table = np.zeros((len(size), len(languages)))
    table[owner, column] = entry_n
    tables = []
    for s in range(LONGEST + 1):
        own = table[size == s]
        logs = np.log((own + 0.5) / (own.sum(0) + 0.5 * max(len(own), 1)))
        order = np.argsort(keys[size == s])
        tables.append((keys[size == s][order], logs[order].astype(np.float32)))
    return LanguageModel(languages, tables)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Per row its id, language and score. The model's size follows its bounded sample."""
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.tables))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageModel(*held.value)
        for batch in batches:
            names, scores = [], []
            for texts in textops.chunks(batch.column(1)):
                lang, score = own.predict(texts)
                names += lang
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(np.concatenate(scores or [np.zeros(0)]))],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(predict, RESULT)


def may_learn(doc_id: Column) -> Column:
    return crc_of_id(doc_id) % 4 != 2
