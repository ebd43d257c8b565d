"""Grouping of spelling variants: words that differ by one code point, found by walking a trie held in tables.

The trie is compressed: its nodes are the prefixes after which words part or end, and the prefix of half a word's
length. An edge leads from a node to the next one and carries the code points between. A state (word, position,
node, edits) says that the word up to the position reads as the node with so many edits. The states without an edit
are the nodes on each word's own path. At the node where two words part, the one edit is made: a code point is
replaced, which takes another edge, or deleted. From there the states meet the edge table level by level, as long
as the labels agree. States that end on a word are neighbours.

Edits lie at or after the middle of the word; a second trie of the reversed words covers the other half. So no state
ever stands on the first nodes, which all words share. Words with one code point more than another are found as the
other's neighbours only through deletions, and each pair counts both ways. Nodes are known by a 61-bit hash; a
shared hash could only add candidates, and every candidate is compared as text.

Defined results: null text holds no words, a null id reads as an empty string before the colon; repeated rows are
counted as often as they stand; no rows, or no word with enough occurrences, give no rows; a run of letters of any
length is one word. Of equally frequent neighbours the first by code points is the form. Only the id and text columns
are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from uidloom.sources.session import materialize, scratch

LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 7
LEAST_COUNT = 2
DAMAGED = 31
TIMES = 10

_PRIME = (1 << 61) - 1
_BASE = 1_117_402_643_517_884_231


def damaged(doc_id: Column, run: Column) -> Column:
    """The lower-cased run; where its checksum with the document id says so, without one of its code points."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.char_length(run)).cast("int")
    return F.when(
        F.pmod(h, F.lit(DAMAGED)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    ).otherwise(run)


def word_counts(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(word, n): the distinct words that are long and frequent enough."""
    runs = F.regexp_extract_all(F.col(text_column), F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.explode(runs).alias("run"))
    word = damaged(F.col("doc_id"), F.translate("run", UPPER, LOWER))
    counted = rows.select(word.alias("word")).where(F.char_length("word") >= least_length)
    return counted.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _prefixes(lowest: int):
    """Arrow function: each word's prefixes from ``lowest`` code points on, as rolling hashes, in one pass over it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, depths, nodes, nexts, stops = [], [], [], [], []
            for wid, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = list(map(ord, word))
                h, n, half = 0, len(codes), len(codes) // 2
                for depth, code in enumerate(codes, 1):
                    h = (h * _BASE + code) % _PRIME
                    if depth >= lowest:
                        depths.append(depth)
                        nodes.append(h)
                        nexts.append(codes[depth] if depth < n else 0)
                        stops.append(depth == half or depth == n)
                ids += [wid] * (len(depths) - len(ids))
                if len(ids) > 1 << 16:
                    yield _prefix_batch(ids, depths, nodes, nexts, stops)
                    ids, depths, nodes, nexts, stops = [], [], [], [], []
            if ids:
                yield _prefix_batch(ids, depths, nodes, nexts, stops)

    return run


def _prefix_batch(ids: list, depths: list, nodes: list, nexts: list, stops: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(depths, pa.int32()), pa.array(nodes, pa.int64()), pa.array(nexts, pa.int32()), pa.array(stops)],
        names=["wid", "depth", "node", "next", "stop"],
    )


def _after(word: str | Column, start: str | Column, length: str | Column) -> Column:
    """``length`` code points of the word after the first ``start``."""
    as_column = [F.col(c) if isinstance(c, str) else c for c in (word, start, length)]
    return F.substring(as_column[0], as_column[1] + 1, as_column[2])


class Trie:
    """The tables of one compressed trie over ``words`` (wid, word, n), in ``folder``.

    ``states``: (word, n, pos, node), the states without an edit from the middle of each word on.
    ``edges``: (parent, child, label, length, first, ends, nexts), with the label's first code point, whether a word ends at the
    child, and the first code points of the edges that leave it. ``ends``: (node, near, near_n), the word of a node.
    """

    def __init__(self, words: DataFrame, lowest: int, folder: str):
        rows = words.select("wid", "word").mapInArrow(
            _prefixes(lowest), "wid bigint, depth int, node bigint, next int, stop boolean"
        )
        rows = materialize(rows, "prefixes", folder)
        parts = rows.groupBy("node").agg(
            F.min("next").alias("low"), F.max("next").alias("high"), F.max("stop").alias("stop")
        )
        nodes = parts.where("stop OR low <> high").select("node")
        on_path = rows.select("wid", "depth", "node").join(nodes, "node")
        paths = on_path.groupBy("wid").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("path"))
        paths = materialize(words.join(paths, "wid"), "paths", folder)
        steps = F.arrays_zip(
            F.slice("path", F.lit(1), F.size("path") - 1).alias("a"), F.slice("path", F.lit(2), F.size("path")).alias("b")
        )
        step = paths.select("word", F.explode(steps).alias("s")).select(
            F.col("s.a.node").alias("parent"),
            F.col("s.b.node").alias("child"),
            _after("word", F.col("s.a.depth"), F.col("s.b.depth") - F.col("s.a.depth")).alias("label"),
            (F.char_length("word") == F.col("s.b.depth")).alias("ends"),
        )
        step = step.groupBy("parent", "child", "label").agg(F.max("ends").alias("ends"))
        step = materialize(step.withColumn("first", F.ascii(F.col("label"))), "steps", folder)
        below = step.groupBy(F.col("parent").alias("child")).agg(F.collect_set("first").alias("nexts"))
        edges = step.join(below, "child", "left").withColumn("length", F.char_length("label"))
        self.edges = materialize(edges, "edges", folder)
        half = F.floor(F.char_length("word") / 2)
        self.states = paths.select("word", "n", F.explode("path").alias("p")).select(
            "word", "n", F.col("p.depth").alias("pos"), F.col("p.node").alias("node")
        ).where(F.col("pos") >= half)
        self.ends = paths.select(
            F.element_at("path", -1)["node"].alias("node"), F.col("word").alias("near"), F.col("n").alias("near_n")
        )


def _arrived(states: DataFrame, ends: DataFrame) -> DataFrame:
    """Pairs from the states that have read their word: those that stand where another word ends."""
    done = states.where(F.col("pos") == F.char_length("word"))
    found = done.join(ends, "node").where(F.levenshtein("word", "near", 1) == 1)
    return found.select("word", "n", "near", "near_n")


def _code(word: str, at: Column) -> Column:
    """The code point after the first ``at``; 0 behind the end. ascii() gives it also beyond ASCII."""
    return F.ascii(_after(word, at, F.lit(1)))


def _goes_on(pos: Column) -> Column:
    """Whether the child has an edge for the next code point, or a word's end where the word ends."""
    at_end = pos == F.col("size")
    return (at_end & F.col("ends")) | F.coalesce(~at_end & F.array_contains("nexts", _code("word", pos)), F.lit(False))


def one_edit_pairs(trie: Trie, folder: str) -> DataFrame:
    """(word, n, near, near_n): words and those that come of one replaced or deleted code point after the middle.

    A pair that differs by a replaced code point comes once, from the word that has the smaller one. Of deletions that
    give the same word, the last one counts: there the code point behind is another one.
    """
    pos, length, size, here, behind = map(F.col, ("pos", "length", "size", "here", "behind"))
    replaced = (here < F.col("first")) & (_after("word", pos + 1, length - 1) == _after("label", F.lit(1), length - 1))
    deleted = (here != behind) & (behind == F.col("first")) & (_after("word", pos + 1, length) == F.col("label"))
    states = trie.states.withColumn("size", F.char_length("word"))
    open_states = states.where(pos < size).withColumns({"here": _code("word", pos), "behind": _code("word", pos + 1)})
    stepped = (
        open_states.join(trie.edges, F.col("node") == F.col("parent"))
        .where(replaced | deleted)
        .select("*", F.explode(F.array_compact(F.array(F.when(replaced, pos + length), F.when(deleted, pos + 1 + length)))).alias("to"))
    )
    moved = stepped.where((F.col("to") <= size) & _goes_on(F.col("to")))
    frontier = materialize(moved.select("word", "n", "size", F.col("to").alias("pos"), F.col("child").alias("node")), "frontier", folder)
    shortened = states.where(pos == size - 1).withColumn("pos", size)
    pairs = [_arrived(shortened, trie.ends), _arrived(frontier, trie.ends)]
    edges = trie.edges.withColumnRenamed("parent", "node")
    while True:
        walking = frontier.where(pos < size).withColumn("first", _code("word", pos))
        moved = (
            walking.join(edges, ["node", "first"])
            .where((_after("word", pos, length) == F.col("label")) & _goes_on(pos + length))
            .select("word", "n", "size", (pos + length).alias("pos"), F.col("child").alias("node"))
        )
        frontier = materialize(moved, "frontier", folder)
        if frontier.isEmpty():
            break
        pairs.append(_arrived(frontier, trie.ends))
    result = pairs[0]
    for more in pairs[1:]:
        result = result.unionByName(more)
    return result


def neighbours(words: DataFrame, folder: str, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, near, near_n) for all pairs of ``words`` (wid, word, n) that are one edit apart, both ways, once each."""
    lowest = least_length // 2
    ahead = materialize(one_edit_pairs(Trie(words, lowest, folder), folder), "ahead", folder)
    reverse = words.withColumn("word", F.reverse("word"))
    back = materialize(one_edit_pairs(Trie(reverse, lowest, folder), folder), "back", folder)
    back = back.select(F.reverse("word").alias("word"), "n", F.reverse("near").alias("near"), "near_n")
    found = ahead.unionByName(back)
    both = found.select("word", "near", "near_n").unionByName(
        found.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )
    return both.repartition("word").dropDuplicates(["word", "near"])


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root): the last word that ``forms`` (word, form) lead to. Each turn doubles the way looked ahead.

    Each form is more frequent than its word by a factor, so ways are short and never closed.
    """
    reached = materialize(forms.select("word", F.col("form").alias("root")), "reached", folder)
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("later"))
        joined = materialize(reached.join(ahead, "root", "left"), "reached", folder)
        reached = joined.select("word", F.coalesce("later", "root").alias("root"))
        if joined.where("later IS NOT NULL").isEmpty():
            return reached


def spelling_variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per word its form, root, occurrences, number of near words, and occurrences of the form.

    A word's form is its most frequent near word, if that has at least ``times`` its occurrences.
    """
    spark = docs.sparkSession
    with scratch(spark, "spelling") as folder:
        counts = word_counts(docs, least_length, least_count, id_column, text_column)
        words = materialize(counts.withColumn("wid", F.monotonically_increasing_id()), "words", folder)
        near = neighbours(words, folder, least_length)
        per_word = near.groupBy("word").agg(
            F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
        )
        best_n = -F.col("best.n")
        is_form = best_n >= times * F.col("n")
        known = materialize(
            words.join(per_word, "word", "left").select(
                "word",
                F.when(is_form, F.col("best.near")).alias("form"),
                "n",
                F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                F.when(is_form, best_n).alias("form_n"),
            ),
            "known",
            folder,
        )
        ends = roots(known.where("form IS NOT NULL"), folder)
        answer = known.join(ends, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
        )
        return materialize(answer, f"variants-{uuid.uuid4().hex}")
