"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, and a linear classifier.

1. Voters look at the words of a text and fire or not. Some have fixed word lists, some have words that stand out
   in a bounded sample of labelled rows, some look for patterns. The votes of a text are one bit pattern.
2. The label model explains how often each pattern occurs over all documents: a hidden class, and for each voter
   how often it fires in each class, found by expectation maximisation; known labels fix the class of their rows there.
   Voters that agree more than the class explains share their weight: each is divided by one plus its positive
   correlations within the class.
3. A logistic regression on the hashed words and word pairs of a bounded sample, and on the votes, learns the
   posterior labels that the label model gives to vote patterns, for rows with a known label as well.

Defined results: a null or empty text has no words, so no voter fires and the score comes from the bias alone;
repeated rows get equal scores; very long texts are read whole. Without labels the fixed lists alone start the
label model; without documents the result is empty. Rows without an id are never learned from. Only the id and
text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from uidloom.llm import textops
from uidloom.llm.learning import Ftrl, crc_of_id, fit, labelled_sample
from uidloom.sources.session import materialize

BUCKET_BITS = 22
BROADCAST_ROWS = 100_000
PER_CLASS = 3000
"""Bound of both training samples: rows of each class, those with the smallest hash of their id."""
LEARNED_WORDS = 256
LEARNED_LISTS = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)

# Fixed words of the lexicon voters, in natural order.
LEXICON = {
    "persons": "bastard clown coward creep dimwit fool freak idiot imbecile jerk loser moron pig retard twat",
    "contempt": "dumb disgusting pathetic repulsive ridiculous stupid ugly useless vile worthless",
    "dirt": "filth filthy garbage rubbish scum sewage slime trash vermin",
    "abuse": "arse asshole bitch bollocks bullshit crap cunt damn fuck fucking prick shit slut whore",
    "threats": "hang kill killed murder slaughter strangle",
    "french": "abruti connard connasse crétin débile imbécile minable ordure pute salaud salope",
    "german": "abschaum arschloch dreckig dummkopf hurensohn idiotin schlampe trottel wertlos widerlich",
    "spanish": "asqueroso basura cabrón escoria estúpido gilipollas idiota imbécil inútil payaso puta",
}
ADDRESS = "you your yours u ur tu toi du dich dir tú ti usted".split()


class Voters:
    """All voters; the learned lists hold word hashes."""

    def __init__(self, learned: list[np.ndarray]):
        lists = [np.array([textops.hash_word(w) for w in words.split()], np.uint64) for words in LEXICON.values()]
        self.lists = lists + learned
        self.insults = textops.KeySet(np.concatenate(self.lists))
        self.bits = np.zeros(len(self.insults.keys), np.int64)
        for k, words in enumerate(self.lists):
            self.bits[np.isin(self.insults.keys, words)] |= 1 << k
        self.address = textops.KeySet(np.array([textops.hash_word(w) for w in ADDRESS], np.uint64))
        self.names = [*LEXICON, *(f"learned_{k}" for k in range(len(learned))), "addressed", "several", "dense"]

    def patterns(self, texts: textops.Texts) -> np.ndarray:
        """The votes of each text as bits, in the order of ``names``."""
        tokens = textops.Tokens(texts)
        owner = tokens.of_text()
        at, which = self.insults.find(tokens.hash)
        out = np.zeros(len(texts), np.int64)
        np.bitwise_or.at(out, owner[at], self.bits[which])
        named = np.zeros(len(owner) + 3, bool)
        named[self.address.find(tokens.hash)[0]] = True
        near = np.zeros(len(at), bool)
        for step in (1, 2, 3):
            before = np.maximum(at - step, 0)
            near |= named[before] & (at >= step) & (owner[before] == owner[at])
        hits = np.bincount(owner[at], minlength=len(texts))
        pairs = np.unique(np.stack([owner[at], which]), axis=1)
        distinct = np.bincount(pairs[0], minlength=len(texts))
        addressed = np.bincount(owner[at[near]], minlength=len(texts)) > 0
        base = len(self.lists)
        out |= addressed.astype(np.int64) << base
        out |= (distinct >= 2).astype(np.int64) << (base + 1)
        out |= (hits * 200 >= np.maximum(np.diff(tokens.first), 1)).astype(np.int64) * (hits > 0) << (base + 2)
        return out


def learned_lists(sample: DataFrame) -> list[np.ndarray]:
    """Words of a labelled sample that are far more frequent in class 1, dealt out to a few lists.

    A word counts once for each different word before it, not once for each text: words of a passage that copies share
    always follow the same word, while a word with a meaning of its own turns up after many.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            target = batch.column(1).to_numpy()
            for texts in textops.chunks(batch.column(0)):
                tokens = textops.Tokens(texts)
                words = np.flatnonzero(tokens.is_word)
                h, owner = tokens.hash[words], tokens.of_text()[words]
                before = np.zeros(len(h), np.uint64)
                before[1:] = np.where(owner[1:] == owner[:-1], h[:-1], np.uint64(0))
                yes = target[texts.first + owner] > 0.5
                triples = np.unique(np.stack([h, before, yes.astype(np.uint64)]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in np.ascontiguousarray(triples)], names=["key", "before", "yes"]
                )

    sizes = sample.agg(F.sum("target").alias("yes"), F.sum(1 - F.col("target")).alias("no")).first()
    n_yes, n_no = (sizes["yes"] or 0) + 1, (sizes["no"] or 0) + 1
    places = sample.select("text", "target").mapInArrow(count, "key bigint, before bigint, yes bigint").distinct()
    counts = places.groupBy("key").agg(F.sum("yes").alias("yes"), F.sum(1 - F.col("yes")).alias("no"))
    lift = F.log((F.col("yes") + 0.5) / n_yes) - F.log((F.col("no") + 0.5) / n_no)
    clear = (F.col("yes") >= F.greatest(F.lit(3.0), F.lit(n_yes / 200))) & (lift > 3.0)
    top = counts.where(clear).orderBy(F.col("yes").desc(), "key").limit(LEARNED_WORDS).toArrow()
    keys = top.column("key").to_numpy().view(np.uint64)
    return [keys[k::LEARNED_LISTS] for k in range(LEARNED_LISTS)]


class LabelModel:
    """Posterior of class 1 for each vote pattern, from how often each (pattern, known label) occurs."""

    def __init__(self, patterns: np.ndarray, known: np.ndarray, rows: np.ndarray, voters: int, rounds: int = 50):
        """``known`` is 0 or 1, or -1 for no label."""
        votes = (patterns[:, None] >> np.arange(voters)) & 1
        fixed = known >= 0
        posterior = np.where(fixed, known, np.where(votes.any(1), 0.9, 0.05)).astype(float)
        self.shares = np.ones(voters)
        for _ in range(rounds):
            self.prior = float((rows @ posterior + 1) / (rows.sum() + 2))
            self.fires = np.stack([self._fires(votes, rows * side) for side in (1 - posterior, posterior)])
            self.correlations = [self._correlations(votes, rows * side) for side in (1 - posterior, posterior)]
            weight = [self.prior, 1 - self.prior]
            both = weight[1] * self.correlations[0] + weight[0] * self.correlations[1]
            self.shares = 1 / (1 + np.maximum(both - np.eye(voters), 0).sum(1))
            posterior = np.where(fixed, known, self.posterior(patterns))
        self.rows = rows

    @staticmethod
    def _fires(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return (weight @ votes + 0.5) / (weight.sum() + 1)

    @staticmethod
    def _correlations(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
        total = max(weight.sum(), 1e-9)
        centred = votes - weight @ votes / total
        cov = (centred * weight[:, None]).T @ centred / total
        deviation = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        return np.clip(cov / deviation[:, None] / deviation, -1, 1) * (deviation[:, None] > 1e-6) * (deviation > 1e-6)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        votes = (patterns[:, None] >> np.arange(len(self.shares))) & 1
        clean, toxic = self.fires
        odds = votes * np.log(toxic / clean) + (1 - votes) * np.log((1 - toxic) / (1 - clean))
        return 1 / (1 + np.exp(-np.clip(np.log(self.prior / (1 - self.prior)) + odds @ self.shares, -30, 30)))


def occurrences(texts: textops.Texts, voters: Voters) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words, word pairs and votes of some texts, and the text of each; buckets may repeat."""
    tokens = textops.Tokens(texts)
    words = np.flatnonzero(tokens.is_word)
    owner, h = tokens.of_text()[words], tokens.hash[words]
    same = owner[:-1] == owner[1:]
    pair = textops.mix(h[:-1] * _STEP + h[1:])[same]
    buckets = (np.concatenate((h, pair)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    voted, voter = np.nonzero((voters.patterns(texts)[:, None] >> np.arange(len(voters.names))) & 1)
    return np.concatenate((buckets, voter + (1 << BUCKET_BITS))), np.concatenate((owner, owner[:-1][same], voted))


def features_of(lists: list[np.ndarray]):
    """Per text its distinct buckets, each with value 1."""

    def features(texts: textops.Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        buckets, owner = occurrences(texts, Voters(lists))
        order = np.argsort(owner, kind="stable")
        buckets, cuts = buckets[order], np.searchsorted(owner[order], np.arange(len(texts) + 1))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            at = np.unique(buckets[a:b])
            yield at, np.ones(len(at))

    return features


class ToxicityModel:
    """Nonzero weights by bucket, the bias, and the learned word lists of the voters."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, bias: float, lists: list[np.ndarray]):
        self.buckets, self.weights, self.bias, self.lists = buckets, weights, bias, lists
        self.voters = Voters(lists)
        self.table = np.zeros((1 << BUCKET_BITS) + 64, np.float32)
        self.table[buckets] = weights

    def scores(self, texts: textops.Texts) -> np.ndarray:
        buckets, owner = occurrences(texts, self.voters)
        hit = np.flatnonzero(self.table[buckets])
        once = np.unique(owner[hit] << (BUCKET_BITS + 1) | buckets[hit])  # each bucket counts once in a text
        at = once & ((1 << (BUCKET_BITS + 1)) - 1)
        total = np.bincount(once >> (BUCKET_BITS + 1), self.table[at], len(texts))
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", allowed: Column | None = None, per_class: int = PER_CLASS
) -> ToxicityModel:
    """``allowed`` says of a label row whether it may be learned from."""
    spark = docs.sparkSession
    allowed = F.lit(True) if allowed is None else allowed
    picked = labelled_sample(labels, label, allowed, per_class)
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    lists = learned_lists(materialize(sample, "toxic_sample"))
    voters = spark.sparkContext.broadcast(lists)

    @arrow_udf("bigint")
    def pattern(text: pa.Array) -> pa.Array:
        own = Voters(voters.value)
        found = [own.patterns(texts) for texts in textops.chunks(text)]
        return pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))

    known = labels.where(allowed & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("known"))
    votes = docs.where("doc_id IS NOT NULL").select("doc_id", pattern("text").alias("pattern"))
    votes = materialize(votes.join(known, "doc_id", "left").withColumn("known", F.coalesce("known", F.lit(-1))), "votes")
    # At most three rows for each of the bit patterns of the voters, whatever the number of documents.
    counts = votes.groupBy("pattern", "known").agg(F.count("*").alias("n")).orderBy("pattern", "known").toArrow()
    patterns, labels_known, rows = (counts.column(c).to_numpy() for c in ("pattern", "known", "n"))
    voted = LabelModel(patterns, labels_known, rows.astype(float), len(Voters(lists).names))
    distinct = np.unique(patterns)
    posteriors = spark.createDataFrame(
        list(zip(distinct.tolist(), voted.posterior(distinct).tolist())), "pattern bigint, target double"
    )
    if len(distinct) <= BROADCAST_ROWS:
        posteriors = F.broadcast(posteriors)
    rated = votes.join(posteriors, "pattern").withColumn("turn", F.xxhash64("doc_id"))
    likely = F.col("target") >= 0.5
    picks = [rated.where(side).orderBy("turn", "doc_id").limit(per_class) for side in (likely, ~likely)]
    ids = picks[0].unionByName(picks[1]).dropDuplicates(["doc_id"]).select("doc_id", "target", "turn")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    model = lambda: Ftrl((1 << BUCKET_BITS) + 64, alpha=0.3, l1=1.0, l2=0.1)
    buckets, weights, bias = fit(rows, features_of(lists), model, epochs=3)
    return ToxicityModel(buckets, weights.astype(np.float32), bias, lists)


def scorer(spark: SparkSession, model: ToxicityModel):
    """A function of a text column that gives scores from 0 to 1; the model's size is bounded by its buckets."""
    held = spark.sparkContext.broadcast((model.buckets, model.weights, model.bias, model.lists))

    @arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        own = ToxicityModel(*held.value)
        found = [own.scores(texts) for texts in textops.chunks(text)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return score


def may_learn(doc_id: Column) -> Column:
    """The rows that the query may learn labels from."""
    return crc_of_id(doc_id) % 5 != 0
