"""Toxicity scores from the nearest labelled examples.

1. Examples are a sample of labelled documents, all of them up to ``EXAMPLES``
   and up to ``EXAMPLE_BYTES`` of text, by a hash of their ids.
2. Texts are TF-IDF vectors of unit length over all words of the examples:
   one plus the logarithm of a word's count, times the logarithm of the inverse
   share of documents that have it, counted by Spark in all documents.
3. The examples' inverted index is broadcast, its size bounded by that of the
   sample.  It holds postings by word and block of examples, with the largest
   weight of each.  Block bounds give the exact nearest examples by cosine, and
   blocks that cannot hold one of them are not scored.
4. Neighbours vote, each with the part of its cosine that comes from words
   which tell the classes apart: a word's share is its strength, which grows
   with chi-squared and the ratio of the classes' frequencies and is never zero.
   Strength counts in votes only; it has no part in who the neighbours are.
   Votes of the examples themselves, each left out of its own, are mapped to
   probabilities by a logistic fit, and that map gives the scores.

Labels, ids, languages and sources are no inputs of a score.

Defined cases: null, empty and texts of unknown words only have no neighbour and get
the score of an empty vote; labels other than 0 and 1 and null labels are
left out; of several labels for one id the largest counts; a label of an absent
document teaches nothing; of several documents with a labelled id one is an
example; without examples of both classes every score is the rate of label 1,
or 0 without labels; empty tables have no rows; equal cosines prefer the earlier
example; repeated rows are scored each; texts of any length are read whole;
further columns pass through in :func:`without_toxic`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Collection, Iterator
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import batch, in_pieces, stored, strings

#: Bounds of the labelled sample, in documents and in bytes of their texts.
EXAMPLES = 1500
EXAMPLE_BYTES = 64 << 20
#: Neighbours that vote, and those that are named as evidence.
NEIGHBOURS = 200
EVIDENCE = 15
#: Chi-squared that gives half the strength (p of about 1e-5).
CHI2 = 20.0
#: Ratio of the document frequencies of full strength; common words that lean to a class are weak evidence.
RATIO = 8.0
#: Words of less than this strength all have the least one.
WEAK = 0.05
LEAST_STRENGTH = 1e-3
#: Weight of the general rate in a vote.
RATE_WEIGHT = 0.002
BLOCK = 64
KEPT_WORDS = 150_000
_WORD = re.compile(r"\w+")


def _hashed(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


class Vectors:
    """Words of texts as numbers of features, with their TF-IDF weights."""

    def __init__(self, features: np.ndarray, idf: np.ndarray):
        """``features``: sorted hashes of the examples' words."""
        self.features, self.idf = features, idf
        self.known: dict[str, int] = {}
        self.strange = 0

    def numbers(self, words: Collection[str]) -> np.ndarray:
        """Feature numbers of distinct words, -1 for those of no example."""
        new = list(filterfalse(self.known.__contains__, words))
        if new:
            if self.strange > KEPT_WORDS:  # words of no example go; there are no more others than features
                self.known, self.strange = {w: n for w, n in self.known.items() if n >= 0}, 0
                new = list(filterfalse(self.known.__contains__, words))
            keys = _hashed(new)
            at = np.searchsorted(self.features, keys)
            found = at < len(self.features)
            found[found] = self.features[at[found]] == keys[found]
            self.known.update(zip(new, np.where(found, at, -1).tolist(), strict=True))
            self.strange += len(new) - int(found.sum())
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers, and how often each comes."""
        words = Counter(_WORD.findall(text.lower()))
        at = self.numbers(words)
        times = np.fromiter(words.values(), np.int64, len(words))
        return at[at >= 0], times[at >= 0]

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and weights of unit length; both empty for a text without features."""
        return self.unit(*self.counts(text))

    def unit(self, at: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights = (1 + np.log(times)) * self.idf[at]
        at, weights = at[weights > 0], weights[weights > 0]
        return at, weights / (np.sqrt((weights**2).sum()) or 1)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers of all places in ranges."""
    ends = sizes.cumsum()
    out = np.repeat(starts - ends + sizes, sizes)
    out += np.arange(len(out))
    return out


class BlockMaxIndex:
    """Inverted index of examples: postings by feature and block, with the largest weight of each."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], features: int, block: int = BLOCK):
        # examples with like vectors go to the same block, which makes its bounds tight
        order = sorted(range(len(vectors)), key=lambda i: (vectors[i][0][np.argsort(-vectors[i][1], kind="stable")[:3]].tolist(), i))
        self.example = np.array(order, np.int64)
        self.blocks = -(-len(order) // block)
        sizes = np.array([len(vectors[i][0]) for i in order], np.int64)
        columns = np.concatenate([np.zeros(0, np.int32), *(vectors[i][0] for i in order)])
        weights = np.concatenate([np.zeros(0, np.float32), *(vectors[i][1] for i in order)])
        place = np.repeat(np.arange(len(order), dtype=np.int32), sizes)
        by = np.argsort(columns, kind="stable")  # by feature, then block, as places ascend
        # numbers as they are counted with, so that no lookup converts them
        columns, self.weight, self.place = columns[by], weights[by].astype(np.float64), place[by].astype(np.intp)
        own_block = self.place // block
        self.starts = np.flatnonzero(np.r_[len(by) > 0, (columns[1:] != columns[:-1]) | (own_block[1:] != own_block[:-1])][: len(by)])
        self.ends = np.r_[self.starts[1:], len(by)][: len(self.starts)]
        self.bounds = np.r_[self.starts, len(by)]
        self.in_block = own_block[self.starts]
        self.largest = np.maximum.reduceat(self.weight, self.starts) if len(by) else np.zeros(0)
        self.entries = np.r_[0, np.cumsum(np.bincount(columns[self.starts], minlength=features))]

    def products(self, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Products of some features' weights with those of all examples, by their numbers."""
        first, last = self.starts_of(at)
        sizes = last - first
        places = _spread(first, sizes)
        out = np.zeros(len(self.example))
        out[self.example] = np.bincount(self.place[places], self.weight[places] * np.repeat(weights, sizes), len(out))
        return out

    def starts_of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First posting of each feature, and the one after its last."""
        return self.bounds[self.entries[at]], self.bounds[self.entries[at + 1]]

    def nearest(self, at: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the k nearest examples of positive cosine, nearest first."""
        sizes = self.entries[at + 1] - self.entries[at]
        entries = _spread(self.entries[at], sizes)
        query, in_block = np.repeat(weights, sizes), self.in_block[entries]
        bounds = np.bincount(in_block, self.largest[entries] * query, self.blocks)
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        total, least, done, step = np.zeros(len(self.example)), 0.0, 0, 12
        chosen = np.zeros(self.blocks, bool)
        while done < len(order) and bounds[order[done]] >= least - 1e-9:
            now = order[done : done + step]
            chosen[:] = False
            chosen[now[bounds[now] >= least - 1e-9]] = True
            hit = np.flatnonzero(chosen[in_block])
            starts = self.starts[entries[hit]]
            lengths = self.ends[entries[hit]] - starts
            places = _spread(starts, lengths)
            parts = np.repeat(query[hit], lengths)
            parts *= self.weight.take(places)
            total += np.bincount(self.place.take(places), parts, len(total))
            if (total > 0).sum() >= k:
                least = float(np.partition(total, -k)[-k])
            done, step = done + step, step * 2
        total = np.round(total, 12) if len(total) else total
        found = np.flatnonzero(total > max(1e-12, least - 1e-9))
        best = found[np.lexsort((self.example[found], -total[found]))[:k]]
        return self.example[best], total[best]


class Core:
    """What scoring needs, broadcast once: bounded by the number and size of the examples."""

    def __init__(self, features: np.ndarray, idf: np.ndarray, strength: np.ndarray, examples: list[tuple], rate: float):
        self.vectors = Vectors(features, idf)
        self.ids = np.array([e[0] for e in examples], np.int64)
        self.number = {e[0]: i for i, e in enumerate(examples)}
        self.labels = np.array([e[1] for e in examples], np.float64)
        units = [self.vectors.unit(e[2], e[3]) for e in examples]
        units = [(at.astype(np.int32), w.astype(np.float32)) for at, w in units]
        self.index = BlockMaxIndex(units, len(features))
        self.told, self.rate = np.where(strength > LEAST_STRENGTH, strength - LEAST_STRENGTH, 0.0), rate

    def vote(self, at: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[float, np.ndarray]:
        """Weighted share of label 1 among the neighbours, and the numbers of those that weigh most."""
        if not len(at):
            return self.rate, np.zeros(0, np.int64)
        found, cosines = self.index.nearest(at, weights, NEIGHBOURS + (without >= 0))
        kept = np.flatnonzero(found != without)[:NEIGHBOURS]
        found, cosines = found[kept], cosines[kept]
        strong = np.flatnonzero(self.told[at])
        more = self.index.products(at[strong], weights[strong] * self.told[at[strong]])[found]
        told = LEAST_STRENGTH * cosines + more
        share = (told @ self.labels[found] + RATE_WEIGHT * self.rate) / (told.sum() + RATE_WEIGHT)
        return float(share), found[np.argsort(-told, kind="stable")[:EVIDENCE]]


@dataclass
class Model:
    """The broadcast core with the map from votes to probabilities; without a core, every score is the rate."""

    core: Broadcast[Core] | None
    rate: float
    slope: float = 0.0
    shift: float = 0.0

    def scorer(self) -> Callable[[str], tuple[float, list[int]]]:
        """A function for tasks: probability of label 1, and ids of the neighbours that weigh most."""
        shared, rate, slope, shift = self.core, self.rate, self.slope, self.shift

        def score(text: str) -> tuple[float, list[int]]:
            if shared is None:
                return rate, []
            core = shared.value
            vote, found = core.vote(*core.vectors(text))
            return float(1 / (1 + np.exp(-(slope * vote + shift)))), core.ids[found].tolist()

        return score


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit with targets drawn in a little, so that they stay finite."""
    if not 0 < y.sum() < len(y):
        return 0.0, 0.0
    positive = y.sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (len(y) - positive + 2))
    design = np.c_[x, np.ones_like(x)]
    fit = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ fit, -30, 30)))
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, design.T @ (target - p) - 1e-6 * fit)
        fit += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(fit[0]), float(fit[1])


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit a model on labelled documents; callers leave out the labels that are held out."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).cast("long").alias("label_id")).agg(F.max(label_col).cast("int").alias("label"))
    known = stored(known, "tox-labels")
    rows = docs.select(F.col(id_col).cast("long").alias("label_id"), F.col(text_col).cast("string").alias("text"))
    sizes = rows.select("label_id", F.octet_length("text").alias("size")).join(known, "label_id")
    size = sizes.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    share = min(1.0, EXAMPLES / max(1, size["n"]), EXAMPLE_BYTES / max(1, size["bytes"] or 0))
    # a share of all labels by hash; its size is bounded, and so is its broadcast
    some = known.filter(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    examples = stored(rows.join(F.broadcast(some), "label_id").repartition("label_id").dropDuplicates(["label_id"]), "tox-examples")
    totals = {r["label"]: r["count"] for r in examples.groupBy("label").count().collect()}
    ones, zeros = totals.get(1, 0), totals.get(0, 0)
    rate = ones / max(1, ones + zeros)
    if not ones or not zeros:
        return Model(None, rate)
    features, one, zero = _class_counts(examples)
    idf = np.log((1 + docs.count()) / (1 + _document_counts(rows, features)))
    strength = _strengths(one, zero, ones, zeros)
    made = Core(features, idf, strength, _example_counts(examples, features), rate)
    core, classes = docs.sparkSession.sparkContext.broadcast(made), made.labels
    del made  # the driver needs it no more
    return Model(core, rate, *_calibration(core, examples, classes))


def _class_counts(examples: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of the examples' words, and in how many examples of either class each occurs."""
    schema = pa.schema([("feature", pa.int64()), ("one", pa.int64()), ("zero", pa.int64())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = Counter(), Counter()
            for text, label in zip(strings(b.column(0)), b.column(1).to_pylist(), strict=True):
                found[label].update(set(_WORD.findall(text.lower())))
            words = list(found[0] | found[1])
            yield from in_pieces(schema, [_hashed(words).view(np.int64), *(np.array([c[w] for w in words], np.int64) for c in found[::-1])])

    counts = examples.select("text", "label").mapInArrow(of, "feature long, one long, zero long")
    counts = counts.groupBy("feature").agg(F.sum("one").cast("int").alias("one"), F.sum("zero").cast("int").alias("zero")).toArrow()
    features, one, zero = (counts[c].to_numpy() for c in ("feature", "one", "zero"))
    order = np.argsort(features.view(np.uint64))
    return features.view(np.uint64)[order], one[order].astype(np.float64), zero[order].astype(np.float64)


def _strengths(a: np.ndarray, b: np.ndarray, ones: int, zeros: int) -> np.ndarray:
    """How well each word tells the classes apart: from WEAK to 1, or LEAST_STRENGTH."""
    cross = a * (zeros - b) - b * (ones - a)
    chi2 = (ones + zeros) * cross * cross / np.maximum(float(ones) * zeros * (a + b) * (ones + zeros - a - b), 1e-9)
    apart = np.abs(np.log((a + 0.5) / (ones + 1) * (zeros + 1) / (b + 0.5))) / np.log(RATIO)
    strength = chi2 / (chi2 + CHI2) * np.minimum(1, apart)
    return np.where(strength >= WEAK, strength, LEAST_STRENGTH)


def _document_counts(rows: DataFrame, features: np.ndarray) -> np.ndarray:
    """In how many of all documents each word of the examples occurs."""
    shared = rows.sparkSession.sparkContext.broadcast(features)
    schema = pa.schema([("feature", pa.int32()), ("n", pa.int64())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, sums = Vectors(shared.value, np.zeros(0)), np.zeros(len(shared.value), np.int64)
        for b in batches:
            for t in strings(b.column(0)):
                at = vectors.numbers(set(_WORD.findall(t.lower())))
                sums[at[at >= 0]] += 1
        yield from in_pieces(schema, [np.flatnonzero(sums), sums[sums > 0]])

    every = rows.select("text").mapInArrow(of, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(features))
    counts[every["feature"].to_numpy()] = every["n"].to_numpy()
    shared.destroy()
    return counts


def _example_counts(examples: DataFrame, features: np.ndarray) -> list[tuple]:
    """id, label, feature numbers and their counts of each example, by id."""
    shared = examples.sparkSession.sparkContext.broadcast(features)
    lists = [("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))]
    schema = pa.schema([("id", pa.int64()), ("label", pa.int32()), *lists])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors(shared.value, np.zeros(0))
        for b in batches:
            for low in range(0, b.num_rows, 200):
                part = b.slice(low, 200)
                found = [vectors.counts(t) for t in strings(part.column(2))]
                yield batch(schema, part.column(0), part.column(1), *([f[k].astype(np.int32) for f in found] for k in (0, 1)))

    found = examples.select("label_id", F.col("label").cast("int"), "text").mapInArrow(of, "id long, label int, at array<int>, times array<int>")
    out = []
    for part in found.toArrow().to_batches():
        at, times = ([x.values.to_numpy() for x in part.column(k)] for k in (2, 3))
        out += zip(part.column(0).to_pylist(), part.column(1).to_pylist(), at, times, strict=True)
    shared.destroy()
    return sorted(out, key=lambda r: r[0])


def _calibration(core: Broadcast[Core], examples: DataFrame, classes: np.ndarray) -> tuple[float, float]:
    """A logistic fit of the examples' votes, each without its own."""
    schema = pa.schema([("id", pa.int64()), ("vote", pa.float64())])

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = core.value
        for b in batches:
            own = b.column(0).to_pylist()
            yield batch(schema, own, [of.vote(*of.vectors(t), of.number[i])[0] for i, t in zip(own, strings(b.column(1)), strict=True)])

    found = sorted((r["id"], r["vote"]) for r in examples.select("label_id", "text").mapInArrow(votes, "id long, vote double").collect())
    return logistic(np.array([v for _, v in found]), classes)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, predicted and the ids of the nearest examples, for each document."""
    score = model.scorer()
    schema = pa.schema([("id", pa.int64()), ("score", pa.float64()), ("neighbours", pa.list_(pa.int64()))])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [score(t) for t in strings(b.column(1))]
            yield batch(schema, b.column(0), [s for s, _ in found], [n for _, n in found])

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        of, "id long, score double, neighbours array<long>"
    )
    return rows.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that the model does not reject; all columns unchanged."""
    of = model.scorer()

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series([of(t or "")[0] for t in text], dtype="float64")

    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    return rows.filter(score("text") < 0.5).select("row.*")
