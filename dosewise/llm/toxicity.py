"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed terms: words in lower case, and their first letters,
which carry stems to words not seen in training. The machine adds to a weight per term an
inner product per pair of terms, so that an insult together with the mention of a group can
count for more than both alone. Terms are chosen on the training sample, the model has a
fixed size, and a document is scored where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosewise.llm.batches import Slice, segment_sums, text_slices, windows8
from dosewise.llm.tables import in_small_batches
from dosewise.llm.terms import IS_LETTER, LOWER, MIX, bucket, words_within

BITS = 18
PREFIXES = (4, 5, 6)  # bytes
TERMS = 2048  # chosen for the model
LEAST_DOCS = 5
FACTORS = 8
SHARES, PER_SHARE = 16, 250  # at most their product of labelled rows of each label
PER_TEXT = 8192  # different terms taken from one text of the sample: the bound of its bytes
ROUNDS = 200
RIDGE = 1e-4
START = 0.05  # spread of the first factors
FOLDS, HELD_OUT = 5, 0


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: one crc32 remainder of the id, and null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def terms(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every term of a slice, repeats included."""
    data = LOWER[part.data]
    starts, ends = words_within(part, IS_LETTER[data])
    owner = np.searchsorted(part.ends, starts, "right")
    size = ends - starts
    eight = windows8(data)
    low = np.minimum(size, 8).astype(np.uint64) * np.uint64(8)
    mask = np.where(size >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (low % np.uint64(64))) - np.uint64(1))
    first = eight[starts] & mask
    # A word is its first and last eight bytes and its length.
    last = np.where(size > 8, eight[np.maximum(ends - 8, 0)], np.uint64(0))
    keys = [(first * MIX + last) * MIX + size.astype(np.uint64)]
    owners = [owner]
    for n in PREFIXES:
        long = size >= n
        keys.append(((first[long] & np.uint64((1 << 8 * n) - 1)) + np.uint64(n)) * MIX * np.uint64(2 * n + 1))
        owners.append(owner[long])
    return np.concatenate(owners), bucket(np.concatenate(keys), BITS)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for part in text_slices(batch.column("text")):
            owner, bins = terms(part)
            pairs = np.unique((owner << BITS) + bins)
            edges = np.searchsorted(pairs >> BITS, np.arange(len(part) + 1))
            own = (pairs & ((1 << BITS) - 1)).astype("<i4")
            # Bins are hashes, in order: the first ones are an even choice.
            rows += [own[a : min(b, a + PER_TEXT)].tobytes() for a, b in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.binary())], ["label", "bins"])


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, shares: int = SHARES, per_share: int = PER_SHARE
) -> tuple[list, dict[int, int]]:
    """Term sets of at most ``shares`` x ``per_share`` learnable documents of each label, and
    how many learnable rows each label has.

    Ids are chosen from the labels alone, least hash first within each hashed share, so that
    no task ranks all rows of a label; only the chosen, bounded list meets the documents.
    """
    marked = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = {r.label: r.n for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.pmod(F.xxhash64(F.lit("share"), "doc_id"), F.lit(shares)).alias("share")
    turn = Window.partitionBy("label", "share").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = marked.select("*", share).withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= per_share)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "label")), "doc_id")
    # Rows that repeat a doc_id would pass the bound: one text for each.
    texts = texts.groupBy("doc_id", "label").agg(F.max("text").alias("text")).select("label", "text")
    return in_small_batches(texts).mapInArrow(_sets, "label int, bins binary").collect(), sizes


@dataclass(frozen=True)
class Model:
    slots: np.ndarray  # by bucket: number of the term, or -1
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, part: Slice) -> np.ndarray:
        owner, bins = terms(part)
        slot = self.slots[bins]
        known = slot >= 0
        pairs = np.unique(owner[known] * TERMS + slot[known])
        edges = np.searchsorted(pairs // TERMS, np.arange(len(part) + 1))
        eta = self.bias + machine(pairs % TERMS, edges[:-1], edges[1:], self.weights, self.factors)[0]
        return 1 / (1 + np.exp(-np.clip(eta, -60, 60)))


def machine(
    index: np.ndarray, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray, factors: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Sum of weights and of all pairs' inner products per document; sums of factors."""
    own = factors[index]
    sums = segment_sums(own, starts, ends)
    squares = segment_sums((own**2).sum(axis=1), starts, ends)
    return segment_sums(weights[index], starts, ends) + 0.5 * ((sums**2).sum(axis=1) - squares), sums


def fit(rows: list, sizes: dict[int, int], rounds: int = ROUNDS, ridge: float = RIDGE, factors: int = FACTORS) -> Model:
    """Choose terms, then Adam in whole passes from a fixed start.

    Each label weighs as many rows as it has, not as were sampled. Without rows of both
    labels, every text scores the share of label 1 (one half if there is none at all).
    """
    rows = sorted(rows, key=lambda r: (r.label, bytes(r.bins)))
    n_bins = 1 << BITS
    slots = np.full(n_bins, -1, np.int64)
    y = np.array([r.label for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        bias = 0.0 if len(y) == 0 else (60.0 if y[0] else -60.0)
        return Model(slots, bias, np.zeros(TERMS), np.zeros((TERMS, factors)))
    sets = [np.frombuffer(r.bins, "<i4") for r in rows]
    sampled = np.bincount(y, minlength=2)
    in_one, in_zero = (np.bincount(np.concatenate([s for s, t in zip(sets, y) if t == k] or [np.zeros(0, int)]), minlength=n_bins)
                       for k in (1, 0))
    # Standard score of the difference between the labels' shares of documents with the term.
    share = (in_one + in_zero) / len(y)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / sampled[0] + 1 / sampled[1]))
    score = np.abs(in_one / sampled[1] - in_zero / sampled[0]) / spread
    score[in_one + in_zero < LEAST_DOCS] = 0
    chosen = np.argsort(-score, kind="stable")[:TERMS]
    chosen = chosen[score[chosen] > 0]
    slots[chosen] = np.arange(len(chosen))
    lists = [slots[s][slots[s] >= 0] for s in sets]
    ends = np.cumsum([len(x) for x in lists])
    starts = ends - np.diff(ends, prepend=0)
    index = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists)), ends - starts)
    weight = np.array([sizes[k] / sampled[k] for k in (0, 1)])[y]
    weight = weight / weight.sum()

    rng = np.random.default_rng(0)
    prior = (weight * y).sum()
    x = np.concatenate([[np.log(prior / (1 - prior))], np.zeros(TERMS), rng.normal(0, START, TERMS * factors)])
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, rounds + 1):
        w, v = x[1 : TERMS + 1], x[TERMS + 1 :].reshape(TERMS, factors)
        eta, sums = machine(index, starts, ends, w, v)
        error = weight * (y - 1 / (1 + np.exp(-np.clip(eta + x[0], -60, 60))))
        by_entry = error[owner]
        by_factor = by_entry[:, None] * (sums[owner] - v[index])
        gradient = np.concatenate([
            [error.sum()],
            np.bincount(index, by_entry, TERMS) - ridge * w,
            np.stack([np.bincount(index, by_factor[:, f], TERMS) for f in range(factors)], axis=1).ravel() - ridge * v.ravel(),
        ])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        x = x + 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(slots, float(x[0]), x[1 : TERMS + 1], x[TERMS + 1 :].reshape(TERMS, factors))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Fit on labelled documents that are not held out; see ``training_sample``."""
    return fit(*training_sample(docs, labels, label))


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [model.scores(part) for part in text_slices(batch.column("text"))]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(np.concatenate([np.zeros(0), *scores]))], [*names, "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, text_h, held_out, score, predicted``, a row for each row of ``docs``.

    Null and empty texts have no terms and score the bias alone. Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights
    kind = docs.schema["doc_id"].dataType.simpleString()
    given = docs.select("doc_id", F.xxhash64("text").alias("text_h"), "text")
    scored = in_small_batches(given).mapInArrow(
        lambda batches: _score(batches, sent.value), f"doc_id {kind}, text_h bigint, score double")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", "text_h", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
