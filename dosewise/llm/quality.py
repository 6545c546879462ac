"""Document quality by ordinal cumulative-link regression on graded ratings.

With grades g_1 < ... < g_K, P(grade <= g_k) = sigmoid(theta_k - eta): one weight vector
for all grades, and ordered thresholds. eta is linear in hashed text: the mean weight of
the text's byte grams, plus the weights of a few shares that describe its form.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosewise.llm.batches import Slice, segment_sums, text_slices
from dosewise.llm.tables import in_small_batches
from dosewise.llm.terms import SHAPES, grams, shape

GRAM = 4
BITS = 15
PER_GRADE = 1000  # labelled rows taken for each grade: the bound of the training sample
PER_TEXT = 8192  # different grams taken from one text of the sample: the bound of its bytes
MOST_GRADES = 20
SHARES = 16
SCALE = 30.0  # of gram shares
FORM_SCALE = 10.0  # of form shares: few weights, each to be learnt fast
ROUNDS = 150
RIDGE = 1e-5
TAIL = 0.2  # documents with a smaller probability of the better grades are rejected


@dataclass(frozen=True)
class Model:
    """Ordered grades, thresholds between them, gram weights and form weights."""

    grades: np.ndarray
    thresholds: np.ndarray
    weights: np.ndarray
    forms: np.ndarray

    def at_most(self, eta: np.ndarray) -> np.ndarray:
        """P(grade <= g_k) for every text and every grade but the last."""
        return 1 / (1 + np.exp(np.clip(eta[:, None] - self.thresholds[None, :], -500, 500)))

    def scores(self, part: Slice) -> np.ndarray:
        bins, inside = grams(part, GRAM, BITS)
        values = np.where(inside, self.weights[bins], 0.0)
        counts = np.maximum(part.ends - part.starts - GRAM + 1, 1)
        return SCALE * segment_sums(values, part.starts, part.ends) / counts + FORM_SCALE * (shape(part) @ self.forms)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grade, and sparse gram counts and form shares as packed arrays; of a text with more
    than ``PER_TEXT`` different grams those of least hash."""
    for batch in batches:
        rows = []
        for part in text_slices(batch.column("text")):
            bins, inside = grams(part, GRAM, BITS)
            forms = (FORM_SCALE * shape(part)).astype("<f8")
            for i in range(len(part)):
                own = slice(part.starts[i], part.ends[i])
                index, count = np.unique(bins[own][inside[own]], return_counts=True)
                # Bins are hashes: the least ones are an even choice.
                index, count = index[:PER_TEXT], count[:PER_TEXT]
                share = (SCALE * count / max(count.sum(), 1)).astype("<f4")
                rows.append((index.astype("<i4").tobytes(), share.tobytes(), forms[i].tobytes()))
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade"), *(pa.array(c, pa.binary()) for c in columns)], ["grade", "bins", "shares", "forms"]
        )


def training_sample(docs: DataFrame, labels: DataFrame, grade: str, per_grade: int) -> list:
    """Features of at most ``per_grade`` documents of each grade, those of least hashed id.

    Labels are narrowed before texts are touched: only the sample's ids meet the documents,
    and that list is bounded by ``per_grade`` x ``MOST_GRADES``.
    """
    rated = labels.select("doc_id", F.col(grade).cast("double").alias("grade")).where(
        "doc_id is not null and grade is not null and not isnan(grade)"
    )
    rated = rated.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    # Ranked in hashed shares, so that no task ranks all rows of a grade.
    shares = max(1, min(SHARES, per_grade // 50))
    share = F.pmod(F.xxhash64(F.lit("share"), "doc_id"), F.lit(shares)).alias("share")
    turn = Window.partitionBy("grade", "share").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rated.select("*", share).withColumn("turn", F.row_number().over(turn))
    chosen = chosen.where(F.col("turn") <= per_grade // shares).select("doc_id", "grade")
    n_grades = chosen.select("grade").distinct().count()
    if n_grades > MOST_GRADES:
        raise ValueError(f"more than {MOST_GRADES} different grades: not graded ratings")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Rows that repeat a doc_id would pass the bound: one text for each.
    texts = texts.groupBy("doc_id", "grade").agg(F.max("text").alias("text")).select("grade", "text")
    return in_small_batches(texts).mapInArrow(_features, "grade double, bins binary, shares binary, forms binary").collect()


def fit(rows: list, rounds: int = ROUNDS, ridge: float = RIDGE) -> Model:
    """Likelihood ascent by Adam over the sample, in whole passes, from a fixed start.

    Grades are weighted to count alike, so a rare grade is learnt too. With no rows, or
    one grade only, every text gets that grade.
    """
    rows = sorted(rows, key=lambda r: (r.grade, bytes(r.bins), bytes(r.shares)))
    grades, y = np.unique(np.array([r.grade for r in rows], float), return_inverse=True)
    n_bins = 1 << BITS
    if len(grades) < 2:
        return Model(grades, np.zeros(0), np.zeros(n_bins), np.zeros(SHAPES))
    bins = [np.frombuffer(r.bins, "<i4") for r in rows]
    index, share = np.concatenate(bins), np.concatenate([np.frombuffer(r.shares, "<f4") for r in rows])
    forms = np.stack([np.frombuffer(r.forms, "<f8") for r in rows])
    ends = np.cumsum([len(b) for b in bins])
    starts, owner = ends - np.diff(ends, prepend=0), np.repeat(np.arange(len(rows)), np.diff(ends, prepend=0))
    sizes = np.bincount(y)
    weight = (len(rows) / (len(grades) * sizes))[y] / len(rows)
    cumulative = np.cumsum(sizes)[:-1] / len(rows)
    # First threshold, logs of the gaps between thresholds, gram weights, form weights.
    start = np.log(cumulative / (1 - cumulative))
    n_cuts = len(start)
    x = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3)), np.zeros(n_bins + SHAPES)])
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, rounds + 1):
        gaps = np.exp(x[1:n_cuts])
        cuts = x[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        w, v = x[n_cuts : n_cuts + n_bins], x[n_cuts + n_bins :]
        eta = segment_sums(share * w[index], starts, ends) + forms @ v
        upper = np.concatenate([cuts, [np.inf]])[y] - eta
        lower = np.concatenate([[-np.inf], cuts])[y] - eta
        top, low = 1 / (1 + np.exp(-np.clip(upper, -60, 60))), 1 / (1 + np.exp(-np.clip(lower, -60, 60)))
        top[np.isposinf(upper)], low[np.isneginf(lower)] = 1.0, 0.0
        chance = np.maximum(top - low, 1e-12)
        d_top, d_low = weight * top * (1 - top) / chance, weight * low * (1 - low) / chance
        by_eta = d_low - d_top  # of the log-likelihood
        by_cut = np.bincount(y, d_top, len(grades))[:-1] - np.bincount(y, d_low, len(grades))[1:]
        tails = np.cumsum(by_cut[::-1])[::-1]
        gradient = np.concatenate([
            tails[:1],
            tails[1:] * gaps,
            np.bincount(index, share * by_eta[owner], n_bins) - ridge * w,
            forms.T @ by_eta - ridge * v,
        ])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        x = x + 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    cuts = x[0] + np.concatenate([[0.0], np.cumsum(np.exp(x[1:n_cuts]))])
    return Model(grades, cuts, x[n_cuts : n_cuts + n_bins], x[n_cuts + n_bins :])


def _rate(batches: Iterator[pa.RecordBatch], model: Model, good: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        expected, tail = [np.zeros(0)], [np.zeros(0)]
        for part in text_slices(batch.column("text")):
            if len(model.grades) < 2:
                only = model.grades[0] if len(model.grades) else np.nan
                expected.append(np.full(len(part), only))
                tail.append(np.full(len(part), float(not only < good)))
                continue
            below = model.at_most(model.scores(part))
            chances = np.diff(np.column_stack([np.zeros(len(part)), below, np.ones(len(part))]), axis=1)
            expected.append(chances @ model.grades)
            tail.append(chances[:, model.grades >= good].sum(axis=1))
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(np.concatenate(expected)), pa.array(np.concatenate(tail))],
            [*names, "expected_grade", "tail_probability"],
        )


def train(docs: DataFrame, labels: DataFrame, grade: str = "quality", per_grade: int = PER_GRADE) -> Model:
    """Fit on the documents that ``labels(doc_id, <grade>)`` rates; see ``training_sample``."""
    return fit(training_sample(docs, labels, grade, per_grade))


def rate(docs: DataFrame, model: Model, good: float = 1.0) -> DataFrame:
    """``doc_id, text_h, expected_grade, tail_probability`` for every row.

    The tail probability is that of a grade of ``good`` or better. Null and empty texts are
    scored like any text (no grams, form "empty"). Without training rows the expected grade
    is NaN and the tail probability 1: nothing is rejected unlearnt. Other columns are ignored.
    """
    weights = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights
    kind = docs.schema["doc_id"].dataType.simpleString()
    given = docs.select("doc_id", F.xxhash64("text").alias("text_h"), "text")
    return in_small_batches(given).mapInArrow(
        lambda batches: _rate(batches, weights.value, good),
        f"doc_id {kind}, text_h bigint, expected_grade double, tail_probability double",
    )


def _select(batches: Iterator[pa.RecordBatch], model: Model, good: float, tail: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for scored in _rate(iter([batch.select(["text"])]), model, good):
            yield batch.filter(pa.array(scored.column("tail_probability").to_numpy() >= tail))


def select(docs: DataFrame, model: Model, good: float = 1.0, tail: float = TAIL) -> DataFrame:
    """The rows of ``docs`` whose tail probability is at least ``tail``, all columns kept."""
    weights = docs.sparkSession.sparkContext.broadcast(model)
    return in_small_batches(docs).mapInArrow(lambda batches: _select(batches, weights.value, good, tail), docs.schema)
