"""Documents drawn towards a target distribution, by importance weights on hashed features.

Runs of words fall into a fixed number of buckets by checksum. How often each bucket occurs
in all documents and in the target texts gives its gain, and a document's weight is the sum
of the gains of its features, read from an array. A document's score adds noise that its
id determines, so that taking the best scores is drawing without replacement in
proportion to the weights.

The best are found without sorting everything. Scores are written once; then exact counts
over them, of several thresholds in one job, narrow down the least score that is drawn,
and in the same way the greatest id drawn among the documents with that score. Only drawn
rows are sorted, in ranges, and ranked from the ranges' counts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosewise.llm.batches import Slice, segment_sums, text_slices
from dosewise.llm.tables import in_small_batches, stored
from dosewise.llm.terms import IS_DIGIT, IS_LETTER, LOWER, words_within

BINS = 10_000
LONGEST = 1  # words in a feature
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
SCALE = 1000  # scores and gains are whole thousandths
SECTIONS = 32  # into which one counting job cuts what is left of a range
RANGE_ROWS = 1 << 20  # drawn rows ranked together
IS_WORD = IS_LETTER | IS_DIGIT
BY_COLUMN = 64  # bytes; longer words are few and go one at a time


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def _extended(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksums ``state`` continued by the bytes of one word each: a byte of all words at a time."""
    state = state.copy()
    sizes = ends - starts
    for i in np.flatnonzero(sizes > BY_COLUMN).tolist():
        state[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(state[i]))
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] <= BY_COLUMN]
    at = starts[order]
    inner = ~state[order]
    have = np.cumsum(np.bincount(sizes[order], minlength=BY_COLUMN + 1)[::-1])[::-1]  # words of at least so many bytes
    for i in range(BY_COLUMN):
        n = int(have[i + 1]) if i < BY_COLUMN else 0
        if n == 0:
            break
        octet = data[at[:n] + i]
        inner[:n] = CRC[(inner[:n] ^ octet) & np.uint32(0xFF)] ^ inner[:n] >> np.uint32(8)
    state[order] = ~inner
    return state


def features(part: Slice, longest: int = LONGEST, bins: int = BINS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and text and bucket of every feature.

    A word is a run of letters, digits and bytes beyond ASCII, A to Z lower-cased. Features
    are all runs of up to ``longest`` words of a text, joined by a space.
    """
    data = LOWER[part.data]
    starts, ends = words_within(part, IS_WORD[data])
    owner = np.searchsorted(part.ends, starts, "right")
    n_words = np.bincount(owner, minlength=len(part))
    state = np.zeros(len(starts), np.uint32)
    owners, buckets = [], []
    space = np.array([32], np.uint8)
    for size in range(1, longest + 1):
        if size > 1:
            # The run from each word, one word longer, as long as that is the same text's.
            same = owner[size - 1 :] == owner[: len(owner) - size + 1]
            state = state[: len(same)]
            zero = np.zeros(len(state), np.int64)
            state = _extended(state, space, zero, zero + 1)
            state = _extended(state, data, starts[size - 1 :], ends[size - 1 :])
            owners.append(owner[: len(same)][same])
            buckets.append((state % np.uint32(bins)).astype(np.int64)[same])
        else:
            state = _extended(state, data, starts, ends)
            owners.append(owner)
            buckets.append((state % np.uint32(bins)).astype(np.int64))
        if len(state) == 0:
            break
    return n_words, np.concatenate(owners), np.concatenate(buckets)


def _counted(batches: Iterator[pa.RecordBatch], longest: int, bins: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(bins, np.int64)
    for batch in batches:
        for part in text_slices(batch.column("text")):
            counts += np.bincount(features(part, longest, bins)[2], minlength=bins)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, longest: int = LONGEST, bins: int = BINS) -> np.ndarray:
    """How often each bucket occurs in the column ``text`` of all rows."""
    found = in_small_batches(texts.select("text")).mapInArrow(
        lambda batches: _counted(batches, longest, bins), "bucket bigint, n bigint")
    counts = np.zeros(bins, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``bins`` rows
        counts[row.bucket] = row.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Logarithm of a bucket's share of the target to that of the source, one added to each
    count, in thousandths and rounded down."""
    n_source, n_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([
        math.floor(SCALE * math.log((t + 1) * n_source / ((s + 1) * n_target))) for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def _weighed(batches: Iterator[pa.RecordBatch], gain: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [[np.zeros(0, np.int64)] for _ in range(3)]
        for part in text_slices(batch.column("text")):
            n_words, owner, bucket = features(part, longest, len(gain))
            order = np.argsort(owner, kind="stable") if longest > 1 else slice(None)
            n = np.bincount(owner, minlength=len(part))
            ends = np.cumsum(n)
            for column, values in zip(columns, (n_words, n, segment_sums(gain[bucket[order]], ends - n, ends))):
                column.append(values)
        names = ["doc_id", "text_h"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), *(pa.array(np.concatenate(c)) for c in columns)],
            [*names, "n_words", "n_features", "weight"],
        )


def weights(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """``doc_id, text_h, n_words, n_features, weight``, a row per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    kind = docs.schema["doc_id"].dataType.simpleString()
    given = docs.select("doc_id", F.xxhash64("text").alias("text_h"), "text")
    return in_small_batches(given).mapInArrow(
        lambda batches: _weighed(batches, sent.value, longest),
        f"doc_id {kind}, text_h bigint, n_words bigint, n_features bigint, weight bigint",
    )


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from the hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 32))
    return F.floor(-F.lit(float(SCALE)) * F.log(-F.log(share)))


def _bisected(low: int, high: int, wanted: int, counts: Callable[[list[int]], list[int]], sections: int) -> int:
    """The least value from ``low`` to ``high`` up to which there are at least ``wanted``.

    ``counts`` says for each of some values how many rows are not above it; at ``high`` they
    are enough.
    """
    while low < high:
        # Below low there are too few; high has enough.
        middle = sorted({low + (high - low) * i // sections for i in range(sections)})
        enough = [n >= wanted for n in counts(middle)]
        first = enough.index(True) if True in enough else len(middle)
        high = middle[first] if first < len(middle) else high
        low = middle[first - 1] + 1 if first > 0 else low
    return high


def _counts(rows: DataFrame, column: str) -> Callable[[list[int]], list[int]]:
    """Exact counts of the rows whose ``column`` is at most each of some values, in one job."""
    return lambda values: list(rows.agg(*[F.count_if(F.col(column) <= v).alias(f"n{i}") for i, v in enumerate(values)]).first())


def cutoff(scores: DataFrame, n_drawn: int, sections: int = SECTIONS) -> tuple[int, int | None]:
    """The least score that is drawn, and the greatest id drawn among the rows with it.

    ``scores`` has ``score`` and ``doc_id`` and is read once for every few bits of a score, so it
    should be a written table. Rows without an id come last: ``None`` draws them all.
    """
    falling = scores.select((-F.col("score")).alias("down"), "doc_id")
    ends = falling.agg(F.min("down").alias("low"), F.max("down").alias("high")).first()
    least = _bisected(ends.low, ends.high, n_drawn, _counts(falling, "down"), sections)
    counted = falling.agg(F.count_if(F.col("down") < least).alias("above")).first()
    tied = falling.where(F.col("down") == least)
    ends = tied.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("doc_id").alias("n")).first()
    if ends.n < n_drawn - counted.above:
        return -least, None
    return -least, _bisected(ends.low, ends.high, n_drawn - counted.above, _counts(tied, "doc_id"), sections)


def ranked(drawn: DataFrame, n_drawn: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``drawn`` with ``rank``: 1, 2, 3 ... by score, ties by id; null beyond ``n_drawn``."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_h"), F.col("row")]
    n_ranges = max(1, -(-n_drawn // range_rows))
    ranges = stored(drawn.repartitionByRange(n_ranges, *order).withColumn("part", F.spark_partition_id()), "drawn")
    sizes = {r.part: r.n for r in ranges.groupBy("part").agg(F.count("*").alias("n")).collect()}  # ``n_ranges`` rows
    parts = sorted(sizes)
    before = np.cumsum([0, *(sizes[p] for p in parts)])[:-1].tolist()
    offsets = drawn.sparkSession.createDataFrame(list(zip(parts, before)) or [(0, 0)], "part int, before bigint")
    own = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    placed = ranges.withColumn("own", own).join(F.broadcast(offsets), "part")  # one row a range
    rank = F.col("before") + F.col("own")
    return placed.withColumn("rank", F.when(rank <= n_drawn, rank)).drop("part", "own", "before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST,
    bins: int = BINS,
    seed: int = SEED,
    sections: int = SECTIONS,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``doc_id, text_h, n_words, n_features, weight, score, rank``, a row per row of ``docs``.

    Of the N rows with at least ``least_words`` words, ``percent * N // 100`` are drawn and ranked;
    the rest have no rank. Null and empty texts have no words and weight 0. Ids are whole
    numbers; rows without one share their noise and come last among equal scores. Rows equal
    in id and score are drawn in order of their text's hash; which of fully equal rows is
    drawn is left open, how many is not. With an empty target or no documents all counts
    are 0 and every bucket's gain follows from that. Other columns are ignored.
    """
    gain = gains(bucket_counts(docs, longest, bins), bucket_counts(target, longest, bins))
    scored = weights(docs, gain, longest).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scores = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    fit = F.col("n_words") >= least_words
    n_drawn = percent * scores.where(fit).count() // 100
    columns = ["doc_id", "text_h", "n_words", "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if n_drawn == 0:
        return scores.select(*columns, none)
    score, last = cutoff(scores.where(fit), n_drawn, sections)
    tied = F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(False))
    drawn = fit & ((F.col("score") > score) | (F.col("score") == score) & tied)
    rest = scores.where(~drawn).select(*columns, none)
    return ranked(scores.where(drawn), n_drawn, range_rows).select(*columns, "rank").unionByName(rest)
