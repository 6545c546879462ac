"""Benchmark passages in documents: q-gram lemma filter, then banded alignment.

A benchmark item is searched piece by piece: overlapping stretches of ``PIECE`` characters,
so a copy of part of an item is found too. A piece of m characters occurs in a document if
some stretch of the document is within k = ``RATE`` x m edits of it. By the q-gram lemma
such a stretch shares at least m + 1 - q(k + 1) of the piece's character q-grams, and its
alignment stays within k diagonals. So shared q-grams are counted in bands of diagonals
that overlap by k, bands that reach the bound are aligned, and nothing within the budget
is lost. Items under ``LEAST`` characters are no evidence if edited: they are found where
they stand exactly, those under ``Q`` by their whole text. Text is compared with ASCII letters in lower case and white space runs as one space.

Documents stay where they are: the index of a block of benchmark items, of bounded size,
goes to the tasks, and a larger benchmark takes more blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.llm.batches import Slice, text_slices, windows8
from dosewise.llm.tables import in_small_batches
from dosewise.llm.terms import bucket

Q = 8
PIECE = 100
RATE = 0.08
LEAST = 32  # items with fewer characters have no edits
BLOCK_BYTES = 8 << 20  # of benchmark text in one index
TABLE_BITS = 20
SLICE_BYTES = 1 << 19

FOLD = np.arange(128, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[[9, 10, 11, 12, 13]] = 32
NOWHERE = np.uint32(0xFFFFFFFF)


@dataclass(frozen=True)
class Folded:
    """Folded code points of all texts of a slice, their place in the texts, and text bounds."""

    chars: np.ndarray
    places: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def classes(self) -> np.ndarray:
        """One byte a character: equal characters have equal classes."""
        return np.where(self.chars < 128, self.chars, 128 + self.chars % 127).astype(np.uint8)


def fold(part: Slice) -> Folded:
    chars = np.frombuffer(part.data.tobytes().decode().encode("utf-32-le"), "<u4").copy()
    heads = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
    starts, ends = heads[part.starts], heads[part.ends]
    plain = chars < 128
    chars[plain] = FOLD[chars[plain]]
    space = chars == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[starts[starts < len(chars)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    own = np.arange(len(chars)) - np.repeat(starts, ends - starts)
    return Folded(chars[keep], own[keep], kept[starts], kept[ends])


def gram_codes(folded: Folded, q: int) -> tuple[np.ndarray, np.ndarray]:
    """A code per position for the q characters from there; whether they stay in the text."""
    codes = windows8(folded.classes) & np.uint64((1 << 8 * q) - 1)
    inside = np.ones(len(codes), bool)
    for back in range(1, q):
        at = folded.ends - back
        inside[at[at >= folded.starts]] = False
    return codes, inside


@dataclass(frozen=True)
class Index:
    """Pieces of benchmark items and where each q-gram occurs in them."""

    item_ids: list[int | None]
    items: np.ndarray  # by piece: place in item_ids
    chars: list[np.ndarray]  # by piece
    budgets: np.ndarray
    bounds: np.ndarray  # shared q-grams that an occurrence has at least
    codes: np.ndarray
    offsets: np.ndarray
    pieces: np.ndarray
    positions: np.ndarray
    table: np.ndarray
    q: int
    tiny: list[tuple[int, np.ndarray]]  # items shorter than q: place in item_ids, characters


def pieces_of(length: int, piece: int) -> list[tuple[int, int]]:
    """Stretches of ``piece`` characters, half overlapping, the last one up to the end."""
    if length <= piece:
        return [(0, length)]
    starts = [*range(0, length - piece, piece // 2), length - piece]
    return [(s, s + piece) for s in starts]


def build_index(items: list[tuple[int | None, str]], q: int = Q, piece: int = PIECE, rate: float = RATE) -> Index:
    ids, chars, grams, tiny = [], [], [], []
    for item_id, text in items:
        (part,) = text_slices(pa.array([text], pa.string()))
        whole = fold(part).chars
        # Blank margins are no part of a passage.
        solid = np.flatnonzero(whole != 32)
        whole = whole[solid[0] : solid[-1] + 1] if len(solid) else whole[:0]
        if len(whole) < q:
            if len(whole):
                tiny.append((item_id, whole))
            continue
        for a, b in pieces_of(len(whole), piece):
            own = Folded(whole[a:b], np.arange(b - a), np.array([0]), np.array([b - a]))
            codes, inside = gram_codes(own, q)
            ids.append(item_id)
            chars.append(own.chars)
            grams.append(codes[inside])
    sizes = np.array([len(c) for c in chars], np.int64)
    # Short pieces get the largest budget that still leaves one q-gram to share.
    budgets = np.where(sizes < LEAST, 0, np.minimum((rate * sizes).astype(np.int64), np.maximum((sizes - q) // q, 0)))
    counts = np.array([len(g) for g in grams], np.int64)
    code = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(grams)), counts)
    position = np.arange(len(code)) - np.repeat(np.cumsum(counts) - counts, counts)
    order = np.argsort(code, kind="stable")
    codes, firsts = np.unique(code[order], return_index=True)
    table = np.zeros(1 << TABLE_BITS, bool)
    table[bucket(codes, TABLE_BITS)] = True
    item_ids = list(dict.fromkeys([*ids, *(item_id for item_id, _ in tiny)]))
    place = {item_id: n for n, item_id in enumerate(item_ids)}
    return Index(
        item_ids, np.array([place[i] for i in ids], np.int64), chars, budgets, sizes + 1 - q * (budgets + 1), codes, np.append(firsts, len(code)),
        owner[order], position[order], table, q, [(place[item_id], whole) for item_id, whole in tiny],
    )


def banded(rows: np.ndarray, pieces: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each piece against any stretch of its row, along ``width`` diagonals,
    and where in the row the first such stretch ends."""
    n, most = pieces.shape
    big = np.int32(1 << 20)
    state = np.zeros((n, width + 1), np.int32)
    state[:, width] = big
    final = np.full((n, width), big, np.int32)
    steps = np.arange(width, dtype=np.int32)
    for j in range(most):
        along = state[:, :width] + (rows[:, j : j + width] != pieces[:, j : j + 1])
        best = np.minimum(along, state[:, 1:] + 1)
        best = np.minimum.accumulate(best - steps, axis=1) + steps
        state[:, :width] = best
        done = lengths == j + 1
        final[done] = best[done]
    at = final.argmin(axis=1)
    return final[np.arange(n), at], at + lengths


def _gather(chars: np.ndarray, first: np.ndarray, count: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    at = first[:, None] + np.arange(count)
    inside = (at >= low[:, None]) & (at < high[:, None])
    return np.where(inside, chars[np.clip(at, 0, len(chars) - 1)], NOWHERE)


def candidates(folded: Folded, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, piece and band of diagonals wherever enough q-grams are shared."""
    codes, inside = gram_codes(folded, index.q)
    none = np.zeros(0, np.int64)
    hit = index.table[bucket(codes, TABLE_BITS)] & inside
    at = np.flatnonzero(hit)
    if len(at) == 0 or len(index.codes) == 0:
        return none, none, none
    slot = np.minimum(np.searchsorted(index.codes, codes[at]), len(index.codes) - 1)
    real = index.codes[slot] == codes[at]
    at, slot = at[real], slot[real]
    # An occurrence has its q-grams within one stretch: a position goes on only if some
    # stretch of that length around it has enough hits of any kind. Text ends don't matter.
    reach = max((len(c) + int(k) for c, k in zip(index.chars, index.budgets)), default=0)
    need = max(int(index.bounds.min()), 1)
    ahead = np.searchsorted(at, at + reach, "right") - np.arange(len(at))
    dense = np.flatnonzero(ahead >= need)
    if len(dense) == 0:
        return none, none, none
    cover = np.zeros(len(at) + 1, np.int64)
    np.add.at(cover, dense, 1)
    np.add.at(cover, dense + ahead[dense], -1)
    chosen = np.cumsum(cover[:-1]) > 0
    at, slot = at[chosen], slot[chosen]
    count = index.offsets[slot + 1] - index.offsets[slot]
    entry = np.repeat(index.offsets[slot], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    where, piece = np.repeat(at, count), index.pieces[entry]
    text = np.searchsorted(folded.ends, where, "right")
    diagonal = where - index.positions[entry]
    stride = index.budgets[piece] + 1
    band = diagonal // stride
    # A band has 2k + 2 diagonals and starts every k + 1: each diagonal is in two.
    keys = np.concatenate([np.stack([text, piece, band]), np.stack([text, piece, band - 1])], axis=1)
    order = np.lexsort(keys[::-1])
    keys = keys[:, order]
    new = np.ones(keys.shape[1], bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    heads = np.flatnonzero(new)
    shared = np.diff(np.append(heads, keys.shape[1]))
    enough = heads[shared >= np.maximum(index.bounds[keys[1, heads]], 1)]
    return keys[0, enough], keys[1, enough], keys[2, enough]


def _exact(folded: Folded, index: Index) -> list[tuple[int, int, int, int, int]]:
    """``(text, item, start, end, 0)`` wherever an item shorter than a q-gram stands."""
    found = []
    for size in sorted({len(chars) for _, chars in index.tiny}):
        codes, inside = gram_codes(folded, size)
        own = [(item, chars) for item, chars in index.tiny if len(chars) == size]
        one = np.arange(size)
        wanted = [gram_codes(Folded(chars, one, np.array([0]), np.array([size])), size)[0][0] for _, chars in own]
        for at in np.flatnonzero(inside & np.isin(codes, np.array(wanted, np.uint64))).tolist():
            text = int(np.searchsorted(folded.ends, at, "right"))
            found += [(text, item, at, at + size, 0) for item, chars in own if (folded.chars[at : at + size] == chars).all()]
    return found


def regions(part: Slice, index: Index, at_once: int = 4096) -> list[tuple[int, int, int, int, int]]:
    """``(text, item, start, end, edits)`` of a slice: stretches (in the text's own code
    points) that hold pieces of an item, joined where they overlap; edits of the worst piece."""
    folded = fold(part)
    text, piece, band = candidates(folded, index)
    found = _exact(folded, index)
    for low in range(0, len(text), at_once):
        t, p, b = text[low : low + at_once], piece[low : low + at_once], band[low : low + at_once]
        k = index.budgets[p]
        lengths = np.array([len(index.chars[i]) for i in p])
        width = int((4 * k + 2).max())
        first = b * (k + 1) - k
        most = int(lengths.max())
        wanted = np.full((len(p), most), NOWHERE, np.uint32)
        for row, i in enumerate(p):
            wanted[row, : lengths[row]] = index.chars[i]
        rows = _gather(folded.chars, first, most + width, folded.starts[t], folded.ends[t])
        edits, stop = banded(rows, wanted, lengths, width)
        good = np.flatnonzero(edits <= k)
        if len(good) == 0:
            continue
        t, p, edits, lengths, k = t[good], p[good], edits[good], lengths[good], k[good]
        stop = first[good] + stop[good]
        # Backwards from the end: where the stretch starts. A longest stretch is not needed.
        back = np.full((len(p), most), NOWHERE, np.uint32)
        for row, i in enumerate(p):
            back[row, : lengths[row]] = index.chars[i][::-1]
        mirrored = folded.chars[::-1]
        size = len(mirrored)
        rows = _gather(mirrored, size - stop, most + int(k.max()) + 1, size - folded.ends[t], size - folded.starts[t])
        start = stop - _anchored(rows, back, lengths, int(k.max()))
        start = np.maximum(start, folded.starts[t])
        stop = np.minimum(stop, folded.ends[t])
        spans = zip(t.tolist(), index.items[p].tolist(), start.tolist(), stop.tolist(), edits.tolist())
        found += list(spans)
    joined = []
    for t, item, start, stop, edits in sorted(found):
        if joined and joined[-1][:2] == [t, item] and start <= joined[-1][3]:
            joined[-1][3] = max(joined[-1][3], stop)
            joined[-1][4] = max(joined[-1][4], edits)
        else:
            joined.append([t, item, start, stop, edits])
    return [
        (t, index.item_ids[item], int(folded.places[start]), int(folded.places[stop - 1]) + 1, edits)
        for t, item, start, stop, edits in joined
    ]


def _anchored(rows: np.ndarray, pieces: np.ndarray, lengths: np.ndarray, k: int) -> np.ndarray:
    """How much of each row, from its first character, its piece takes with fewest edits."""
    n, most = pieces.shape
    width = 2 * k + 1
    big = np.int32(1 << 20)
    padded = np.concatenate([np.full((n, k), NOWHERE, np.uint32), rows], axis=1)
    steps = np.arange(width, dtype=np.int32)
    state = np.full((n, width + 1), big, np.int32)
    state[:, k:width] = steps[: width - k]
    final = state[:, :width].copy()
    for j in range(most):
        along = state[:, :width] + (padded[:, j : j + width] != pieces[:, j : j + 1])
        along[:, : max(k - j, 0)] = big
        best = np.minimum(along, state[:, 1:] + 1)
        best = np.minimum.accumulate(best - steps, axis=1) + steps
        state[:, :width] = best
        done = lengths == j + 1
        final[done] = best[done]
    return final.argmin(axis=1) + lengths - k


def _matches(batches: Iterator[pa.RecordBatch], index: Index, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, spans = [], []
        for part in text_slices(batch.column("text"), SLICE_BYTES):
            for t, *span in regions(part, index):
                rows.append(part.rows.start + t)
                spans.append(span)
        picked = batch.select([n for n in batch.schema.names if n != "text"]).take(pa.array(rows, pa.int64()))
        columns = list(zip(*spans)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [*picked.columns, *(pa.array(c, f.type) for c, f in zip(columns, list(schema)))],
            [*picked.schema.names, *schema.names],
        )


SPANS = pa.schema([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())])


def _indexes(benchmark: DataFrame, block_bytes: int) -> Iterator[Index]:
    """An index per block of items; items are dealt into blocks of about the same size."""
    items = benchmark.select(F.col("item_id").cast("bigint"), "text").where("text is not null").distinct()
    named = items.where("item_id is not null")
    # An item without an id is searched too; one that repeats the text of others is no other item.
    items = named.union(items.where("item_id is null").join(named.select("text"), "text", "left_anti").select("item_id", "text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-int(total) // block_bytes))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    for block in range(n_blocks):
        rows = dealt.where(F.col("block") == block).select("item_id", "text").collect()
        yield build_index(sorted(((r.item_id, r.text) for r in rows), key=lambda i: (i[0] is None, i[0] or 0, i[1])))


def leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, text_h, item_id, start, end, edits``: benchmark passages found in documents.

    One row per document, item and region; offsets in code points, end exclusive. Null, empty
    and blank texts and items have no passage; items under ``LEAST`` characters are found exactly.
    Items with a null id come back with a null id, unless an item with an id has their text.
    Repeated documents come back each with its rows; repeated items count once.
    """
    spark = docs.sparkSession
    given = in_small_batches(docs.select("doc_id", F.xxhash64("text").alias("text_h"), "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_h bigint, item_id bigint, start bigint, end bigint, edits bigint"
    found = None
    for index in _indexes(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast(index)
        block = given.mapInArrow(lambda batches, sent=sent: _matches(batches, sent.value, SPANS), schema)
        found = block if found is None else found.union(block)
    return found


def _clean(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.ones(batch.num_rows, bool)
        for part in text_slices(batch.column("text"), SLICE_BYTES):
            keep[[part.rows.start + t for t, *_ in regions(part, index)]] = False
        yield batch.filter(pa.array(keep))


def without_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` with no passage of the benchmark, of items without an id neither;
    all columns kept."""
    for index in _indexes(benchmark, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        docs = in_small_batches(docs).mapInArrow(lambda batches, sent=sent: _clean(batches, sent.value), docs.schema)
    return docs
