"""SentencePiece encoding and decoding by vectorised merge rounds.

A slice of texts is one flat array of symbols, one a character. Between two characters that
stand together in no piece nothing can ever merge: there the array is cut into words, and
equal words of a slice are encoded once. Then rounds: every word finds the least rank among
its pairs of neighbours (a reduction by segments of one array), all words merge their pairs
of that rank at once, leftmost first, and finished words leave the array. A merge that may
make a pair of a better or equal rank than its own would change what comes next; pairs of
such a rank merge one at a time in each word, and a word with very many of them (a long run
of spaces) is finished by a priority queue, whose order all of this keeps.

Characters without a piece become one piece a byte. Decoding gathers the bytes of all pieces
of a slice at once.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.llm.batches import text_slices
from dosewise.llm.tables import in_small_batches
from dosewise.llm.terms import MIX

SLICE_BYTES = 1 << 20
SPACE = 0x2581
N_CODES = 0x110000
NONE = np.iinfo(np.int32).max
QUEUED = 64  # pairs that may only merge one at a time: a word with more goes to the queue
# Kinds of pieces, model types and field numbers of the model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
PAIR_MERGES = 2
PIECES, TRAINER, NORMALIZER = 1, 2, 3


def _fields(blob: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a message: numbers as they are, all else as bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            octet = blob[at]
            at += 1
            value |= (octet & 127) << shift
            shift += 7
            if octet < 128:
                return value

    while at < len(blob):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, blob[at : at + size]
            at += size


class PairTable:
    """Pairs of symbols to a number each, looked up for whole arrays by open addressing."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        self.probes = 1
        for (left, right), value in pairs.items():
            key = left << 21 | right
            slot = int(self._slots(np.array([key]))[0])
            probe = 1
            while self.keys[slot] >= 0:
                slot, probe = (slot + 1) % len(self.keys), probe + 1
            self.keys[slot], self.values[slot] = key, value
            self.probes = max(self.probes, probe)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * MIX
        return ((mixed ^ mixed >> np.uint64(32)) * MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pairs' numbers, ``NONE`` for a pair that is not in the table."""
        keys = left.astype(np.int64) << 21 | right
        slots = self._slots(keys)
        found = self.keys[slots]
        values = np.where(found == keys, self.values[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        for probe in range(1, self.probes):
            if len(open_) == 0:
                break
            slot = (slots[open_] + probe) % len(self.keys)
            found = self.keys[slot]
            hit = found == keys[open_]
            values[open_[hit]] = self.values[slot[hit]]
            open_ = open_[~hit & (found >= 0)]
        return values


@dataclass(frozen=True)
class Model:
    """A pair-merging model: its symbols are piece ids, and ``n_pieces`` plus the code point
    for characters without a piece."""

    n_pieces: int
    begin: int
    end: int
    byte_ids: np.ndarray  # by byte
    of_code: np.ndarray  # symbol by code point
    inside: PairTable  # characters that stand together in some piece
    merges: PairTable  # number of the merge of a pair
    rank: np.ndarray  # by merge: less is merged earlier; equal for pieces of one score
    product: np.ndarray  # by merge
    alone: np.ndarray  # by rank: merge one pair at a time
    prefix: bool  # a space before every text that is not empty
    body: np.ndarray  # bytes of all pieces, one after the other, as they are decoded
    body_at: np.ndarray  # where each piece's begin
    kind: np.ndarray
    opens: np.ndarray  # whether a piece begins with the space sign


def parse(blob: bytes) -> Model:
    """The model in ``blob``. Only pair-merging models with byte pieces, whose texts are taken
    as they are but for spaces, can be applied; others are refused."""
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(blob):
        if number == PIECES:
            own = dict(_fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
        elif number == TRAINER:
            trainer = dict(_fields(value))
        elif number == NORMALIZER:
            normalizer = dict(_fields(value))
    kinds = np.array([k for *_, k in pieces], np.int64)
    plain = trainer.get(3) == PAIR_MERGES and trainer.get(35) and not trainer.get(24)
    as_given = not normalizer.get(2) and not normalizer.get(4, 1) and normalizer.get(5, 1)
    if not plain or not as_given or not np.isin(kinds, [NORMAL, UNKNOWN, CONTROL, BYTE]).all():
        raise ValueError("not a pair-merging model with byte pieces and texts as given")
    n = len(pieces)
    normal = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
    of_code = np.arange(N_CODES, dtype=np.int32) + n
    for text, i in normal.items():
        if len(text) == 1:
            of_code[ord(text)] = i
    of_code[32] = of_code[SPACE]

    def symbol(text: str) -> int | None:
        return int(of_code[ord(text)]) if len(text) == 1 else normal.get(text)

    scores = sorted({pieces[i][1] for i in normal.values()}, reverse=True)
    rank_of = {score: i for i, score in enumerate(scores)}
    inside, merges, rank, product = {}, {}, [], []
    alone = np.zeros(len(scores), bool)
    for text, i in normal.items():
        own = rank_of[pieces[i][1]]
        for at in range(1, len(text)):
            inside[symbol(text[at - 1]), symbol(text[at])] = 0
            left, right = symbol(text[:at]), symbol(text[at:])
            if left is None or right is None:
                continue
            merges[left, right] = len(rank)
            rank.append(own)
            product.append(i)
            for part, whole in ((left, text[:at]), (right, text[at:])):
                if len(whole) > 1 and rank_of[pieces[part][1]] >= own:
                    alone[rank_of[pieces[part][1]]] = True
    unknown = trainer.get(44, " ⁇ ".encode())
    bodies = []
    byte_ids = np.zeros(256, np.int64)
    for i, (text, _, kind) in enumerate(pieces):
        if kind == BYTE:
            byte_ids[int(text[3:5], 16)] = i
        made = {CONTROL: b"", UNKNOWN: unknown, BYTE: bytes([int(text[3:5], 16)]) if kind == BYTE else b""}
        bodies.append(made[kind] if kind in made else text.replace(chr(SPACE), " ").encode())
    ids = {text: i for i, (text, *_) in enumerate(pieces)}
    begin, end = (ids[trainer.get(f, d).decode()] for f, d in ((46, b"<s>"), (47, b"</s>")))
    return Model(
        n, begin, end, byte_ids, of_code, PairTable(inside), PairTable(merges), np.array([*rank, NONE], np.int32),
        np.array(product, np.int32), alone, bool(normalizer.get(3, 1)), np.frombuffer(b"".join(bodies), np.uint8),
        np.append(0, np.cumsum([len(b) for b in bodies])), kinds,
        np.array([kind == NORMAL and text.startswith(chr(SPACE)) for text, _, kind in pieces]),
    )


@cache
def load(path: str | None = None) -> Model:
    """The model file at ``path``; by default the public ``piece_bpe_32k``."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return parse(file.read())


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...``: the indexes of segments, one segment after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _different(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One word of each kind, and for each word the number of its kind."""
    place = _runs(np.zeros(len(starts), np.int64), sizes)
    powers = np.cumprod(np.full(int(sizes.max()), MIX, np.uint64))
    mixed = (symbols.astype(np.uint64) + np.uint64(1)) * MIX
    digest = np.add.reduceat((mixed ^ mixed >> np.uint64(29)) * powers[place], starts)
    _, first, kind = np.unique(digest, return_index=True, return_inverse=True)
    model = first[kind]
    alike = sizes[model] == sizes
    if alike.all():
        alike = np.logical_and.reduceat(symbols == symbols[np.repeat(starts[model], sizes) + place], starts)
    if not alike.all():  # two words with one digest: take every word as it is
        return np.arange(len(starts)), np.arange(len(starts))
    return first, kind


def merged(model: Model, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of words after all merges, and how many each word has left.

    ``starts`` are the words' first symbols; words follow each other and are not empty.
    """
    n_words = len(starts)
    left = np.zeros(n_words, np.int64)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    word = np.arange(n_words)  # numbers of the words still there
    owner = np.repeat(np.arange(n_words), np.diff(np.append(starts, len(symbols))))
    merge = np.full(len(symbols), NONE, np.int32)
    near = np.flatnonzero(owner[1:] == owner[:-1])
    merge[near] = model.merges.get(symbols[near], symbols[near + 1])
    rank = np.where(merge == NONE, NONE, model.rank[np.minimum(merge, len(model.rank) - 1)])
    while len(word):
        best = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(symbols)))
        over = best == NONE
        if over.any():
            out = np.repeat(over, sizes)
            left[word[over]] = sizes[over]
            done.append((word[over], sizes[over], symbols[out]))
            stay = ~out
            symbols, merge, rank = symbols[stay], merge[stay], rank[stay]
            word, best, sizes = word[~over], best[~over], sizes[~over]
            if len(word) == 0:
                break
            starts = np.cumsum(sizes) - sizes
        at = np.flatnonzero(rank == np.repeat(best, sizes))
        if model.alone[best].any():
            of = np.searchsorted(starts, at, "right") - 1
            waiting = model.alone[best] & (np.bincount(of, minlength=len(starts)) > QUEUED)
            if waiting.any():
                for i in np.flatnonzero(waiting).tolist():
                    own = _in_turn(model, symbols[starts[i] : starts[i] + sizes[i]])
                    left[word[i]] = len(own)
                    done.append((word[i : i + 1], np.array([len(own)]), own))
                stay = ~np.repeat(waiting, sizes)
                symbols, merge, rank = symbols[stay], merge[stay], rank[stay]
                word, sizes = word[~waiting], sizes[~waiting]
                starts = np.cumsum(sizes) - sizes
                continue
        # Of pairs that overlap every second one, counted from the left of each chain.
        head = np.append(True, np.diff(at) > 1)
        chain = np.flatnonzero(head)
        turn = np.arange(len(at)) - chain[np.cumsum(head) - 1]
        of = np.searchsorted(starts, at, "right") - 1
        first = np.append(True, of[1:] != of[:-1])
        at = at[np.where(model.alone[best[of]], first, turn % 2 == 0)]
        symbols[at] = model.product[merge[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        gone = np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(starts))
        symbols, merge, rank = symbols[keep], merge[keep], rank[keep]
        sizes = sizes - gone
        starts = np.cumsum(sizes) - sizes
        # Where the merged symbols are now; their pairs to either side are new.
        at = at - np.arange(len(at))
        new = np.unique(np.concatenate([at, at - 1]))
        new = new[new >= 0]
        last = np.zeros(len(symbols), bool)
        last[starts + sizes - 1] = True
        pairs = new[~last[new]]
        merge[new] = NONE
        merge[pairs] = model.merges.get(symbols[pairs], symbols[pairs + 1])
        rank[new] = np.where(merge[new] == NONE, NONE, model.rank[np.minimum(merge[new], len(model.rank) - 1)])
    if not done:
        return symbols, left
    # Back into the order of the words.
    words, sizes, parts = (np.concatenate(x) for x in zip(*done))
    begins = np.cumsum(sizes) - sizes
    order = np.argsort(words)
    return parts[_runs(begins[order], sizes[order])], left


def _in_turn(model: Model, symbols: np.ndarray) -> np.ndarray:
    """The symbols of one word after all merges, one after the other by rank and place."""
    own = symbols.tolist()
    n = len(own)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    known: dict[tuple[int, int], tuple[int, int]] = {}
    queue: list[tuple[int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        pair = own[i], own[j]
        if pair not in known:
            merge = int(model.merges.get(*(np.array([x]) for x in pair))[0])
            known[pair] = (NONE, -1) if merge == NONE else (int(model.rank[merge]), int(model.product[merge]))
        if known[pair][0] != NONE:
            heapq.heappush(queue, (known[pair][0], i, *pair))

    for i in range(n - 1):
        offer(i, i + 1)
    while queue:
        _, i, left, right = heapq.heappop(queue)
        j = after[i]
        if own[i] != left or j < 0 or own[j] != right:
            continue  # one of the two has merged since
        own[i] = known[left, right][1]
        own[j] = -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
            offer(i, after[i])
        if before[i] >= 0:
            offer(before[i], i)
    return np.array([x for x in own if x >= 0], symbols.dtype)


def _with_bytes(model: Model, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids: symbols without a piece become the ids of their UTF-8 bytes."""
    bare = np.flatnonzero(symbols >= model.n_pieces)
    if len(bare) == 0:
        return symbols, owner
    codes = symbols[bare].astype(np.int64) - model.n_pieces
    sizes = np.ones(len(symbols), np.int64)
    sizes[bare] = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    made = np.repeat(symbols, sizes)
    octets = np.frombuffer(codes.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
    begins = np.cumsum(sizes) - sizes
    made[_runs(begins[bare], sizes[bare])] = model.byte_ids[octets]
    return made, np.repeat(owner, sizes)


def encode(model: Model, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a slice's texts, begin and end ids included, and how many each text has."""
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    lead = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    sizes = lead[ends] - lead[starts]
    symbols = model.of_code[codes]
    text = np.repeat(np.arange(len(starts)), sizes)
    if model.prefix:
        filled = np.flatnonzero(sizes)
        at = (np.cumsum(sizes) - sizes)[filled]
        symbols = np.insert(symbols, at, model.of_code[SPACE])
        text = np.insert(text, at, filled)
    if len(symbols):
        cut = np.append(True, text[1:] != text[:-1])
        cut[1:] |= model.inside.get(symbols[:-1], symbols[1:]) == NONE
        begins = np.flatnonzero(cut)
        lengths = np.diff(np.append(begins, len(symbols)))
        first, kind = _different(symbols, begins, lengths)
        own = symbols[_runs(begins[first], lengths[first])]
        made, n_made = merged(model, own, np.cumsum(lengths[first]) - lengths[first])
        at = np.cumsum(n_made) - n_made
        symbols = made[_runs(at[kind], n_made[kind])]
        symbols, text = _with_bytes(model, symbols, np.repeat(text[begins], n_made[kind]))
    counts = np.bincount(text, minlength=len(starts))
    ids = np.empty(len(symbols) + 2 * len(starts), np.int32)
    stops = np.cumsum(counts + 2)
    ids[stops - counts - 2] = model.begin
    ids[stops - 1] = model.end
    ids[np.arange(len(symbols)) + 2 * text + 1] = symbols
    return ids, counts + 2


def _whole(octets: bytes) -> bytes:
    """``octets`` with U+FFFD for each byte that is not part of a whole character."""
    try:
        octets.decode()
        return octets
    except UnicodeDecodeError:
        made, at = [], 0
    while at < len(octets):
        for size in (1, 2, 3, 4):
            try:
                made.append(octets[at : at + size].decode().encode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            made.append("�".encode())
            at += 1
    return b"".join(made)


def decode(model: Model, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The texts of lists of ids, in UTF-8. One space that the encoder put first is taken off;
    begin and end ids are nothing, and bytes that make no character are replaced."""
    if len(ids) and (ids.min() < 0 or ids.max() >= model.n_pieces):
        raise ValueError("an id is not in the model")
    sizes = np.diff(model.body_at)[ids]
    octets = model.body[_runs(model.body_at[ids], sizes)]
    ends = np.cumsum(counts)
    stops = np.append(0, np.cumsum(sizes))
    seen = np.flatnonzero(model.kind[ids] != CONTROL)
    texts = []
    first, last = np.searchsorted(seen, ends - counts).tolist(), np.searchsorted(seen, ends).tolist()
    for i, j in zip(first, last):
        if i == j:
            texts.append(b"")
            continue
        low, high = int(seen[i]), int(seen[j - 1]) + 1
        a, b = int(stops[low]) + bool(model.prefix and model.opens[ids[low]]), int(stops[high])
        if high - low == j - i:
            texts.append(_whole(octets[a:b].tobytes()))
        else:  # bytes to either side of a begin or end id make no character together
            breaks = stops[low:high][model.kind[ids[low:high]] == CONTROL].tolist()
            texts.append(b"".join([_whole(octets[x:y].tobytes()) for x, y in zip([a, *breaks], [*breaks, b])]))
    return texts


def _encoded(batches: Iterator[pa.RecordBatch], path: str | None, packed: bool) -> Iterator[pa.RecordBatch]:
    model = load(path)
    for batch in batches:
        found, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for part in text_slices(batch.column("text"), SLICE_BYTES):
            ids, n = encode(model, part.data, part.starts, part.ends)
            found.append(ids)
            counts.append(n)
        ids, stops = np.concatenate(found), np.append(0, np.cumsum(np.concatenate(counts)))
        if packed:
            bounds = pa.py_buffer((4 * stops).astype("<i4"))
            column = pa.Array.from_buffers(pa.binary(), len(stops) - 1, [None, bounds, pa.py_buffer(ids.astype("<u4"))])
        else:
            column = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_h"), column], ["doc_id", "text_h", "ids"])


def encoded(docs: DataFrame, path: str | None = None, packed: bool = False) -> DataFrame:
    """``doc_id, text_h, ids``, a row per row of ``docs``: ids with those of begin and end.

    ``ids`` is an array, or, if ``packed``, their little-endian 32-bit numbers in one binary.
    Null and empty texts are a begin and an end. Rows alike in text get alike ids; other
    columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    given = docs.select("doc_id", F.xxhash64("text").alias("text_h"), "text")
    ids = "binary" if packed else "array<int>"
    return in_small_batches(given).mapInArrow(
        lambda batches: _encoded(batches, path, packed), f"doc_id {kind}, text_h bigint, ids {ids}"
    )


def _decoded(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    model = load(path)
    for batch in batches:
        column = batch.column("ids")
        if pa.types.is_binary(column.type):
            lists = [np.frombuffer(b.as_buffer(), "<u4").astype(np.int64) if b.is_valid else np.zeros(0, np.int64) for b in column]
        else:
            lists = [np.asarray(v.values, np.int64) if v.is_valid else np.zeros(0, np.int64) for v in column]
        counts = np.array([len(x) for x in lists], np.int64)
        texts = decode(model, np.concatenate([np.zeros(0, np.int64), *lists]), counts)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*batch.schema.names, "text"]
        )


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` with the ``text`` of their ``ids``, an array or a packed binary; null is no ids.

    A column ``text`` that is there already gives way.
    """
    rows = rows.drop("text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return in_small_batches(rows).mapInArrow(lambda batches: _decoded(batches, path), f"{fields}, text string")
