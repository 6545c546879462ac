"""Documents packed into training sequences by a configuration linear program.

A document's tokens and an end id are cut into pieces of at most ``capacity`` tokens, the
first one being the shorter. Only the histogram of piece lengths, at most ``capacity``
numbers, reaches the driver. There a configuration says how many pieces of each length
share a sequence, and the program asks for the fewest sequences whose configurations
cover the histogram.

Multiplicative weights solve it. A length's price is its share of a sequence and falls as
it gets covered; a knapsack by dynamic programming finds what a sequence is worth at
most at these prices, and for each length the dearest configuration with it. Those within
``NEAR`` of the most are used, none so far that a length's cover grows by more than ``STEP`` at
once, so all lengths are covered at about the same time. The histogram at any prices,
divided by what a sequence is worth at most, is a bound from below; if the solution is not
within ``GAP`` of the best bound, it is sought again with prices that fall faster.

Then uses are rounded, whole ones first and then the greatest fractions as long as their
pieces are there, and the program is solved again for what is left, until that is less
than ``REST`` of all. Only this rest is packed by best fit, longest piece first.

The plan says for each length which ranks go to which sequences, in runs. Ranks are dealt
by hashed shares of each length, so a length with a third of all pieces is many tasks.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosewise.llm.batches import text_slices
from dosewise.llm.tables import in_small_batches, stored

CAPACITY = 1024
END_ID = 2
STEP = 0.02  # share of a length's pieces that may be covered at one set of prices
NEAR = 0.01  # how far from the dearest a configuration may be that is used
RATES = (0.1, 1.0, 10.0)  # of the fall of prices with cover, one after the other
GAP = 0.01  # between solution and bound: near enough
REST = 0.02  # of all tokens: little enough for best fit
SHARE_ROWS = 1 << 14  # pieces that are ranked together
# White space as the pattern has it; Python's has more.
LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{50000,}")


def tokenizer(ranks_path: str | None = None, pattern: str | None = None, special: dict[str, int] | None = None):
    """The byte-level BPE given as ranks; by default ``byte_bpe_50k``, whose ids equal those
    of the same vocabulary's JSON file. Only strings in ``special`` have ids of their own."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special or {})


@cache
def _blank_tokenizer(ranks_path: str | None):
    return tokenizer(ranks_path, r"\s+")


def encoded(coding, text: str, ranks_path: str | None = None) -> np.ndarray:
    """The ids of ``text``, whatever the length of its runs of white space.

    The pattern's look-ahead keeps a state for each character of such a run, and gives up at
    a million. Its match is known: the whole run at the end of the text, and all but the last
    character elsewhere. Then these are merged on their own, and the text between them.
    """
    try:
        return coding.encode_to_numpy(text, allowed_special="all")
    except ValueError:
        blank, found, at = _blank_tokenizer(ranks_path), [], 0
        for run in LONG_BLANK.finditer(text):
            end = run.end() - (run.end() < len(text))
            found.append(coding.encode_to_numpy(text[at : run.start()], allowed_special="all"))
            found.append(blank.encode_to_numpy(text[run.start() : end], disallowed_special=()))
            at = end
        return np.concatenate([*found, coding.encode_to_numpy(text[at:], allowed_special="all")])


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece: full ones at the end, the rest first."""
    first = length % capacity or capacity
    starts = [0, *range(first, length, capacity)]
    return [(s, (starts[i + 1] if i + 1 < len(starts) else length) - s) for i, s in enumerate(starts)]


def _tokenized(
    batches: Iterator[pa.RecordBatch], path: str | None, capacity: int, with_ids: bool, special: dict[str, int] | None
) -> Iterator[pa.RecordBatch]:
    coding = tokenizer(path, special=special)
    for batch in batches:
        rows, pieces, ids = [], [], []
        for part in text_slices(batch.column("text")):
            for i in range(len(part)):
                tokens = encoded(coding, part.text(i).decode(), path)
                tokens = np.append(tokens, END_ID).astype("<u4")
                for n, (start, length) in enumerate(cuts(len(tokens), capacity)):
                    own = tokens[start : start + length]
                    rows.append(part.rows.start + i)
                    pieces.append((n, start, length, zlib.crc32(own.tobytes())))
                    if with_ids:
                        ids.append(own.astype(np.int32))
        kept = batch.select([n for n in batch.schema.names if n != "text"]).take(pa.array(rows, pa.int64()))
        columns = list(zip(*pieces)) or [(), (), (), ()]
        arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int64(), pa.int64(), pa.int64()])]
        names = ["piece", "start", "length", "ids_crc32"]
        if with_ids:
            arrays.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays([*kept.columns, *arrays], [*kept.schema.names, *names])


def pieces(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False, special: dict[str, int] | None = None
) -> DataFrame:
    """``doc_id, text_h, piece, start, length, ids_crc32`` (and ``ids``); null texts are empty.

    A string such as ``<|endoftext|>`` in a text is ordinary, unless ``special`` gives it an id.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_h bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    given = docs.select("doc_id", F.xxhash64("text").alias("text_h"), "text")
    return in_small_batches(given).mapInArrow(
        lambda batches: _tokenized(batches, path, capacity, with_ids, special), schema + ", ids array<int>" * with_ids
    )


def _worth(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room what the pieces that fit are worth at most, by dynamic programming, and
    the index of one of them (of equally dear ones the longest), -1 if the room is not full."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        n = fits[room]
        if n:
            worth = (best[room - lengths[:n]] + prices[:n])[::-1]
            top = int(worth.argmax())
            if worth[top] > best[room] + 1e-12:
                best[room], choice[room] = worth[top], n - 1 - top
    return best, choice


def _filling(choice: np.ndarray, lengths: np.ndarray, room: int) -> Counter:
    """The pieces that fill a room as dearly as possible: index of length to count."""
    found: Counter = Counter()
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            found[int(choice[room])] += 1
            room -= int(lengths[choice[room]])
    return found


def _covering(
    lengths: np.ndarray, wanted: np.ndarray, capacity: int, rate: float, step: float, near: float
) -> tuple[dict[tuple, float], float]:
    """Uses of configurations that cover every length exactly, and the best bound on the way."""
    covered = np.zeros(len(lengths))
    uses: dict[tuple, float] = {}
    bound = 0.0
    while True:
        left = np.flatnonzero(covered < 1 - 1e-6)
        if len(left) == 0:
            return uses, bound
        own = lengths[left]
        prices = own / capacity * np.exp(-rate * (covered[left] - covered[left].min()))
        best, choice = _worth(own, prices, capacity)
        # Prices of some lengths, zero for the others, bound the whole program as well.
        bound = max(bound, float((wanted[left] * prices).sum() / best[capacity]))
        worth = prices + best[capacity - own]
        room = np.minimum(step, 1 - covered[left]) * wanted[left]
        for i in np.argsort(-worth, kind="stable").tolist():
            if worth[i] < (1 - near) * worth.max():
                break
            if room[i] <= 0:
                continue
            found = _filling(choice, own, capacity - int(own[i]))
            found[i] += 1
            use = min(room[k] / n for k, n in found.items())
            if use <= 0:
                continue
            for k, n in found.items():
                room[k] -= use * n
                covered[left[k]] += use * n / wanted[left[k]]
            key = tuple(sorted(((int(own[k]), n) for k, n in found.items()), reverse=True))
            uses[key] = uses.get(key, 0.0) + use


def _bound(lengths: np.ndarray, wanted: np.ndarray, capacity: int, rate: float = 1.0, step: float = 0.1, turns: int = 150) -> float:
    """A bound by prices alone: lengths may be covered more than once and get cheap, so what
    fills up sequences for nothing ends with no price."""
    covered = np.zeros(len(lengths))
    bound = 0.0
    for _ in range(turns):
        prices = lengths / capacity * np.exp(-rate * (covered - covered.min()))
        best, choice = _worth(lengths, prices, capacity)
        bound = max(bound, float((wanted * prices).sum() / best[capacity]))
        room = step * wanted
        worth = prices + best[capacity - lengths]
        for i in np.argsort(-worth, kind="stable").tolist():
            if worth[i] < (1 - NEAR) * best[capacity]:
                break
            found = _filling(choice, lengths, capacity - int(lengths[i]))
            found[i] += 1
            use = max(0.0, min(room[k] / n for k, n in found.items()))
            for k, n in found.items():
                room[k] -= use * n
                covered[k] += use * n / wanted[k]
    return bound


@dataclass(frozen=True)
class Solution:
    """Fractional uses of configurations ``((length, count), ...)`` and a bound from below."""

    uses: dict[tuple, float]
    bound: float

    @property
    def value(self) -> float:
        return sum(self.uses.values())


def configurations(
    histogram: dict[int, int], capacity: int, step: float = STEP, near: float = NEAR, rates: tuple[float, ...] = RATES
) -> Solution:
    """The program solved by multiplicative weights, in phases until it is near its bound.

    No length is covered more than once, so nothing has to be taken out again.
    """
    lengths = np.array(sorted(histogram), np.int64)
    wanted = np.array([histogram[k] for k in lengths.tolist()], float)
    found = Solution({}, 0.0)
    for phase, rate in enumerate(rates if len(lengths) else ()):
        uses, bound = _covering(lengths, wanted, capacity, rate, step, near)
        bound = max(bound, found.bound)
        if phase == 0 and sum(uses.values()) > bound * (1 + GAP):
            bound = max(bound, _bound(lengths, wanted, capacity))
        better = phase == 0 or sum(uses.values()) < found.value
        found = Solution(uses if better else found.uses, bound)
        if found.value <= bound * (1 + GAP):
            break
    return found


def rounded(solution: Solution, left: dict[int, int], capacity: int, near: float = NEAR) -> list[tuple[tuple, int]]:
    """Configurations and how often each is used; what they hold is taken from ``left``.

    First the whole uses, then one more of those with the greatest fractions, if the pieces
    are there and the sequence is as good as full.
    """
    taken: dict[tuple, int] = {}
    by_fraction = sorted(solution.uses.items(), key=lambda c: (-(c[1] % 1), c[0]))
    for more in (False, True):
        for chosen, use in by_fraction:
            if more and sum(k * n for k, n in chosen) < (1 - near) * capacity:
                continue
            whole = int(use % 1 > 1e-6) if more else int(use + 1e-6)
            whole = min(whole, *(left[k] // n for k, n in chosen))
            if whole > 0:
                taken[chosen] = taken.get(chosen, 0) + whole
                for k, n in chosen:
                    left[k] -= n * whole
    return list(taken.items())


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Longest pieces first, each into the fullest sequence with room for it.

    Like sequences are filled together, so the work depends on the number of lengths, not
    of pieces. Returns lengths in a sequence, and how many sequences are so filled.
    """
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms = 0  # bit r is set if some sequence has room r

    def put(room: int, members: tuple[int, ...], times: int) -> None:
        nonlocal rooms
        by_room.setdefault(room, []).append((members, times))
        rooms |= 1 << room

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n > 0:
            fitting = rooms >> length
            if not fitting:
                together = capacity // length
                if n < together:
                    put(capacity - n * length, (length,) * n, 1)
                    break
                put(capacity - together * length, (length,) * together, n // together)
                n %= together
                continue
            room = length + (fitting & -fitting).bit_length() - 1
            members, times = by_room[room].pop()
            used = min(n, times)
            if used < times:
                by_room[room].append((members, times - used))
            elif not by_room[room]:
                rooms &= ~(1 << room)
            put(room - length, (*members, length), used)
            n -= used
    return [(list(members), times) for groups in by_room.values() for members, times in groups]


@dataclass(frozen=True)
class Plan:
    """Runs: pieces of ``length`` with ranks from ``rank`` on go to the sequences from
    ``sequence`` on, one each, at ``offset``. Ordered by length and rank.

    ``n_full`` sequences hold one full piece, ``n_program`` come from the program and ``n_rest`` from
    best fit; ``value`` and ``bound`` are the program's first solution and its bound.
    """

    keys: np.ndarray  # length and rank in one number
    ranks: np.ndarray
    sequences: np.ndarray
    offsets: np.ndarray
    n_full: int
    n_program: int
    n_rest: int
    value: float
    bound: float

    @property
    def n_sequences(self) -> int:
        return self.n_full + self.n_program + self.n_rest


RANK_BITS = 48


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Where every rank of every length goes. The size of the plan depends on ``capacity``
    and not on the number of pieces."""
    left = {k: int(n) for k, n in histogram.items() if n > 0}
    n_full = left.pop(capacity, 0)
    groups: list[tuple[list[int], int]] = [([capacity], n_full)] if n_full else []
    tokens = rest = sum(k * n for k, n in left.items())
    first: Solution | None = None
    n_program = 0
    while rest > REST * tokens:
        solution = configurations(left, capacity)
        first = first or solution
        chosen = rounded(solution, left, capacity)
        if not chosen:
            break
        groups += [([k for k, n in members for _ in range(n)], times) for members, times in chosen]
        n_program += sum(times for _, times in chosen)
        left = {k: n for k, n in left.items() if n > 0}
        rest = sum(k * n for k, n in left.items())
    by_fit = best_fit(left, capacity)
    groups += by_fit
    rank: dict[int, int] = dict.fromkeys(histogram, 0)
    runs, sequence = [], 0
    for members, times in groups:
        offset = 0
        for length in members:
            runs.append((length, rank[length], sequence, offset))
            rank[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(runs), np.int64).reshape(-1, 4)
    return Plan(
        (table[:, 0] << RANK_BITS) + table[:, 1], table[:, 1], table[:, 2], table[:, 3],
        n_full, n_program, sum(times for _, times in by_fit), first.value if first else 0.0, first.bound if first else 0.0,
    )


def _placed(batches: Iterator[pa.RecordBatch], made: Plan) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length, rank = (batch.column(n).to_numpy().astype(np.int64) for n in ("length", "rank"))
        run = np.searchsorted(made.keys, (length << RANK_BITS) + rank, "right") - 1
        names = [n for n in batch.schema.names if n != "rank"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(made.sequences[run] + rank - made.ranks[run]), pa.array(made.offsets[run])],
            [*names, "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    share_rows: int = SHARE_ROWS,
    special: dict[str, int] | None = None,
) -> DataFrame:
    """``doc_id, text_h, piece, start, length, ids_crc32, sequence_id, offset``, a row per piece.

    Every row of ``docs`` is packed, repeated rows too; null and empty texts are one end id.
    Sequences are filled from offset 0 without gaps. Other columns are ignored. Which of
    several pieces of one length goes where is left open; pieces are numbered as they are
    written, so rows alike in everything are dealt as evenly as any.
    """
    numbered = pieces(docs, path, capacity, special=special).withColumn("number", F.monotonically_increasing_id())
    found = stored(numbered, "pieces")
    histogram = {r.length: r.n for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    n_shares = max(1, -(-sum(histogram.values()) // share_rows))
    dealt = found.withColumn("share", F.pmod(F.xxhash64("number"), F.lit(n_shares)))
    sizes = dealt.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("share")) - F.col("n")
    sizes = sizes.select("length", "share", before.alias("before"))
    own = Window.partitionBy("length", "share").orderBy("number")
    ranked = dealt.withColumn("own", F.row_number().over(own)).join(sizes, ["length", "share"])
    columns = [c for c in found.columns if c != "number"]
    ranked = ranked.withColumn("rank", F.col("before") + F.col("own") - 1).select(*columns, "rank")
    made = docs.sparkSession.sparkContext.broadcast(plan(histogram, capacity))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema if f.name != "number")
    return ranked.mapInArrow(
        lambda batches: _placed(batches, made.value), f"{fields}, sequence_id bigint, offset bigint"
    )


def sequences(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, each at most ``capacity`` ids."""
    key = ["doc_id", "text_h", "piece", "start", "length", "ids_crc32"]
    places = pack(docs, path, capacity)
    # Rows that repeat a document have as many places as copies: number both alike.
    copy = F.row_number().over(Window.partitionBy(*key).orderBy("sequence_id", "offset")).alias("copy")
    places = places.select(*key, "sequence_id", "offset", copy)
    tokens = pieces(docs, path, capacity, with_ids=True).groupBy(*key).agg(F.first("ids").alias("ids"))
    tokens = tokens.withColumnsRenamed({"doc_id": "its_id"})
    on = [F.col("doc_id").eqNullSafe(F.col("its_id")), *[places[k] == tokens[k] for k in key[1:]]]
    cond = on[0]
    for part in on[1:]:
        cond = cond & part
    joined = places.join(tokens, cond).select("sequence_id", "offset", "ids")
    grouped = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return grouped.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
