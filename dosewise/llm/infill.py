"""Fill-in-the-middle: a text's middle moved to its end, between sentinels.

Where to cut is said in units, counted from the left: code points, or lines with their
ends. The UTF-8 bytes of a slice of texts are viewed as 64-bit words, and arithmetic on
whole words marks every byte that ends a unit. The marks of a word are counted at once and
the counts added up, so a unit's last byte is found by a search for its word and a select
within the word. Nothing is decoded, and no text is looked at byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewise.llm.batches import Slice, text_slices
from dosewise.llm.tables import in_small_batches

ONES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
CODE_POINT, LINE = "code_point", "line"
SEED = 1
MOVED = 90  # percent of documents that are cut
SUFFIX_FIRST = 20  # percent of these with the suffix first and the middle after the prefix


@dataclass(frozen=True)
class Sentinels:
    """Strings before the prefix, the suffix and the middle. The first character of one occurs
    nowhere else in them, so none can arise where a sentinel meets a piece of text."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = [self.prefix, self.suffix, self.middle]
        if not all(marks) or any(m[0] in n[1:] for m in marks for n in marks):
            raise ValueError("a sentinel's first character must not occur further on in a sentinel")
        if any(i != k and n.startswith(m) for i, m in enumerate(marks) for k, n in enumerate(marks)):
            raise ValueError("no sentinel may begin with another")


class Units:
    """The units of a slice's texts, as one mark in the byte that ends each."""

    def __init__(self, part: Slice, unit: str = CODE_POINT):
        padded = np.zeros(len(part.data) // 8 * 8 + 16, np.uint8)
        padded[: len(part.data)] = part.data
        words = padded.view("<u8").astype(np.uint64, copy=False)
        if unit == CODE_POINT:
            # A byte ends its code point if the byte after it is not 10xxxxxx.
            lead = (words >> np.uint64(7) & ~(words >> np.uint64(6)) & ONES) ^ ONES
            marks = lead >> np.uint64(8)
            marks[:-1] |= lead[1:] << np.uint64(56)
        elif unit == LINE:
            other = words ^ ONES * np.uint64(10)
            marks = ~(((other & LOW7) + LOW7) | other) >> np.uint64(7) & ONES
        else:
            raise ValueError(f"unit must be {CODE_POINT} or {LINE}, not {unit}")
        last = part.ends[part.ends > part.starts] - 1
        np.bitwise_or.at(marks, last >> 3, np.uint64(1) << ((last & 7) * 8).astype(np.uint64))
        self.marks = marks
        self.total = np.append(0, np.cumsum(np.bitwise_count(marks), dtype=np.int64))

    def before(self, at: np.ndarray) -> np.ndarray:
        """How many units end in the bytes before ``at``."""
        below = (np.uint64(1) << ((at & 7) * 8).astype(np.uint64)) - np.uint64(1)
        return self.total[at >> 3] + np.bitwise_count(self.marks[at >> 3] & below)

    def after(self, n: np.ndarray) -> np.ndarray:
        """The place behind the ``n``-th unit of the slice, counted from 1."""
        word = np.searchsorted(self.total, n, "left") - 1
        need = (n - self.total[word]).astype(np.uint64)
        # Byte i of the product counts the marks up to byte i; the high bit survives the
        # subtraction where they reach the number needed.
        reached = ((self.marks[word] * ONES | HIGH) - need * ONES) & HIGH
        return 8 * word + 9 - np.bitwise_count(reached).astype(np.int64)


def cuts(part: Slice, one: np.ndarray, other: np.ndarray, unit: str = CODE_POINT) -> tuple[np.ndarray, ...]:
    """For each text its number of units, the units before either cut, and the cuts' bytes.

    The cuts are at ``one`` and ``other``, each modulo the number of units plus one.
    """
    units = Units(part, unit)
    first = units.before(part.starts)
    n = units.before(part.ends) - first
    at = np.sort(np.stack([one % (n + 1), other % (n + 1)]), axis=0)
    places = np.where(at > 0, units.after(np.maximum(first + at, 1)), part.starts)
    return n, at[0], at[1], places[0], places[1]


MADE = "n bigint, form string, prefix_units bigint, middle_units bigint, output string"


def _moved(batches: Iterator[pa.RecordBatch], signs: Sentinels, unit: str, moved: int, suffix_first: int) -> Iterator[pa.RecordBatch]:
    prefix, suffix, middle = (s.encode() for s in (signs.prefix, signs.suffix, signs.middle))
    for batch in batches:
        one, other, whether, which = (batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4))
        rows = []
        for part in text_slices(batch.column("text")):
            found = cuts(part, one[part.rows], other[part.rows], unit)
            for i, (n, low, high, a, b) in enumerate(zip(*(x.tolist() for x in found))):
                row = part.rows.start + i
                body = part.text(i)
                a, b = a - int(part.starts[i]), b - int(part.starts[i])
                if not body or whether[row] % 100 >= moved or prefix in body or suffix in body or middle in body:
                    rows.append((n, "plain", None, None, body))
                elif which[row] % 100 < suffix_first:
                    rows.append((n, "spm", low, high - low, b"".join([suffix, body[b:], prefix, body[:a], middle, body[a:b]])))
                else:
                    rows.append((n, "psm", low, high - low, b"".join([prefix, body[:a], suffix, body[b:], middle, body[a:b]])))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        arrays[4] = arrays[4].cast(pa.string())
        kept = batch.select(["doc_id", "text_h"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, *arrays], [*kept.schema.names, "n", "form", "prefix_units", "middle_units", "output"]
        )


def fill_in_middle(
    docs: DataFrame,
    sentinels: Sentinels = Sentinels(),
    unit: str = CODE_POINT,
    seed: int = SEED,
    moved: int = MOVED,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """``doc_id, text_h, n, form, prefix_units, middle_units, output``, a row per row of ``docs``.

    ``n`` is the number of units of the text; ``form`` is ``plain``, ``psm`` or ``spm``. Null and
    empty texts, and texts that hold a sentinel, stay plain. The cuts and the form follow from
    ``seed`` and the id alone: rows equal in id and text get the same output, rows without an
    id are treated as if their id was the empty string. Other columns are ignored.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    group = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]
    given = docs.select("doc_id", F.xxhash64("text").alias("text_h"), "text", *group)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_small_batches(given).mapInArrow(
        lambda batches: _moved(batches, sentinels, unit, moved, suffix_first), f"doc_id {kind}, text_h bigint, {MADE}"
    )


def restored(form: Column, output: Column, sentinels: Sentinels = Sentinels()) -> Column:
    """The text that ``output`` was made from. Sentinels are not in it, so the first is the one."""
    mark = {k: F.lit(getattr(sentinels, k)) for k in ("prefix", "suffix", "middle")}

    def behind(text: Column, first: str) -> Column:
        return F.substr(text, F.lit(len(getattr(sentinels, first)) + 1))

    def pieces(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = behind(output, first)
        tail = F.split_part(rest, mark[second], F.lit(2))
        return (
            F.split_part(rest, mark[second], F.lit(1)),
            F.split_part(tail, mark["middle"], F.lit(1)),
            F.split_part(tail, mark["middle"], F.lit(2)),
        )

    prefix, suffix, middle = pieces("prefix", "suffix")
    suffix_, prefix_, middle_ = pieces("suffix", "prefix")
    moved = F.when(form == "psm", F.concat(prefix, middle, suffix))
    return moved.when(form == "spm", F.concat(prefix_, middle_, suffix_)).otherwise(output)
