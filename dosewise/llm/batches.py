"""Texts of an Arrow batch as one byte array, cut into slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18


@dataclass(frozen=True)
class Slice:
    """Rows ``rows`` of a batch: their UTF-8 bytes one after the other, and each text's bounds.

    A null text has no bytes. ``data`` is a view of the Arrow buffer; don't write to it.
    """

    rows: slice
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Consecutive rows with about ``limit`` bytes together; one longer text stands alone."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    octets = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1
        stop = min(max(stop, at + 1), len(column))
        low, high = int(bounds[at]), int(bounds[stop])
        yield Slice(slice(at, stop), octets[low:high], bounds[at:stop] - low, bounds[at + 1 : stop + 1] - low)
        at = stop


def windows8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one number, zero bytes after the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data), "<u8", padded, strides=(1,)).astype(np.uint64)


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values[start:end]`` (rows of a matrix too) for ordered, disjoint segments."""
    sums = np.zeros((len(starts), *values.shape[1:]), np.result_type(values.dtype, np.int64))
    full = ends > starts
    if full.any():
        # Segments follow one another, so the next segment's start ends this one.
        edges = np.stack([starts[full], ends[full]], axis=1).ravel()
        extended = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])
        sums[full] = np.add.reduceat(extended, edges, axis=0, dtype=sums.dtype)[::2]
    return sums
