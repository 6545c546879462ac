"""Hashed text terms for linear models, computed for whole slices of text at once."""

from __future__ import annotations

import numpy as np

from dosewise.llm.batches import Slice, segment_sums, windows8

MIX = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
IS_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
IS_LETTER = IS_UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | (np.arange(256) >= 128)
IS_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)


def bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    """Multiplicative hash to ``bits`` bits."""
    mixed = (keys ^ (keys >> np.uint64(29))) * MIX
    return ((mixed ^ (mixed >> np.uint64(32))) * MIX >> np.uint64(64 - bits)).astype(np.int64)


def grams(part: Slice, size: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A bucket per position for the ``size`` bytes from there, and a mask of the positions
    whose bytes stay inside their text."""
    mask = np.uint64((1 << 8 * size) - 1)
    inside = np.ones(len(part.data), bool)
    for back in range(1, size):
        at = part.ends - back
        inside[at[(at >= part.starts)]] = False
    return bucket(windows8(part.data) & mask, bits), inside


def words(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of ``inside`` bytes."""
    edges = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def shape(part: Slice) -> np.ndarray:
    """Per text, shares between 0 and 1 that describe its form rather than its words.

    Columns: spaces, capitals, digits, other signs, words equal to the word before,
    one-byte words, words ending in a sign, mean word length / 20 (at most 1), empty.
    """
    lengths = np.maximum(part.ends - part.starts, 1)[:, None]
    letter, space = IS_LETTER[part.data], IS_SPACE[part.data]
    digit = IS_DIGIT[part.data]
    flags = np.stack([space, IS_UPPER[part.data], digit, ~(letter | space | digit)], axis=1)
    shares = segment_sums(flags, part.starts, part.ends) / lengths

    solid = ~space
    if len(part.data):
        # A word ends where its text ends.
        starts, ends = words_within(part, solid)
    else:
        starts = ends = np.zeros(0, np.int64)
    owner = np.searchsorted(part.ends, starts, "right")
    size = ends - starts
    padded = windows8(part.data)
    # The first and the last eight bytes and the length tell words apart well enough.
    short = np.minimum(size, 8).astype(np.uint64) * np.uint64(8)
    mask = np.where(size >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (short % np.uint64(64))) - np.uint64(1))
    sketch = (padded[starts] & mask) * MIX + (padded[np.maximum(ends - 8, starts)] & mask) + size.astype(np.uint64)
    again = np.zeros(len(starts), bool)
    again[1:] = (sketch[1:] == sketch[:-1]) & (owner[1:] == owner[:-1])
    last = part.data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    marks = ~(IS_LETTER[last] | IS_DIGIT[last])
    columns = [again, size == 1, marks, np.minimum(size, 20) / 20]
    n_words = np.bincount(owner, minlength=len(part))
    per_word = [np.bincount(owner, weights=c, minlength=len(part)) / np.maximum(n_words, 1) for c in columns]
    return np.column_stack([shares, *per_word, n_words == 0])


def words_within(part: Slice, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``inside`` bytes, cut at the ends of texts."""
    starts, ends = words(part.data, inside)
    cuts = part.ends[:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(part.data))]
    cuts = np.unique(cuts[inside[cuts] & inside[cuts - 1]]) if len(cuts) else cuts
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends


SHAPES = 9
