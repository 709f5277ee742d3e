"""Words of whole Arrow text columns as numpy arrays: bounds, 64-bit hashes, document bounds.

A word is a run of characters other than the six ASCII blanks. Texts are worked on in slices
of a bounded number of bytes (a single longer text is a slice of its own), so that a task's
memory does not depend on the size of its Arrow batches. Nothing is cut: every byte of every
text lies in exactly one slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
BLANKS = b" \t\n\x0b\x0c\r"
SPARK_WORD = r"[^\x20\x09-\x0D]+"

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Words:
    """Words of some texts: byte bounds, and per text the index of its first word."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # byte bounds of the texts in data, one more than texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # word bounds of the texts, one more than texts

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes; equal words have equal hashes anywhere."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        powers, inverses = _powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
        spans = (sums[self.ends] - sums[self.starts]) * inverses[self.starts]
        return mix(spans ^ (self.ends - self.starts).astype(np.uint64))

    def document(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _powers(n: int, _kept: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_kept.get("p", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("p", _BASE), ("i", _INVERSE)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _kept[name] = np.cumprod(row)
    return _kept["p"][:n], _kept["i"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; a null text is empty."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    column = column.fill_null("") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes each, or of one row."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def find_words(
    data: np.ndarray, offsets: np.ndarray, lower: bool = True, inside: np.ndarray | None = None
) -> Words:
    """Words of the texts between `offsets`, optionally with A-Z in lower case.

    `inside` tells for each of the 256 bytes whether it belongs to a word; default: no blank.
    """
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = np.where((data >= 65) & (data <= 90), data | np.uint8(32), data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13))) if inside is None else inside[data]
    nonempty = np.flatnonzero(np.diff(offsets))
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[nonempty]] = False
    after[offsets[nonempty + 1] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def word_slices(
    column: pa.Array, lower: bool = True, inside: np.ndarray | None = None
) -> Iterator[tuple[int, int, Words]]:
    """`(low, high, words)` for each slice of rows of a text column."""
    data, offsets = text_bytes(column)
    for low, high in slices(offsets):
        yield low, high, find_words(data, offsets[low : high + 1], lower, inside)
