"""Terms of Arrow columns as numpy arrays, inside tasks; light to import for their workers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_CELLS = 1_000_000  # values of lists worked on at a time
SLICE_BYTES = 1 << 23  # of texts worked on at a time

_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True


def _slices(ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges that hold at most `limit` by the running sums `ends`, or one row."""
    low, rows = 0, len(ends) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + limit, "right")) - 1)
        yield low, high
        low = high


def list_slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """(ids, values, row of each value) of a column of ids and one of lists without nulls."""
    ids, lists = batch.column(0), batch.column(1)
    lengths, values = np.diff(lists.offsets.to_numpy()), lists.flatten()
    ends = np.append(0, np.cumsum(lengths))
    for low, high in _slices(ends, SLICE_CELLS):
        rows = np.repeat(np.arange(high - low), lengths[low:high])
        yield ids.slice(low, high - low), values.slice(ends[low], ends[high] - ends[low]), rows


def token_slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """`list_slices` of the tokens of a column of texts in lower case without nulls.

    Tokens are those of `LEXICAL_TOKEN`: letters a-z and digits, and single hyphens between them.
    """
    ids, texts = batch.column(0), batch.column(1).cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    for low, high in _slices(ends, SLICE_BYTES):
        data, cuts = raw[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
        kept = ids.slice(low, high - low)
        if not len(data):
            yield kept, pa.array([], pa.string()), np.empty(0, np.int64)
            continue
        letter = _ALNUM[data]
        held = cuts[:-1][np.diff(cuts) > 0]  # first bytes of the texts
        behind, ahead = np.append(False, letter[:-1]), np.append(letter[1:], False)
        behind[held], ahead[held[1:] - 1] = False, False
        inside = letter | ((data == ord("-")) & behind & ahead)
        start = inside & ~np.append(False, inside[:-1])
        start[held] = inside[held]
        first = np.flatnonzero(start)
        places = np.cumsum(inside, dtype=np.int32)
        bounds = np.append(places[first] - 1, places[-1]).astype(np.int32)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])]
        rows = np.searchsorted(cuts, first, "right") - 1
        yield kept, pa.StringArray.from_buffers(len(first), buffers[1], buffers[2]), rows


def count_terms(slices: Iterator[tuple[pa.Array, pa.Array, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """(document_id, length, counts, n_terms) of slices of tokens; terms in sorted order."""
    for ids, tokens, rows in slices:
        coded = tokens.dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        rank = np.argsort(order.to_numpy())
        n_terms = max(len(order), 1)
        found, tf = np.unique(rows * n_terms + rank[coded.indices.to_numpy()], return_counts=True)
        terms = coded.dictionary.take(order).take(pa.array(found % n_terms))
        pairs = pa.StructArray.from_arrays([terms, pa.array(tf, pa.int64())], ["term", "tf"])
        held = np.bincount(found // n_terms, minlength=len(ids))
        counts = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(held)), pa.int32()), pairs)
        length = pa.array(np.bincount(rows, minlength=len(ids)), pa.int64())
        columns = [ids, length, counts, pa.array(held, pa.int32())]
        yield pa.record_batch(columns, ["document_id", "length", "counts", "n_terms"])


def hashed_cells(
    slices: Iterator[tuple[pa.Array, pa.Array, np.ndarray]], dimensions: int
) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, cells): signed sums of (term, tf) by the bucket of each term; a term is hashed once."""
    for ids, pairs, rows in slices:
        coded = pairs.field(0).dictionary_encode()
        digests = b"".join(hashlib.md5(t.encode()).digest() for t in coded.dictionary.to_pylist())
        digests = np.frombuffer(digests, np.uint8).reshape(-1, 16)
        bucket = digests[:, :4].copy().view(">u4").ravel().astype(np.int64) % dimensions
        sign = 1 - 2 * (digests[:, 4] >> 4 & 1).astype(np.int64)
        code, tf = coded.indices.to_numpy(), pairs.field(1).to_numpy()
        # Whole numbers, which doubles add up exactly
        cells = np.bincount(rows * dimensions + bucket[code], sign[code] * tf, len(ids) * dimensions).astype(np.int64)
        ends = pa.array(np.arange(len(ids) + 1) * dimensions, pa.int32())
        yield ids, pa.ListArray.from_arrays(ends, pa.array(cells))
