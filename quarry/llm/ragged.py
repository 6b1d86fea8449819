"""Flat (ragged) numpy views of Arrow string columns.

A batch of texts is one byte array plus offsets; words are index ranges into
it.  Every helper works on a slice of bounded bytes, so the memory of a task
follows the slice and the longest single text, never the partition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once.
SLICE_BYTES = 1 << 20

_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def slices(batches, column: str, max_bytes: int = SLICE_BYTES):
    """Cut record batches into zero-copy slices of about ``max_bytes`` of text
    (a longer text stands alone)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, offsets = flat(batch.column(column))
        start = 0
        while start < n:
            end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
            end = min(max(end, start + 1), n)
            yield batch.slice(start, end - start)
            start = end


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    kind = np.int64 if large else np.int32
    if off is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_class(keep) -> np.ndarray:
    """A 256-entry table from a predicate over byte values."""
    return np.array([bool(keep(b)) for b in range(256)])


#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: `[^\\x20\\x09-\\x0D]`, and `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after lower-casing.
NOT_BLANK = byte_class(lambda b: b != 0x20 and not 9 <= b <= 13)
ALNUM = byte_class(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Maximal runs of bytes whose class is ``inside``, cut at text bounds:
    (starts, ends, index of the text, first word of each text and the total)."""
    mask = inside[data]
    n = len(mask)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    if n:
        before[0] = True
        np.logical_not(mask[:-1], out=before[1:])
        before |= edge[:-1]
        after = np.empty(n, bool)
        after[-1] = True
        np.logical_not(mask[1:], out=after[:-1])
        after |= edge[1:]
        starts, ends = np.flatnonzero(mask & before), np.flatnonzero(mask & after) + 1
    else:
        starts = ends = np.zeros(0, np.int64)
    bounds = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return starts, ends, text, bounds


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), _MULT if kind == "up" else _INV, np.uint64)
        step[0] = 1
        have = np.cumprod(step)
        if n <= 4 * SLICE_BYTES:  # a table for one very long text is not kept
            _powers[kind] = have
    return have[:n]


class Hashes:
    """Hashes of arbitrary byte ranges from one prefix sum (mod 2^64)."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", n), out=self.sums[1:])
        self.inverse = _power("down", n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 4 * SLICE_BYTES) -> np.ndarray:
    """Hashes of ascending ranges, made block by block: a hash does not depend
    on where its range lies, so a very long text needs no more memory."""
    if len(data) <= block:
        return Hashes(data).of(starts, ends)
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + block, side="right")))
        out[i:j] = Hashes(data[low : int(ends[j - 1])]).of(starts[i:j] - low, ends[i:j] - low)
        i = j
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits over the word (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(strings: list[bytes]) -> np.ndarray:
    """The hash that :class:`Hashes` gives each whole string."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.cumsum([len(s) for s in strings], dtype=np.int64) if strings else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if strings else ends
    return Hashes(data).of(starts, ends)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``bounds`` (empty ranges: 0)."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(s, s + c)`` for each pair."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(first, counts) + np.repeat(starts, counts)
