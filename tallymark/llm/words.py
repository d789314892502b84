"""Words of whole texts as 64-bit hashes, a column at a time.

A text column of an Arrow batch is one buffer of UTF-8 bytes; its words are found and hashed by whole-array steps over blocks of
the buffer, so no Python string is made for a word and a text of any length takes bounded extra memory (16 bytes a word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
SLICE_BYTES = 1 << 19

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _letters(kept) -> np.ndarray:
    """A random 64-bit value for each byte of a word (A-Z as a-z), 0 for all others."""
    values = np.random.default_rng(20240611).integers(1, _MASK, 256, dtype=np.uint64, endpoint=True)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[[b for b in range(256) if not kept(b)]] = 0
    return values


#: Words ``[^\x20\x09-\x0D]+`` and words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing A-Z).
SPACED = _letters(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
ALPHANUMERIC = _letters(lambda b: b >= 0x80 or chr(b).isalnum())

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        values = np.full(max(n, BLOCK_BYTES + 4096), base, np.uint64)
        values[0] = 1
        known = _powers[base] = np.multiply.accumulate(values)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def _block_end(data: np.ndarray, bounds: np.ndarray, at: int, letters: np.ndarray) -> int:
    """The first place from `at` on where no word goes on."""
    last = int(bounds[np.searchsorted(bounds, at)])
    while at < last:
        gap = np.flatnonzero(letters[data[at : min(at + 4096, last)]] == 0)
        if len(gap):
            return at + int(gap[0])
        at = min(at + 4096, last)
    return at


def hash_words(column: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each row the place of its first word (one more entry at the end)."""
    data, bounds = column_bytes(column)
    hashes, places, lo = [], [], 0
    while lo < len(data):
        hi = len(data) if lo + BLOCK_BYTES >= len(data) else _block_end(data, bounds, lo + BLOCK_BYTES, letters)
        values = letters[data[lo:hi]]
        inside = values != 0
        edges = bounds[np.searchsorted(bounds, lo, "right") : np.searchsorted(bounds, hi)] - lo
        before = np.empty(hi - lo, bool)
        before[0], before[1:] = False, inside[:-1]
        before[edges] = False
        starts = np.flatnonzero(inside & ~before)
        if len(starts):
            after = np.empty(hi - lo, bool)
            after[-1], after[:-1] = False, inside[1:]
            after[edges - 1] = False
            ends = np.flatnonzero(inside & ~after)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(values * _power(_BASE, hi - lo), out=sums[1:])
            found = (sums[ends + 1] - sums[starts]) * _power(_INVERSE, hi - lo)[starts]
            hashes.append(mix(found + (ends - starts).astype(np.uint64)))
            places.append(starts + lo)
        lo = hi
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), bounds)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of `width` words in the array, whatever rows they belong to."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[k : k + n]
    return mix(out)


def slices(batch: pa.RecordBatch, text: str, size: int = 0) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `size` (SLICE_BYTES) bytes of text, a longer text alone."""
    size = size or SLICE_BYTES
    if batch.num_rows == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    piece = (np.cumsum(sizes) - sizes) // size
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        yield batch.slice(lo, hi - lo)
