"""Numpy over Arrow text columns: words, their hashes, and runs, without an object per word.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased. All these
are single bytes in UTF-8, so text is never decoded. Memory follows the bytes of a slice of
texts (``slices``), or one text where that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_STEP = 1 << 20  # bytes hashed at a time
_P = 0x9E3779B97F4A7C55
_P_INV = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of ordered pairs of hashes."""
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + right)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _P), ("down", _P_INV)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def slices(texts: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together have at most ``limit`` bytes, or a single row."""
    ends = np.cumsum(
        np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), np.int64)
    )
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets; null counts as empty."""
    texts = pa.compute.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word in order, and the n + 1 positions at which rows begin and end."""
    raw, offsets = text_bytes(texts)
    inside = ~_SEPARATOR[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(raw)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    bounds = np.searchsorted(starts, offsets)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, first + _STEP, "right")))
        piece = _LOWER[raw[first : ends[stop - 1]]]
        up, down = _power_tables(max(len(piece) + 1, _STEP + 1))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece + np.uint64(1)) * up[: len(piece)], out=sums[1:])
        s, e = starts[at:stop] - first, ends[at:stop] - first
        hashes[at:stop] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        at = stop
    return mix(hashes), bounds


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """For every item, the row it belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles of each row, sorted; a shorter row's words as one.

    Rows without words have none.
    """
    row = rows_of(bounds)
    n = np.diff(bounds)
    out, owner = [], []
    if len(hashes) >= size:
        last = len(hashes) - size + 1
        value = hashes[:last].copy()
        for i in range(1, size):
            value = combine(value, hashes[i : last + i])
        whole = row[:last] == row[size - 1 :]
        out.append(value[whole])
        owner.append(row[:last][whole])
    for i in np.flatnonzero((n > 0) & (n < size)):
        value = hashes[bounds[i] : bounds[i] + 1].copy()
        for j in range(bounds[i] + 1, bounds[i + 1]):
            value = combine(value, hashes[j : j + 1])
        out.append(mix(value + np.uint64(n[i])))
        owner.append(np.array([i]))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    value, owner = np.concatenate(out), np.concatenate(owner)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(bounds)))


def count(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, with their number (or the sum of their weights)."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    if weights is None:
        values = np.sort(values)
        first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
        return values[first], np.diff(np.append(first, len(values)))
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.add.reduceat(weights.astype(np.int64), first)


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each row's items (0 where a row has none), each row summed on its own."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    if len(filled):
        out[filled] = np.add.reduceat(values, bounds[filled])
    return out


def blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()
