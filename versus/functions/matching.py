"""Clipped n-gram matches of a batch of rows, worked out on arrays inside a task.

The tokens of all sides become codes. A gram of a row is numbered from the number of its beginning
and its last token, so grams are never built as strings; equal numbers are counted on each side.
Memory is bounded by a batch of rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Tokens, or characters, that are matched at a time.
CHUNK = 64_000

def _numbers(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal keys as equal small numbers, and how many there are."""
    coded = pa.array(keys).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)


def token_codes(sides: list[pa.Array]) -> tuple[np.ndarray, list[np.ndarray]]:
    """One code per token of all sides, and the lengths of each side's rows."""
    values = pa.concat_arrays([s.flatten().cast("large_string") for s in sides])
    codes = values.dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
    sizes = [pc.fill_null(pc.list_value_length(s), 0).to_numpy().astype(np.int64) for s in sides]
    return codes, sizes


def character_codes(sides: list[pa.Array]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The code points of all texts, and the lengths of each side's rows."""
    texts = [pc.fill_null(s.cast("large_string"), "") for s in sides]
    whole = "".join(t for text in texts for t in text.to_pylist())
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    return points.astype(np.int64), [pc.utf8_length(t).to_numpy().astype(np.int64) for t in texts]


def clipped_matches(codes: np.ndarray, sizes: list[np.ndarray], max_n: int) -> list[np.ndarray]:
    """For every side but the last, the sizes (rows x orders) of its n-grams' multiset intersection
    with those of the last side. ``codes`` holds the sides one after the other."""
    rows, lengths = len(sizes[0]), np.concatenate(sizes)
    out = [np.zeros((rows, max_n), np.int64) for _ in sizes[:-1]]
    if not len(codes):
        return out
    rest = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    row = np.repeat(np.tile(np.arange(rows), len(sizes)), lengths)
    side = np.repeat(np.arange(len(sizes)), [s.sum() for s in sizes])
    base = int(codes.max()) + 1
    first, total = row * base + codes, rows * base
    digits = total * base ** (max_n - 1) * len(sizes) < 2**63
    if not digits:
        first, total = _numbers(first)
        base = total
    at, grams = np.arange(len(codes)), first
    for n in range(1, max_n + 1):
        if n > 1:
            longer = rest[at] >= n
            at, grams = at[longer], grams[longer]
            if not len(at):
                break
            # a row's grams as numbers of n digits, or numbered anew where those are too long
            grams = grams * base + (codes if digits else first)[at + n - 1]
            if not digits:
                grams, total = _numbers(grams)
        if digits:
            _count_sorted(grams, side[at], base**n, n, out)
        else:
            _count_numbered(grams, total, row[at], np.searchsorted(side[at], range(len(sizes) + 1)), n, out)
    return out


def _count_numbered(
    grams: np.ndarray, total: int, row: np.ndarray, cuts: np.ndarray, n: int, out: list[np.ndarray]
) -> None:
    """Set order ``n`` in ``out`` from grams below ``total``, which differ between rows; ``cuts``
    are the ends of the sides."""
    counts = [np.bincount(grams[a:b], minlength=total) for a, b in zip(cuts, cuts[1:])]
    row_of = np.empty(total, np.int64)
    row_of[grams] = row
    for matches, count in zip(out, counts):
        clipped = np.minimum(count, counts[-1])
        matches[:, n - 1] = np.bincount(row_of, clipped, len(matches)).astype(np.int64)


def _count_sorted(grams: np.ndarray, side: np.ndarray, span: int, n: int, out: list[np.ndarray]) -> None:
    """The same from grams that are ``span`` times their row and more."""
    last, rows = len(out), len(out[0])
    keys = np.sort(grams * (last + 1) + side)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count, keys = np.diff(np.append(starts, len(keys))), keys[starts]
    gram = keys // (last + 1)
    side = keys - gram * (last + 1)
    row = gram // span
    for ahead in range(1, last + 1):  # how far behind a side's gram the reference's may stand
        both = np.flatnonzero((gram[ahead:] == gram[:-ahead]) & (side[ahead:] == last))
        clipped = np.minimum(count[both], count[both + ahead])
        where = np.bincount(side[both] * rows + row[both], clipped, last * rows).astype(np.int64)
        for s, matches in enumerate(out):
            matches[:, n - 1] += where[s * rows : (s + 1) * rows]


def _spans(sides: list[pa.Array], characters: bool) -> list[tuple[int, int]]:
    """Runs of rows (start, length) with up to ``CHUNK`` tokens on all sides, or of one row."""
    measure = pc.utf8_length if characters else pc.list_value_length
    sizes = sum(pc.fill_null(measure(s), 0).to_numpy().astype(np.int64) for s in sides)
    ends, starts = np.cumsum(sizes), [0]
    while starts[-1] < len(sizes):
        done = ends[starts[-1] - 1] if starts[-1] else 0
        starts.append(max(starts[-1] + 1, int(np.searchsorted(ends, done + CHUNK, "right"))))
    return [(a, b - a) for a, b in zip(starts, starts[1:])]


def _matched(sides: list[pa.Array], max_n: int, limit: int, characters: bool) -> pa.StructArray:
    codes, sizes = (character_codes if characters else token_codes)(sides)
    rows = len(sides[0])
    missing = [s.is_null().to_numpy(zero_copy_only=False) for s in sides]
    largest = np.max(sizes, axis=0)
    if characters and any(m.any() for m in missing):
        largest = np.zeros(rows, np.int64)
        np.maximum.at(largest, np.repeat(np.tile(np.arange(rows), len(sides)), np.concatenate(sizes)), codes)
    found = []
    if characters:  # small numbers
        seen = np.zeros(codes.max(initial=0) + 1, np.int64)
        seen[codes] = 1
        codes = np.cumsum(seen)[codes] - 1
    for side, matches in enumerate(clipped_matches(codes, sizes, max_n)):
        mask = np.zeros(matches.shape, bool)
        mask[:, 0] = (missing[side] | missing[-1]) & (largest <= limit)
        offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * max_n)
        found.append(pa.ListArray.from_arrays(offsets, pa.array(matches.ravel(), mask=mask.ravel())))
    return pa.StructArray.from_arrays(found, [f"m{i}" for i in range(len(found))])


def matcher(max_n: int, limit: int, characters: bool) -> Callable[..., pa.Array]:
    """A function of Arrow arrays, the reference last: a struct with one array of matches per side.

    A missing side has no matches of single tokens (null), and none (0) of longer grams; in rows
    beyond ``limit`` (tokens, or code points) it has none of either.
    """

    def run(*sides: pa.Array) -> pa.Array:
        parts = [
            _matched([s.slice(start, length) for s in sides], max_n, limit, characters)
            for start, length in _spans(list(sides), characters)
        ]
        return pa.concat_arrays(parts) if parts else _matched(list(sides), max_n, limit, characters)

    return run
