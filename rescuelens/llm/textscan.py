"""Whole texts of Arrow batches as byte arrays: words, hashes and shingles in numpy.

Texts are read as UTF-8 bytes. Work is done in slices of about a megabyte, so memory is
bounded by the slice and by the longest single text, never by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_LOWER = np.frombuffer(ASCII_LOWER, np.uint8)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (a bijection)."""
    values = (values ^ (values >> _SHIFT)) * _MIX_1
    values = (values ^ (values >> _SHIFT)) * _MIX_2
    return values ^ (values >> _SHIFT)


def seeded(count: int, seed: int) -> np.ndarray:
    """``count`` odd 64-bit multipliers."""
    start = np.uint64(seed * 0x632BE59BD9B4E019 % (1 << 64))
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(_BASE) + start) | np.uint64(1)


class _Powers:
    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            for name, factor in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(max(size, SLICE), factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:size], self.down[:size]


_powers = _Powers()


def raw_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size
            else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes, or of one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def segments(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of one long text, cut at blanks."""
    start = 0
    while start < len(data):
        stop = min(start + SLICE, len(data))
        while stop < len(data) and not _BLANK[data[stop]]:
            stop += 1
        yield start, stop
        start = stop


def words_of(data: np.ndarray, starts: np.ndarray, lower: bool = True
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of anything but blanks) of consecutive texts.

    ``starts`` holds where each text begins in ``data``. Returns per word: hash of its bytes
    (with A-Z lowered, if so wished), number of its text, first byte, byte after the last.
    """
    if len(data) > SLICE and len(starts) == 1:
        parts = [_words_within(data[a:b], np.zeros(1, np.int64), lower) + (a,) for a, b in segments(data)]
        return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
                np.concatenate([p[2] + p[4] for p in parts]),
                np.concatenate([p[3] + p[4] for p in parts]))
    return _words_within(data, starts, lower)


def _words_within(data: np.ndarray, starts: np.ndarray, lower: bool
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    solid = np.zeros(len(data) + 2, bool)
    np.logical_not(_BLANK[data], out=solid[1:-1])
    at_start, after_end = solid[1:] & ~solid[:-1], solid[:-1] & ~solid[1:]
    inner = starts[(starts > 0) & (starts < len(data))]
    touching = inner[solid[inner] & solid[inner + 1]]
    at_start[touching] = after_end[touching] = True
    first, last = np.flatnonzero(at_start), np.flatnonzero(after_end)
    up, down = _powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(((_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)) * up[:-1],
              out=total[1:])
    hashes = mix((total[last] - total[first]) * down[first])
    row = np.searchsorted(starts, first, "right") - 1
    return hashes, row, first, last


def windows_of(hashes: np.ndarray, row: np.ndarray, size: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every run of ``size`` words; a text of fewer words is one run."""
    if not len(hashes):
        return hashes, row
    factors = seeded(size, 7)
    counts = np.bincount(row, minlength=rows)
    out, of = np.zeros(0, np.uint64), np.zeros(0, row.dtype)
    if len(hashes) >= size:
        inside = np.flatnonzero(row[size - 1:] == row[:len(row) - size + 1])
        out = hashes[inside] * factors[0]
        for k in range(1, size):
            out = out + hashes[inside + k] * factors[k]
        out, of = mix(out), row[inside]
    ends = np.cumsum(counts)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        single = np.array([mix(np.array([(hashes[ends[r] - counts[r]:ends[r]]
                                          * factors[:counts[r]]).sum(dtype=np.uint64)
                                         + np.uint64(counts[r])]))[0] for r in short], np.uint64)
        out, of = np.concatenate([out, single]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        out, of = out[order], of[order]
    return out, of


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the ``size``-word shingles of each text, in row order."""
    data, offsets = raw_texts(column)
    for a, b in slices(offsets):
        part = data[offsets[a]:offsets[b]]
        hashes, row, _, _ = words_of(part, offsets[a:b] - offsets[a])
        found, of = windows_of(hashes, row, size, b - a)
        cuts = np.searchsorted(of, np.arange(b - a + 1))
        for k in range(b - a):
            yield np.unique(found[cuts[k]:cuts[k + 1]])
