"""Hashes of all words of an Arrow batch of texts, by array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Bytes of text worked on at once, unless one text is longer.
CHUNK = 1 << 21


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, ``n`` of each."""
    size = max(CHUNK, 1 << int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers[size]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def batches_of_words(texts: pa.Array, head: int = 4) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first, last, hashes, heads, rows)`` for runs of rows: the hash of every word and of its first
    ``head`` bytes, and its row minus ``first``.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; null texts have none. A
    word's hash is a polynomial of its bytes modulo 2 ** 64, mixed, wherever in a text it stands.
    """
    arr = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(arr)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + CHUNK, "right")) - 1)
        data = _LOWER[raw[off[first]:off[last]]]
        edges = off[first:last + 1] - off[first]
        # A virtual blank stands before each row, so that words end with their row.
        blank = _SPACE[data]
        starts_row = np.zeros(len(data) + 1, bool)
        starts_row[edges] = True
        before = np.r_[True, blank] | starts_row
        after = np.r_[blank, True] | starts_row
        starts = np.flatnonzero(~blank & before[:-1])
        ends = np.flatnonzero(~blank & after[1:]) + 1
        up, down = _power_tables(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
        cut = np.minimum(ends, starts + head)
        yield (first, last, mixed((total[ends] - total[starts]) * down[starts]), mixed((total[cut] - total[starts]) * down[starts]),
               np.searchsorted(edges, starts, "right") - 1)
        first = last


def pairs(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pairs of neighbouring words of a row, and their rows."""
    same = rows[1:] == rows[:-1]
    return mixed(hashes[:-1] * np.uint64(_BASE) + hashes[1:])[same], rows[1:][same]
