"""Vectorised tokenising of Arrow string batches, shared by the operators that run numpy inside tasks.

Texts are handled in slices of whole documents, about ``SLICE`` bytes each, so a task's arrays stay small
whatever the batch holds; a document longer than that is a slice of its own. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SLICE = 1 << 18
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_COMB = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=U)


def word_table() -> np.ndarray:
    """Bytes of the words: ASCII letters (lower-cased) and digits and every byte of a non-ASCII character; 0 separates."""
    t = np.arange(256, dtype=np.uint8)
    keep = np.zeros(256, dtype=bool)
    keep[0x30:0x3A] = keep[0x41:0x5B] = keep[0x61:0x7B] = keep[0x80:] = True
    t[0x41:0x5B] += 0x20
    t[~keep] = 0
    return t


def space_table() -> np.ndarray:
    """Bytes of white-space separated tokens, case kept; 0 separates."""
    t = np.arange(256, dtype=np.uint8)
    t[:0x21] = 0
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, dtype=U)
    down = np.full(n, pow(_BASE, -1, 1 << 64), dtype=U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 16, 1 << (n - 1).bit_length())
    up, down = _powers(size) if size <= 2 * SLICE else _powers.__wrapped__(size)
    return up, down


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word in order, and the number of words of each text."""
    n_docs, n = len(offsets) - 1, len(data)
    if not n:
        return np.zeros(0, dtype=U), np.zeros(n_docs, dtype=np.int64)
    mapped = table[data]
    inside = mapped != 0
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = powers(n)
    total = np.empty(n + 1, dtype=U)
    total[0] = 0
    np.cumsum(mapped.astype(U) * up[:n], out=total[1:])
    h = mix((total[e] - total[s]) * down[s] + (e - s).astype(U))
    bounds = np.searchsorted(s, offsets)
    return h, np.diff(bounds)


def shingles(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of k words, and the number of runs of each text; a text of fewer words, but not none, is one run."""
    n = len(h)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    acc = h * _COMB[0]
    for j in range(1, k):
        if j < n:
            acc[:-j] += h[j:] * _COMB[j % len(_COMB)] * U(2 * (j // len(_COMB)) + 1)
    n_runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        own = h[first[d] : first[d] + counts[d]]
        acc[first[d]] = (own * _COMB[np.arange(len(own)) % len(_COMB)]).sum(dtype=U) ^ U(len(own))
    at = np.repeat(first, n_runs) + np.arange(n_runs.sum()) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs)
    return mix(acc[at]), n_runs
