"""Signatures of token sets that every two sets which overlap by a threshold share, and few others do.

A set is dealt into parts by a hash of its tokens. Two sets that differ in at most k tokens agree on all but k parts, so of each
set's parts, in one order for all sets, the first k + d meet in d at least. A part is several tokens at once, so the rarest
parts of unlike texts hardly ever meet, however many texts there are, where single tokens meet the more often the more there are.

How many parts there are depends on the size: a set has signatures for its own class of sizes, and for the smaller ones that may
overlap it so far. A pair meets in the class of its smaller set. Nothing is left out: how rare tokens are only orders the parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A token is known to be frequent from one in so many sets on; so many are known at most. Tokens that one step lays out.
RARE, KNOWN, STEP = 1024, 200_000, 1 << 18


def _bounds(threshold: float) -> np.ndarray:
    """The least size of each class."""
    out = [1]
    while out[-1] < 1 << 31:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] / threshold - 1e-9))))
    return np.array(out, np.int64)


def _differ(total: np.ndarray, threshold: float) -> np.ndarray:
    """In how many tokens two sets that overlap by the threshold may differ, by the sum of their sizes."""
    return np.floor(total * (1 - threshold) / (1 + threshold) + 1e-9).astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _of_sets(n: np.ndarray, t: np.ndarray, weight: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, signature, own, depth) for sets of n tokens each, laid out in t: for each class that a set takes part in, its own first."""
    low, row = _bounds(threshold), np.repeat(np.arange(len(n)), n)
    own = np.searchsorted(low, n, "right") - 1
    least = np.searchsorted(low, np.ceil(n * threshold - 1e-9).astype(np.int64), "right") - 1
    for below in range(int((own - least).max(initial=-1)) + 1):
        rows = np.flatnonzero((own - below >= least) & (n > 0))
        c, size = own[rows] - below, n[rows]
        top = low[c + 1] - 1
        most = _differ(top + np.floor(top / threshold + 1e-9).astype(np.int64), threshold)
        depth = 1 + most // 16
        parts = most + 1 + np.maximum(np.ceil(0.3 * most).astype(np.int64), 6)
        other = top if below else np.floor(size / threshold + 1e-9).astype(np.int64)
        kept = _differ(size + other, threshold) + depth
        taken = np.zeros(len(n), bool)
        taken[rows] = True
        taken, place = taken[row], np.cumsum(taken) - 1
        at, seed = place[row[taken]], _mixed(c.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        x = _mixed(t[taken] ^ seed[at])
        start = np.cumsum(parts) - parts
        cell = start[at] + (x % parts[at].astype(np.uint64)).astype(np.int64)
        y, total = _mixed(x + np.uint64(0x632BE59BD9B4E019)), int(parts.sum())
        half = lambda z, cell=cell, total=total: np.bincount(cell, z.astype(np.float64), total).astype(np.uint64)
        holder = np.repeat(np.arange(len(rows)), parts)
        number = np.arange(total) - start[holder]
        content = _mixed(half(y & np.uint64(0xFFFFFFFF)) + _mixed(half(y >> np.uint64(32)) + np.uint64(1)))
        code = _mixed(content ^ _mixed(seed[holder] + number.astype(np.uint64)))
        order = np.lexsort((code, -np.bincount(cell, weight[taken], total), holder))
        order = order[np.arange(total) - start[holder] < kept[holder]]  # holders stand in a row as before
        yield rows[holder[order]], code[order].view(np.int64), np.full(len(order), below == 0), depth[holder[order]].astype(np.int16)


def frequent(sets: DataFrame) -> list[tuple[int, int]]:
    """Frequent tokens, each with its weight: 16 times the logarithm of how rare it is."""
    n = sets.count()
    counts = sets.select(F.explode("t").alias("token")).groupBy("token").agg(F.count("*").alias("often")).filter(F.col("often") * RARE >= n).filter("often > 1")
    return [tuple(r) for r in counts.select("token", F.round(F.log2(n / F.col("often")) * 16).cast("int")).limit(KNOWN).collect()]


def signatures(sets: DataFrame, threshold: float, weights: list[tuple[int, int]]) -> DataFrame:
    """id, n, sig, own, depth of sets (id, t: distinct tokens as 64-bit numbers). Of two sets that overlap by the threshold, one is in
    its own class where they meet, and they have ``depth`` signatures in common at least."""
    known = np.array(sorted(weights) or [(0, 16 * 10)], np.int64)  # of none, any one does

    def laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("id"), batch.column("t")
            n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(n)
            low = 0
            while low < len(n):
                begin = ends[low] - n[low]
                high = max(low + 1, int(np.searchsorted(ends, begin + STEP, "right")))
                t = flat[begin : ends[high - 1]]
                at = np.minimum(np.searchsorted(known[:, 0], t), len(known) - 1)
                weight = np.where(known[at, 0] == t, known[at, 1], 16 * 10)
                for row, sig, own, depth in _of_sets(n[low:high], t.view(np.uint64), weight, threshold):
                    columns = [ids.take(pa.array(row + low)), pa.array(n[low:high][row].astype(np.int32)), pa.array(sig), pa.array(own), pa.array(depth)]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "n", "sig", "own", "depth"])
                low = high

    kind = sets.schema["id"].dataType.simpleString()
    return sets.select("id", "t").mapInArrow(laid_out, f"id {kind}, n int, sig long, own boolean, depth short")


#: Numbers of 64 bits in a bitmap.
WORDS = 8


def bitmaps(sets: DataFrame) -> DataFrame:
    """id, w0 to w7: a bit for each of 512 residues, set where an odd number of a set's tokens (64-bit hashes) have it. What two sets
    differ in bounds from above in how many bits their bitmaps do."""

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = 64 * WORDS
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                lists = part.column("t")
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
                place = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64) % np.uint64(bits)
                odd = np.bincount(row * bits + place.astype(np.int64), minlength=len(lists) * bits) & 1
                words = np.packbits(odd.astype(np.uint8).reshape(-1, bits), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(np.ascontiguousarray(words[:, i])) for i in range(WORDS))], ["id", *(f"w{i}" for i in range(WORDS))])

    kind = sets.schema["id"].dataType.simpleString()
    return sets.select("id", "t").mapInArrow(drawn, f"id {kind}, " + ", ".join(f"w{i} long" for i in range(WORDS)))
