"""Quality selection by importance resampling (Xie et al. 2023): hashed n-gram models of target and raw text, Gumbel top-k.

Both are generative models of the bytes of a text, each given the ``ORDER - 1`` before it, with n-grams and contexts
hashed to ``2 ** BITS`` cells: the raw model counts all documents, the target model those of the target set, smoothed
towards the raw one. A document's log importance is the sum of its log ratios, the logarithm of target over raw likelihood.
A Gumbel variable drawn by a hash of doc_id, text and seed is added, and the ``k`` greatest keys are a sample without
replacement by importance. k is the target's share of the labelled rows, times the number of documents.

The k-th key is found exactly by four counts over 16 bits of the keys each, so nothing is sorted or gathered. Keys tie only
for rows alike in doc_id and text; those that tie with the k-th are all selected. Nulls: a null text counts as empty and
weighs 0; a null doc_id is drawn for by its text. Where nothing is labelled all are selected; an empty table gives an empty
one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm import _text
from funnelspark.llm._spark import broadcast_if, cut, small_batches

ORDER, BITS, SEED = 5, 17, 17
#: Pseudo-counts of a context.
SMOOTHING = 8.0
BROADCAST_IDS = 1_000_000
SLICE = 1 << 18
U = np.uint64


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The n-gram, 8 bits a token, that ends at each byte of the texts; null bytes stand before the first."""
    n, lengths = len(data), np.diff(offsets)
    place = np.arange(n) - np.repeat(offsets[:-1], lengths)
    out = data.astype(np.int64)
    for back in range(1, ORDER):
        earlier = np.zeros(n, dtype=np.int64)
        earlier[back:] = data[:-back] if back < n else 0
        out |= np.where(place >= back, earlier, 0) << (8 * back)
    return out


def cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte, the cells of its n-gram and of its context."""
    gram = grams(data, offsets)
    hashed = lambda x: (_text.mix(x.astype(U)) >> U(64 - BITS)).astype(np.int64)
    return hashed(gram), hashed(gram >> 8)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 1 << BITS
    raw, target = np.zeros((2, size), dtype=np.int64), np.zeros((2, size), dtype=np.int64)
    for batch in batches:
        wanted = batch.column(1).to_numpy(zero_copy_only=False)
        for first, end, data, offsets in _text.slices(batch.column(0), SLICE):
            chosen = np.repeat(wanted[first:end], np.diff(offsets))
            for i, x in enumerate(cells(data, offsets)):
                raw[i] += np.bincount(x, minlength=size)
                target[i] += np.bincount(x[chosen], minlength=size)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw.ravel()[at]), pa.array(target.ravel()[at])], ["cell", "n", "n_target"])


def counts(docs: DataFrame) -> np.ndarray:
    """Counts of n-grams and of contexts by cell, raw and of the target, of docs(text, wanted): 2 ** (BITS + 2) numbers whatever the input."""
    rows = docs.select("text", "wanted").mapInArrow(_count, "cell long, n long, n_target long").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("n_target").alias("t")).toPandas()
    out = np.zeros((2, 2 << BITS), dtype=np.float64)
    out[0, rows.cell.to_numpy()], out[1, rows.cell.to_numpy()] = rows.n.to_numpy(), rows.t.to_numpy()
    return out.reshape(2, 2, 1 << BITS)


def _weigh(sent) -> callable:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (raw, raw_all), (target, target_all) = sent.value
        for batch in batches:
            drawn = batch.column(2).to_numpy().astype(U)
            uniform = ((_text.mix(drawn) >> U(11)).astype(np.float64) + 0.5) / (1 << 53)
            noise = -np.log(-np.log(uniform))
            for first, end, data, offsets in _text.slices(batch.column(1), SLICE):
                gram, context = cells(data, offsets)
                p = np.minimum(1, (raw[gram] + 1 / 256) / (raw_all[context] + 1))
                q = np.minimum(1, (target[gram] + SMOOTHING * p) / (target_all[context] + SMOOTHING))
                weight = np.bincount(np.repeat(np.arange(end - first), np.diff(offsets)), weights=np.log(q / p), minlength=end - first)
                bits = (weight + noise[first:end]).view(np.int64)
                key = np.where(bits >= 0, bits, bits ^ np.int64(0x7FFFFFFFFFFFFFFF))  # in the order of the numbers
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(weight), pa.array(key)], ["doc_id", "log_importance", "key"])

    return weigh


def kth_greatest(rows: DataFrame, k: int) -> int:
    """The k-th greatest ``key`` (long) of rows, 16 bits at a time: each step counts at most 65,536 groups."""
    prefix, left = None, k
    for shift in (48, 32, 16, 0):
        part = F.shiftright("key", shift)
        inside = rows if prefix is None else rows.filter(F.shiftright("key", shift + 16) == prefix)
        for value, n in sorted(((r.part, r.n) for r in inside.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()), reverse=True):
            if n >= left:
                prefix = value
                break
            left -= n
    return prefix


def select(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, log_importance, selected of each row of docs(doc_id, text); labels(doc_id, quality, toxic): target is quality 1, toxic 0."""
    small_batches(docs.sparkSession)
    good = (F.coalesce(F.col("quality"), F.lit(0)) == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    by_id = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min(good).alias("wanted"))
    share = by_id.agg(F.avg(F.col("wanted").cast("int")).alias("share")).first().share
    ids = broadcast_if(by_id.filter("wanted"), BROADCAST_IDS)
    model = counts(docs.select("doc_id", "text").join(ids, "doc_id", "left").select("text", F.coalesce("wanted", F.lit(False)).alias("wanted")))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 1)
    rows = docs.select("doc_id", "text", draw.alias("draw")).mapInArrow(_weigh(sent), f"doc_id {kind}, log_importance double, key long")
    rows = cut(rows, "weights")
    sent.unpersist()
    k = round((1.0 if share is None else share) * rows.count())
    chosen = F.col("key") >= kth_greatest(rows, k) if k else F.lit(False)
    return rows.select("doc_id", "log_importance", chosen.alias("selected"))
