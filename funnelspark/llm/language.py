"""Language identification by string kernels: presence of blended-spectrum n-grams, Nystrom landmarks, kernel ridge regression.

Two texts' kernel is the share of n-grams of 1 to ``N`` bytes (of the lower-cased UTF-8, hashed to ``2 ** BITS`` cells)
present in both: ``|A and B| / sqrt(|A| |B|)``. The model is fitted on a sample of labelled rows that is bounded in bytes:
about ``PER_LANG`` of every language by a hash of doc_id, of texts of at most ``TEXT_BYTES``, as far as they fit in the
language's part of ``SAMPLE_BYTES`` (short ones first where they don't; one text of each language at least), with up to
``LANDMARKS`` texts of each, ``ALL_LANDMARKS`` in all, as landmarks; one ridge regression a language against the rest.
Landmarks are sent to tasks as bits. A batch of whole texts is scored by two matrix products.

A text that is null or has no letter gets ``und`` and score 0, as all do where nothing is labelled. The score is the
regression's value, within 0 and 1. Rows repeat as they are; rows of null id aren't learnt from, of an id that repeats one
text is (the least). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.llm import _text
from funnelspark.llm._spark import broadcast_if, cut, small_batches

N, BITS = 3, 14
PER_LANG, LANDMARKS, RIDGE = 300, 32, 1e-3
#: Bytes of one text and of all texts of the sample, and landmarks in all: they bound what the driver fits and sends.
TEXT_BYTES, SAMPLE_BYTES, ALL_LANDMARKS = 1 << 16, 64 << 20, 1024
#: Languages that may be broadcast with their counts.
BROADCAST_LANGS = 100_000
UNKNOWN = "und"
#: Bytes of text and texts whose presence matrix is built at once.
CHUNK, DOCS = 1 << 18, 128


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of 0 and 1 for each text: which cells its n-grams fall in."""
    n_docs = len(offsets) - 1
    out = np.zeros((n_docs, 1 << BITS), dtype=np.float32)
    flat, base = out.ravel(), np.repeat(np.arange(n_docs, dtype=np.int64) << BITS, np.diff(offsets))
    code, left = np.zeros(len(data), dtype=np.uint32), np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    for n in range(1, N + 1):
        if len(data) < n:
            break
        code = (code[: len(data) - n + 1] << np.uint32(8)) | data[n - 1 :]
        cell = ((code + np.uint32(n << 24)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        whole = left[: len(code)] >= n
        flat[(base[: len(code)] + cell)[whole]] = 1
    return out


def batches_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, presence) of runs of lower-cased texts."""
    for first in range(0, len(column), DOCS):
        lower = pc.utf8_lower(column.slice(first, DOCS).cast(pa.large_string()).fill_null(""))
        for a, b, data, offsets in _text.slices(lower, CHUNK):
            yield first + a, first + b, presence(data, offsets)


def kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None] * np.sqrt(np.maximum(landmarks.sum(axis=1), 1))[None, :]
    return x @ landmarks.T / size


def training_rows(docs: DataFrame, usable: Column, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(lang, doc_id, text) of about PER_LANG usable ids of each language, by a hash of doc_id, within its part of sample_bytes."""
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.octet_length("text") <= TEXT_BYTES))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    part = F.lit(sample_bytes) / F.count("*").over(W.partitionBy())
    counts = counts.select(F.col("lang").alias("of"), "n", part.alias("part"))  # a row a language
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    counts = broadcast_if(cut(counts, "langs"), BROADCAST_LANGS)
    drawn = rows.join(counts, rows.lang == counts.of).withColumn("draw", draw).filter(F.col("draw") * F.col("n") < PER_LANG)
    drawn = drawn.groupBy("lang", "doc_id").agg(F.min("text").alias("text"), F.min("draw").alias("draw"), F.min("part").alias("part"))
    size = F.octet_length("text")
    order = W.partitionBy("lang").orderBy(size > F.col("part"), "draw", "doc_id")  # of about PER_LANG rows
    placed = drawn.withColumns({"sum": F.sum(size).over(order.rowsBetween(W.unboundedPreceding, 0)), "at": F.row_number().over(order)})
    return placed.filter((F.col("sum") <= F.col("part")) | (F.col("at") == 1)).select("lang", "doc_id", "text")


def chosen_landmarks(sample: list[tuple[str, str]]) -> list[str]:
    """Texts of each language, as many of each as ALL_LANDMARKS allows; of more languages than that some have none."""
    of: dict[str, list[str]] = {}
    for lang, text in sample:
        of.setdefault(lang, []).append(text)
    each = max(1, min(LANDMARKS, ALL_LANDMARKS // max(1, len(of))))
    return [t for texts in of.values() for t in texts[:each]][:ALL_LANDMARKS]


def fit(sample: list[tuple[str, str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, landmarks (their cells as bits) and the matrix from kernel values with landmarks to a value a language."""
    langs = sorted({lang for lang, _ in sample})
    if not langs:
        return [], np.zeros((0, (1 << BITS) // 8), dtype=np.uint8), np.zeros((0, 0))
    landmarks = np.concatenate([x for _, _, x in batches_of(pa.array(chosen_landmarks(sample), pa.large_string()))])
    k = np.concatenate([kernel(x, landmarks) for _, _, x in batches_of(pa.array([t for _, t in sample], pa.large_string()))]).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = k @ root
    y = np.array([[float(own == lang) for lang in langs] for own, _ in sample])
    w = np.linalg.solve(phi.T @ phi + RIDGE * len(sample) * np.eye(phi.shape[1]), phi.T @ y)
    return langs, np.packbits(landmarks.astype(np.uint8), axis=1), (root @ w).astype(np.float32)


def _predict(model) -> callable:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, bits, a = model.value
        landmarks = np.unpackbits(bits, axis=1).astype(np.float32)
        for batch in batches:
            texts = batch.column(1)
            known = pc.match_substring_regex(texts.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False) & bool(langs)
            best, score = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
            for first, end, x in batches_of(texts) if langs else ():
                s = kernel(x, landmarks) @ a
                best[first:end], score[first:end] = s.argmax(axis=1), np.clip(s.max(axis=1), 0, 1)
            names = [langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns)), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))], [*batch.schema.names, "lang_pred", "score"])

    return predict


def train(docs: DataFrame, usable: Column) -> tuple:
    rows = training_rows(docs, usable).collect()  # within SAMPLE_BYTES
    sample = sorted((r.lang, r.doc_id, r.text) for r in rows)
    return fit([(lang, text) for lang, _, text in sample])


def predict(rows: DataFrame, model: tuple) -> DataFrame:
    """Adds lang_pred and score to a frame of which ``text`` is the second column."""
    if rows.columns[1] != "text":
        raise ValueError("text must be the second column")
    small_batches(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_predict(sent), f"{fields}, lang_pred string, score double")


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of docs(doc_id, text, lang), learnt from rows that are not held out."""
    model = train(docs, ~held_out())
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), model).drop("text").select("doc_id", "held_out", "lang_pred", "score")
