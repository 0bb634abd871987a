"""Near duplicates: consistent weighted samples of TF-IDF word shingles, banded, verified by weighted Jaccard similarity.

Texts are sets of weighted runs of five words (lower-cased; a shorter text is one run). A run weighs
``tf * (1 + IDF_SHARE * ln(N / df) / ln(N))`` with df counted over all documents in ``2 ** DF_BITS`` hashed cells, less the
mean of a cell, so that a crowded table still tells common runs from rare ones; the damping keeps the weighted similarity
of two edited copies close to the plain one however large their group is.
``BANDS * ROWS`` improved consistent weighted samples (Ioffe 2010) are drawn of each text; texts that agree in a whole band
share a bucket, and those of one bucket whose weighted Jaccard similarity is ``threshold`` or more are linked. Classes are
connected components of links; exact copies share a text key from the start and are never paired.

Links are found in two rounds. First each text is compared with one leader, the text of its buckets whose own buckets hold
most texts: the centre of a star of copies gathers all of them. Then every bucket that still holds several classes is
compared exactly, as matrix products of blocks of about ``PART`` by ``PART`` texts and ``PART_BYTES`` a side at most: those outside the bucket's
largest class with all others, so the work grows with the texts that the first round left open. No two texts of one bucket
stay in different classes without a comparison.

Nulls: a null text counts as empty; texts without words are duplicates only of equal texts. A row of null doc_id takes
part; class_id is the least doc_id of the class, null if it has none. Repeated rows are copies. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm import _text
from funnelspark.llm._spark import broadcast_if, cut, discard, small_batches

K, THRESHOLD = 5, 0.8
BANDS, ROWS = 12, 4
DF_BITS, IDF_SHARE = 18, 0.5
#: Tasks that the members of one bucket are dealt to; texts that meet one copy of a leader; steps before chains are shortened.
SALTS, LED, PLAIN_STEPS = 8, 2048, 4
#: Texts and bytes of vectors on one side of a block of comparisons, and tokens at once.
PART, PART_BYTES, WIDTH = 512, 8 << 20, 4096
#: Ids that may be broadcast, 16 bytes each; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Copies from which a text's name is sent to its rows instead of both meeting in one task.
HEAVY = 10_000
#: Rows of labels or of open buckets that may be broadcast, 40 bytes each.
BROADCAST_LABELS = 200_000
_STEP, _CELLS, _LEVELS = 0.05, 1 << 16, 10
U = np.uint64


def _runs(data: np.ndarray, offsets: np.ndarray, lut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of each text: hash of 40 bits, tf, and the number of them by text and of words by text."""
    h, counts = _text.words(data, offsets, lut)
    s, n_runs = _text.shingles(h, counts, K)
    key = (np.repeat(np.arange(len(n_runs), dtype=U), n_runs) << U(40)) | (s >> U(24))
    key.sort()
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(key)))
    key = key[at]
    return key & U((1 << 40) - 1), tf, np.diff(np.searchsorted(key >> U(40), np.arange(len(n_runs) + 1, dtype=U))), counts


def _cell(run: np.ndarray) -> np.ndarray:
    return (run & U((1 << DF_BITS) - 1)).astype(np.int64)


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n, lut = np.zeros(1 << DF_BITS, dtype=np.int64), 0, _text.word_table()
    for batch in batches:
        for first, end, data, offsets in _text.slices(batch.column(0)):
            df += np.bincount(_cell(_runs(data, offsets, lut)[0]), minlength=len(df))
            n += end - first
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(df[at], n), pa.int64())], ["cell", "n"])


def idf_weights(docs: DataFrame) -> np.ndarray:
    """Weight of each hashed cell, from counts over all documents; a table of 2 ** DF_BITS numbers whatever the input."""
    rows = docs.select("text").mapInArrow(_document_frequency, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = rows.toPandas()
    cells = got[got.cell >= 0]
    n = max(2, int(got[got.cell < 0].n.sum()))
    df = np.ones(1 << DF_BITS)
    df[cells.cell.to_numpy()] = np.clip(cells.n.to_numpy() - cells.n.sum() / len(df), 1, n)
    return (1 + IDF_SHARE * np.log(n / df) / math.log(n)).astype(np.float32)


@lru_cache(maxsize=1)
def _samples() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1) variables r, logarithms of such c, uniform beta, by cell; multipliers by sample; values by weight level and cell."""
    rng = np.random.default_rng(20100)
    r = rng.gamma(2.0, 1.0, _CELLS).astype(np.float32)
    c = np.log(rng.gamma(2.0, 1.0, _CELLS)).astype(np.float32)
    beta = rng.random(_CELLS, dtype=np.float32)
    odd = rng.integers(1, 1 << 63, BANDS * ROWS, dtype=U) * U(2) + U(1)
    return r, c, beta, odd, np.stack([_value(level, r, c, beta) for level in range(_LEVELS)])


def _value(level: np.ndarray | int, r: np.ndarray, c: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """ln a of improved consistent weighted sampling; equal values stand for the same run and the same step t."""
    t = np.floor(np.float32(_STEP) * np.asarray(level, dtype=np.float32) / r + beta)
    return (c - r * (t - beta + np.float32(1))).astype(np.float32)


def _sketch(weights) -> callable:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, lut = weights.value, _text.word_table()
        r, c, beta, odd, values = _samples()
        flat = values.ravel()
        for batch in batches:
            for first, end, data, offsets in _text.slices(batch.column(1)):
                run, tf, n_runs, _ = _runs(data, offsets, lut)
                raw = data.tobytes()
                keys = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                level = np.rint(np.log(tf * w[_cell(run)]) / _STEP).astype(np.int64)
                high = np.flatnonzero(level >= _LEVELS)
                base = np.where(level < _LEVELS, level, 0) * _CELLS
                full = np.flatnonzero(n_runs)
                starts = (np.cumsum(n_runs) - n_runs)[full]
                spread = _text.mix(run)
                sketches = np.zeros((len(full), BANDS * ROWS), dtype=np.uint32)
                for k in range(BANDS * ROWS if len(full) else 0):
                    at = ((spread * odd[k]) >> U(48)).astype(np.int64)
                    a = flat[base + at]
                    if len(high):
                        j = at[high]
                        a[high] = _value(level[high], r[j], c[j], beta[j])
                    sketches[:, k] = np.minimum.reduceat(a, starts).view(np.uint32)
                bands = np.zeros((len(full), BANDS), dtype=U)
                for k in range(BANDS * ROWS):
                    b = k // ROWS
                    bands[:, b] = _text.mix(bands[:, b] * U(31) + sketches[:, k].astype(U) + U(b + 1))
                lengths = np.zeros(end - first, dtype=np.int64)
                lengths[full] = BANDS
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(bands.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(keys, pa.binary()), lists], ["doc_id", "key", "bands"])

    return sketch


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a text as 5-byte numbers in order, each as often as it occurs."""
    lut = _text.word_table()
    for batch in batches:
        for _, _, data, offsets in _text.slices(batch.column(1)):
            run, tf, n_runs, _ = _runs(data, offsets, lut)
            raw = data.tobytes()
            keys = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            owner = np.repeat(np.arange(len(n_runs)), n_runs)
            size = np.bincount(owner, weights=tf, minlength=len(n_runs)).astype(np.int64)
            packed = np.repeat(run, tf).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
            at = np.append(0, np.cumsum(size)) * 5
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([packed[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], ["key", "vector"])


def _unpacked(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def similarity(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted multisets of runs."""
    both = np.concatenate((a, b))
    side = np.concatenate((np.ones(len(a)), np.zeros(len(b))))
    order = np.argsort(both, kind="stable")
    both, side = both[order], side[order]
    at = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.zeros(0, dtype=int)
    if not len(at):
        return 0.0
    n = np.diff(np.append(at, len(both)))
    in_a = np.add.reduceat(side, at)
    in_b, weight = n - in_a, w[_cell(both[at])].astype(np.float64)
    return float((np.minimum(in_a, in_b) * weight).sum() / (np.maximum(in_a, in_b) * weight).sum())


def _verify(weights, threshold: float) -> callable:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            a, b, va, vb = (batch.column(i) for i in range(4))
            kept, last, left = [], None, None
            for i in range(batch.num_rows):
                x, y = va[i].as_py(), vb[i].as_py()
                if max(len(x), len(y)) * threshold * (1 / (1 + IDF_SHARE)) > min(len(x), len(y)):
                    continue
                if x != last:
                    last, left = x, _unpacked(x)
                if similarity(left, _unpacked(y), w) >= threshold:
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([a.take(pa.array(kept, pa.int64())), b.take(pa.array(kept, pa.int64()))], ["a", "b"])

    return verify


def _tokens(run: np.ndarray) -> np.ndarray:
    """Runs in order with the number of each among its equals, as one number: a multiset as a set."""
    at = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if len(run) else np.zeros(0, dtype=np.int64)
    nth = np.arange(len(run)) - np.repeat(at, np.diff(np.append(at, len(run))))
    return run | (nth.astype(U) << U(40))


def block_links(left: list[np.ndarray], right: list[np.ndarray], w: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each of the left sets of tokens has weighted Jaccard similarity threshold with each of the right ones."""
    sets = left + right
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    weight = w[_cell(tokens)].astype(np.float64)
    whole = np.bincount(owner, weights=weight[column], minlength=len(sets))
    shared = np.flatnonzero(np.bincount(column) > 1)
    place = np.full(len(tokens), -1)
    place[shared] = np.arange(len(shared))
    at = place[column]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    both = np.zeros((len(left), len(right)), dtype=np.float64)
    for first in range(0, len(shared), WIDTH):
        a, b = np.searchsorted(at, [first, first + WIDTH])
        x = np.zeros((len(sets), min(WIDTH, len(shared) - first)))
        x[owner[a:b], at[a:b] - first] = 1
        both += (x[: len(left)] * weight[shared[first : first + WIDTH]]) @ x[len(left) :].T
    union = whole[: len(left), None] + whole[None, len(left) :] - both
    return both >= threshold * union


def _compare(weights, threshold: float) -> callable:
    """Links of a block of texts of one bucket, as far as they join classes: the left ones with the right, or all with all."""

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        keys, label, left = (rows[c].to_pylist() for c in ("key", "label", "left"))
        a = [i for i, x in enumerate(left) if x is not False]  # null: on both sides
        b = [i for i, x in enumerate(left) if x is not True]
        above: dict[bytes, bytes] = {}

        def top(x: bytes) -> bytes:
            while x in above:
                x = above[x]
            return x

        out = []
        if a and b and len(set(label)) > 1:
            tokens = [_tokens(_unpacked(v)) for v in rows["vector"].to_pylist()]
            for x, y in zip(*np.nonzero(block_links([tokens[i] for i in a], [tokens[i] for i in b], weights.value, threshold)), strict=True):
                p, q = top(label[a[x]]), top(label[b[y]])
                if p != q:
                    above[max(p, q)] = min(p, q)
                    out.append((keys[a[x]], keys[b[y]]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    return compare


def components(edges: DataFrame) -> DataFrame:
    """(key, label): the least key reachable over links (a, b), by least labels of neighbours; from PLAIN_STEPS on also of labels."""
    both = cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("key"), F.least("a", "m").alias("label")), "labels")
    for step in itertools.count(1):
        known = broadcast_if(labels, BROADCAST_LABELS)
        near = both.join(known, both.b == known.key).select(F.col("a").alias("key"), "label", F.lit(None).cast("binary").alias("old"))
        new = near.unionByName(labels.withColumn("old", F.col("label"))).groupBy("key").agg(F.min("label").alias("label"), F.min("old").alias("old"))
        if step > PLAIN_STEPS:  # chains: the label's own label
            up = known.select(F.col("key").alias("up"), F.col("label").alias("above"))
            new = new.join(up, new.label == up.up).select("key", F.least("label", "above").alias("label"), "old")
        new = cut(new, "labels")
        labels = new.select("key", "label")
        if not new.filter("old <> label").limit(1).count():
            return labels


def joined_classes(labels: DataFrame, found: DataFrame) -> DataFrame:
    """labels with the classes that new links (a, b) join; texts without a label are classes of their own."""
    known = broadcast_if(labels, BROADCAST_LABELS)
    la, lb = (known.select(F.col("key").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b"))
    at = lambda c: F.coalesce(f"l{c}", c).alias(c)
    over = components(found.join(la, "a", "left").join(lb, "b", "left").select(at("a"), at("b"))).select(F.col("key").alias("label"), F.col("label").alias("new"))
    over = broadcast_if(over, BROADCAST_LABELS)
    old = labels.join(over, "label", "left").select("key", F.coalesce("new", "label").alias("label"))
    alone = over.join(labels.select(F.col("key").alias("label")), "label", "left_anti").select(F.col("label").alias("key"), F.col("new").alias("label"))
    return cut(old.unionByName(alone), "labels")


def led(members: DataFrame) -> DataFrame:
    """(a, b, salt): each text b of members(bucket, key, n) with the leader a of its buckets, dealt to salts by the leader's reach."""
    reach = members.groupBy("key").agg(F.sum("n").alias("reach"))
    ranked = members.select("bucket", "key").join(reach, "key")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("reach", "key")).alias("l"))
    best = ranked.join(leaders, "bucket").groupBy("key").agg(F.max("l").alias("l")).filter("key <> l.key")
    return best.select(F.col("l.key").alias("a"), F.col("key").alias("b"), F.pmod(F.xxhash64("key"), 1 + F.floor(F.col("l.reach") / LED)).cast("int").alias("salt"))


def verified(pairs: DataFrame, vectors: DataFrame, weights, threshold: float) -> DataFrame:
    """The pairs (a, b) of pairs(a, b, salt) that are alike; a leader's vector is sent once to each of its salts."""
    side = lambda c: vectors.select(F.col("key").alias(c), F.col("vector").alias(f"vector_{c}"))
    sent = pairs.select("a", "salt").distinct().join(side("a"), "a")
    joined = pairs.join(side("b"), "b").join(sent, ["a", "salt"]).select("a", "b", "vector_a", "vector_b")
    return joined.mapInArrow(_verify(weights, threshold), "a binary, b binary")


def blocks(members: DataFrame, labels: DataFrame, vectors: DataFrame) -> DataFrame:
    """(bucket, kind, i, j, key, label, left, vector): the comparisons that buckets of several classes still need."""
    known = broadcast_if(labels, BROADCAST_LABELS)
    weighed = vectors.select("key", F.octet_length("vector").cast("long").alias("bytes"))
    classed = cut(members.select("bucket", "key").join(known, "key", "left").join(weighed, "key").withColumn("label", F.coalesce("label", "key")), "classed")
    sizes = classed.groupBy("bucket", "label").agg(F.count("*").alias("c"), F.sum("bytes").alias("w")).groupBy("bucket")
    sizes = sizes.agg(F.sum("c").alias("m"), F.sum("w").alias("m_bytes"), F.max(F.struct("c", "label", "w")).alias("most"), F.count("*").alias("k")).filter("k > 1")
    rest, rest_bytes = F.col("m") - F.col("most.c"), F.col("m_bytes") - F.col("most.w")
    several = sizes.select("bucket", "m", "m_bytes", "k", F.col("most.label").alias("main"), rest.alias("rest"), rest_bytes.alias("rest_bytes"), F.col("most.c").alias("held"), F.col("most.w").alias("held_bytes"))
    rows = classed.drop("bytes").join(broadcast_if(cut(several, "open"), BROADCAST_LABELS), "bucket").join(vectors, "key")
    parts = lambda n: F.ceil(F.greatest(F.col(n) / PART, F.col(f"{n}_bytes") / PART_BYTES))
    each = lambda n: F.sequence(F.lit(0).cast("long"), parts(n) - 1)
    main = F.col("label") == F.col("main")
    own = F.pmod(F.xxhash64("key"), F.when(main, parts("held")).otherwise(parts("rest")))
    block = lambda kind, i, j, left: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), left.alias("left"))
    zero, both = F.lit(0).cast("long"), F.lit(None).cast("boolean")
    whole = F.array(block(0, zero, zero, both))
    of_main = F.transform(each("rest"), lambda i: block(1, i, F.col("own"), F.lit(False)))
    of_rest = F.transform(each("held"), lambda j: block(1, F.col("own"), j, F.lit(True)))
    among = F.transform(each("rest"), lambda j: block(2, F.least("own", j), F.greatest("own", j), F.when(F.col("own") != j, F.col("own") < j)))
    rows = rows.withColumn("own", own).withColumn("of_rest", F.when(F.col("k") > 2, F.concat(of_rest, among)).otherwise(of_rest))
    rows = rows.withColumn("block", F.explode(F.when((F.col("m") <= PART) & (F.col("m_bytes") <= PART_BYTES), whole).when(main, of_main).otherwise(F.col("of_rest"))))
    return rows.select("bucket", "block.*", "key", "label", "vector")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_copies): a row for each row of docs(doc_id, text); n_copies counts the rows of the same text."""
    sc = docs.sparkSession.sparkContext
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    weights = sc.broadcast(idf_weights(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = cut(docs.mapInArrow(_sketch(weights), f"doc_id {kind}, key binary, bands array<long>"), "sketches")
    texts = cut(rows.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "bands")).alias("s"), F.count("*").alias("n_copies")).select("key", "s.doc_id", "s.bands", "n_copies"), "texts")
    buckets = texts.select("key", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = buckets.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    members = cut(salted.join(shared.select("bucket", "n", salts), ["bucket", "salt"]).select("bucket", "key", "n"), "members")
    involved = members.select("key").distinct().join(texts.select("key", "doc_id"), "key")
    involved = broadcast_if(cut(involved.select(F.col("doc_id").alias("id")), "involved"), BROADCAST_IDS)
    vectors = cut(docs.join(involved, docs.doc_id.eqNullSafe(involved.id), "left_semi").mapInArrow(_vectors, "key binary, vector binary").dropDuplicates(["key"]), "vectors")

    labels = components(cut(verified(led(members), vectors, weights, threshold), "verified"))
    compared = blocks(members, labels, vectors).groupBy("bucket", "kind", "i", "j").applyInArrow(_compare(weights, threshold), "a binary, b binary")
    found = cut(compared.distinct(), "verified")
    if found.limit(1).count():
        labels = joined_classes(labels, found)
    classes = texts.join(labels, "key", "left").select("key", "doc_id", "n_copies", F.coalesce("label", "key").alias("label"))
    least = classes.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    named = cut(classes.join(least, "label").select("key", "class_id", "n_copies"), "named")
    weights.unpersist()
    discard(texts, members, vectors, found)
    heavy = broadcast_if(named.filter(F.col("n_copies") > HEAVY), BROADCAST_LABELS)
    rows = rows.select("doc_id", "key")
    out = rows.join(heavy, "key").unionByName(rows.join(heavy.select("key"), "key", "left_anti").join(named, "key"))
    return out.select("doc_id", "class_id", "n_copies")
