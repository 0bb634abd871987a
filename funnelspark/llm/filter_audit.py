"""How filters interact: what each removes in each order, what others would have removed too, and each filter's fair share.

Every document gets a mask of the filters that it fails, so no order is ever run: all counts follow from the number of
documents by (part, mask). ``A`` to ``D`` look at one text; ``E`` fails a text that is identical to that of any smaller id.

Masks of the checks of one text and fingerprints of all texts are taken in a first pass; only rows whose fingerprint two
ids share are read again with their texts. These are routed by fingerprint: partitioned by xxhash and sorted by it inside a
partition, so a task holds one fingerprint's chain at a time, which stores each different text in full (equal fingerprints of
different texts stay apart) with its least id; ids that aren't the least are emitted as repeats. A group of copies of any size
is thinned before the shuffle: a map task holds chains of its own, up to ``HELD`` bytes of text, settles the rows that its
least id beats and sends one candidate a text; settled rows travel without their text, dealt by their id. Vectors of counts by
mask are then merged by combineByKey, one from each task and part.

Nulls: a null text is empty; a null source is the part ''. A row of null doc_id isn't smaller nor greater than any, so it
never fails E and fails nobody; it has no label. Rows that repeat count each; those of one id don't fail E by each other.
Several labels of one id: one that is 1 counts. An empty table has no parts. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm import _text
from funnelspark.llm._spark import broadcast_if, cut, discard, small_batches

#: Fingerprints that may be broadcast, 8 bytes each; more are joined by a shuffle.
BROADCAST_PRINTS = 1_000_000
#: Bytes of different texts that a map task holds before it sends them on.
HELD = 32 << 20
#: Texts beyond are not split into words at once.
LONG = 4 << 20
_CAPITALS, _SPECIAL, _WORD = bytes(range(0x41, 0x5B)), re.compile(rb"[#$%&*|]"), re.compile(rb"[^\x20\x09-\x0D]+")


def few_words(raw: bytes, n_words: int, n_distinct: int) -> bool:
    return n_words < 50


def repetitive(raw: bytes, n_words: int, n_distinct: int) -> bool:
    return 100 * n_distinct < 65 * n_words


def shouting(raw: bytes, n_words: int, n_distinct: int) -> bool:
    points = len(raw) if raw.isascii() else len(raw.decode("utf-8", "surrogatepass"))
    return 100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > 5 * points


def special(raw: bytes, n_words: int, n_distinct: int) -> bool:
    return _SPECIAL.search(raw) is not None


#: What looks at one text, by letter: bytes of the text, number of words, number of different words.
CHECKS: dict[str, Callable[[bytes, int, int], bool]] = {"A": few_words, "B": repetitive, "C": shouting, "D": special}
REPEATED = "E"


def word_counts(raw: bytes) -> tuple[int, int]:
    """Number of words, split at ASCII white space as bytes.split does, and of different ones."""
    if len(raw) <= LONG:
        words = raw.split()
        return len(words), len(set(words))
    n, seen = 0, set()
    for m in _WORD.finditer(raw):
        n += 1
        seen.add(m.group())
    return n, len(seen)


class Chains:
    """Different texts by fingerprint, each with its least id so far and the rows of that id by part."""

    def __init__(self) -> None:
        self.chains: dict[int, list[list]] = {}
        self.held = 0

    def add(self, fingerprint: int, raw: bytes, mask: int, doc_id: int, parts: Counter) -> tuple[int, int, Counter] | None:
        """Takes rows in; gives back the id, mask and parts of rows that turn out to repeat a smaller id's text."""
        chain = self.chains.setdefault(fingerprint, [])
        entry = next((e for e in chain if e[0] == raw), None)
        if entry is None:
            chain.append([raw, mask, doc_id, Counter(parts)])
            self.held += len(raw) + 200
            return None
        if doc_id == entry[2]:
            entry[3].update(parts)
            return None
        if doc_id > entry[2]:
            return doc_id, mask, parts
        beaten = entry[2], mask, entry[3]
        entry[2:] = doc_id, Counter(parts)
        return beaten

    def least(self) -> Iterator[tuple[int, bytes, int, int, Counter]]:
        for fingerprint, chain in self.chains.items():
            for raw, mask, doc_id, parts in chain:
                yield fingerprint, raw, mask, doc_id, parts
        self.chains, self.held = {}, 0


def mask_of(raw: bytes, checks: dict) -> int:
    counts = word_counts(raw)
    return sum(1 << i for i, check in enumerate(checks.values()) if check(raw, *counts))


def _masked(checks: dict) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [mask_of(data[a:b].tobytes(), checks) for _, _, data, ends in _text.slices(batch.column("text")) for a, b in itertools.pairwise(ends.tolist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "part", "fingerprint")), pa.array(found, pa.int32())], ["doc_id", "part", "fingerprint", "mask"])

    return run


def _thinned(checks: dict) -> Callable:
    """Map side: (fingerprint, (text or None, mask, doc_id, parts)); rows without text are settled."""
    repeated = 1 << len(checks)

    def run(rows):
        chains = Chains()
        for doc_id, part, fingerprint, text in rows:
            raw = (text or "").encode("utf-8", "surrogatepass")
            if beaten := chains.add(fingerprint, raw, mask_of(raw, checks), doc_id, Counter({part: 1})):
                yield xxhash.xxh64_intdigest(str(beaten[0])), (None, beaten[1] | repeated, beaten[0], beaten[2])
            if chains.held > HELD:
                yield from ((f, (r, m, d, p)) for f, r, m, d, p in chains.least())
        yield from ((f, (r, m, d, p)) for f, r, m, d, p in chains.least())

    return run


def _settled(repeated: int) -> Callable:
    """Reduce side: rows sorted by fingerprint to (doc_id, part, mask, n)."""

    def run(rows):
        flat = lambda doc_id, mask, parts: ((doc_id, part, mask, n) for part, n in parts.items())
        for fingerprint, group in itertools.groupby(rows, key=lambda kv: kv[0]):
            chains = Chains()
            for _, (raw, mask, doc_id, parts) in group:
                if raw is None:
                    yield from flat(doc_id, mask, parts)
                elif beaten := chains.add(fingerprint, raw, mask, doc_id, parts):
                    yield from flat(beaten[0], beaten[1] | repeated, beaten[2])
            for _, _, mask, doc_id, parts in chains.least():
                yield from flat(doc_id, mask, parts)

    return run


def masks(docs: DataFrame, checks: dict | None = None) -> DataFrame:
    """doc_id, part, mask, n: the filters that n rows of an id and part fail, bit i for the i-th check, the next for repeated texts."""
    checks, spark = checks or CHECKS, docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("fingerprint"), "text")
    plain = cut(rows.mapInArrow(_masked(checks), "doc_id long, part string, fingerprint long, mask int"), "checked")
    shared = plain.filter("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    shared = cut(shared.select("fingerprint"), "shared")
    prints = broadcast_if(shared, BROADCAST_PRINTS)
    alone = plain.filter("doc_id is null").unionByName(plain.filter("doc_id is not null").join(prints, "fingerprint", "left_anti"))

    texts = rows.filter("doc_id is not null").join(prints, "fingerprint", "left_semi").select("doc_id", "part", "fingerprint", "text").rdd
    parts = max(texts.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    routed = texts.mapPartitions(_thinned(checks)).repartitionAndSortWithinPartitions(parts, lambda fingerprint: fingerprint % parts)
    settled = spark.createDataFrame(routed.mapPartitions(_settled(1 << len(checks))), "doc_id long, part string, mask int, n long")
    found = cut(settled.unionByName(alone.select("doc_id", "part", "mask", F.lit(1).cast("long").alias("n"))), "masks")
    discard(plain, shared)
    return found


def vectors(found: DataFrame, labels: DataFrame, n_filters: int) -> RDD:
    """(part, counts): counts by mask of all rows, good ones and toxic ones, in one list."""
    size = 1 << n_filters
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    labelled = found.filter("doc_id is not null").join(known, "doc_id", "left").select("part", "mask", "n", "good", "toxic")
    nameless = found.filter("doc_id is null").select("part", "mask", "n", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))

    def add(vector, row):
        mask, n, good, toxic = row
        vector[mask] += n
        vector[size + mask] += n * (good or 0)
        vector[2 * size + mask] += n * (toxic or 0)
        return vector

    rows = labelled.unionByName(nameless).rdd.map(lambda r: (r.part, (r.mask, r.n, r.good, r.toxic)))
    return rows.combineByKey(lambda row: add([0] * (3 * size), row), add, lambda a, b: [x + y for x, y in zip(a, b, strict=True)])


def _table(letters: str) -> tuple[list, dict[str, np.ndarray]]:
    """(order, step, letter) of every row of a part's table, and for each figure the masks that count towards that row."""
    size, places, picked = 1 << len(letters), [], {"kept": [], "removed": [], "redundant": [], "unique_fails": []}
    mask = np.arange(size)
    for order in itertools.permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            places.append(("".join(order), step, letter))
            fails, gone = mask & bit != 0, mask & before != 0
            for name, chosen in (("kept", mask & (before | bit) == 0), ("removed", fails & ~gone), ("redundant", fails & gone), ("unique_fails", mask == bit)):
                picked[name].append(chosen)
            before |= bit
    return places, {k: np.array(v, dtype=np.int64) for k, v in picked.items()}


def audit(docs: DataFrame, labels: DataFrame, checks: dict | None = None) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: a row for each part,
    order of all filters and step, from docs(doc_id, source, text) and labels(doc_id, quality, toxic).

    shapley is the filter's removed summed over all orders; divided by their number it is its Shapley value."""
    checks = checks or CHECKS
    letters = "".join(checks) + REPEATED
    size = 1 << len(letters)

    def report(vectors):
        places, picked = _table(letters)
        for part, counts in vectors:
            every, good, toxic = (np.array(counts[i * size : (i + 1) * size], dtype=np.int64) for i in range(3))
            figures = {k: v @ every for k, v in picked.items()}
            shares = Counter()
            for (_, _, letter), n in zip(places, figures["removed"], strict=True):
                shares[letter] += int(n)
            lost = picked["removed"] @ good, picked["removed"] @ toxic
            for i, (order, step, letter) in enumerate(places):
                yield (part, order, step, *(int(figures[k][i]) for k in ("kept", "removed", "redundant", "unique_fails")), int(lost[0][i]), int(lost[1][i]), shares[letter])

    counted = vectors(masks(docs, checks), labels, len(letters)).mapPartitions(report)
    long = ", ".join(f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return docs.sparkSession.createDataFrame(counted, f"part string, filter_order string, step int, {long}")
