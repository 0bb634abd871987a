"""Repeated passages by run-length indexes: every byte that a string of ``LENGTH`` bytes covers which starts elsewhere too.

Whether a string starts elsewhere is read off a run-length index: the Burrows-Wheeler transform of a shard of text kept as
runs, with the text positions of each run's first and last suffix as samples. Streaming over the text from left to right, the
longest match of a position with its neighbours among all suffixes is that of the position before less one, but where a
run begins (for the neighbour above) or ends (below), and there the samples name the neighbour to compare with. The more a
shard repeats itself, the fewer runs and comparisons there are. Positions whose statistic reaches ``LENGTH`` are marked.

All occurrences of a string must meet in one shard, and nothing else need be there:

1. Every string of LENGTH bytes has an anchor, the least hash of its runs of ``GRAM`` bytes, so equal strings have equal
   anchors. A text is cut into regions: neighbouring starts of one anchor. Regions are counted by anchor and content, after
   which a group of copies is one row with its number; anchors that occur once are dropped with all their regions.
2. The shard of an anchor is that of the least of the texts that hold it, so neighbouring regions of a text mostly go
   to one shard, in one piece. One occurrence of every different region is fetched there; one that occurs several times is
   indexed once, with its number, as its starts match those of its copy. Shards are packed to about ``SHARD`` bytes; a text
   that gathers more is spread over several shards by anchor.
3. An anchor with more than ``HOT`` bytes of different regions (one passage in a great many different surroundings) would be a
   shard too large by itself: its strings are counted by their hashes instead, which any number of tasks share.
4. Marks go back to all occurrences of their regions by a join, and to the texts by another.

Matches never cross texts; strings may overlap and are judged on the input. A null text is empty; texts of fewer than LENGTH
bytes keep all. Rows that repeat are copies of each other; a null doc_id is an id like others. Long texts are handled in
pieces of ``PIECE`` starts. Other columns are ignored. Contents are told apart by 128 bits of hashes.

Passages of words that repeat across documents, however few bytes they have, are found beside these by the same regions and
anchors, with words in the place of bytes (``repeated_passages``). They are counted, not removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm import _text
from funnelspark.llm._spark import broadcast_if, cut, discard, small_batches

LENGTH, GRAM = 400, 32
PIECE, LONGEST = 1 << 20, 4096
SHARD, HOT = 1 << 20, 1 << 22
#: A passage has over 50 words; anchors are hashes of runs of 8.
PASSAGE, WORD_GRAM = 51, 8
#: Runs of words in a shard, and those of an anchor that is counted by itself.
WINDOWS, HOT_WINDOWS = 1 << 17, 1 << 19
#: Rows that may be broadcast, of 16 bytes.
BROADCAST_IDS = 1_000_000
U = np.uint64


# --- the index -------------------------------------------------------------------------------------------------------


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as big-endian numbers; zeros follow the end."""
    padded = np.concatenate((text, np.zeros(8, dtype=np.uint8)))
    out = padded[: len(text)].astype(U)
    for j in range(1, 8):
        out = (out << U(8)) | padded[j : j + len(text)]
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling: only those that still tie are sorted again, by ranks of twice the length."""
    n = len(text)
    bits = U(max(1, int(n).bit_length()))
    known = (64 - int(bits)) // 8
    packed = np.sort((_words(text) >> U(8 * (8 - known)) << bits) | np.arange(n, dtype=U))
    order = (packed & ((U(1) << bits) - U(1))).astype(np.int64)
    key, at = packed >> bits, np.arange(n)
    rank = np.zeros(n + 1, dtype=np.int64)  # from 1; 0 is what follows the end
    while True:
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        rank[order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))] + 1
        tied = ~(new & np.append(new[1:], True))
        at = at[tied]
        if not len(at):
            return order
        own = order[at]
        after = rank[np.minimum(own + known, n)]
        if 3 * int(bits) <= 64:
            packed = np.sort((rank[own].astype(U) << U(2 * int(bits))) | (after.astype(U) << bits) | np.arange(len(at), dtype=U))
            order[at] = own[(packed & ((U(1) << bits) - U(1))).astype(np.int64)]
            key = packed >> bits
        else:
            key = rank[own] * (n + 1) + after
            turn = np.argsort(key, kind="stable")
            order[at], key = own[turn], key[turn]
        known *= 2


class RunIndex:
    """A run-length compressed Burrows-Wheeler transform with the positions of each run's first and last suffix."""

    def __init__(self, text: np.ndarray) -> None:
        """text: bytes that end with a 0; 255 must not occur."""
        order = suffix_array(text)
        before = text[order - 1]
        before[order == 0] = 255
        starts = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        ends = np.append(starts[1:], len(text)) - 1
        self.text, self.symbols, self.lengths = text, before[starts], ends - starts + 1
        self.first, self.last = order[starts], order[ends]

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of suffixes a and b, eight bytes a step, then ever more for those that go on."""
        words = np.append(_words(self.text), np.zeros(1, dtype=U))
        out, n = np.zeros(len(a), dtype=np.int64), len(self.text)
        live, span = np.arange(len(a)), 1
        while len(live):
            at = 8 * np.arange(span)
            x, y = ((s[live] + out[live])[:, None] + at for s in (a, b))
            differ = words[np.minimum(x, n)] ^ words[np.minimum(y, n)]
            over = np.maximum(x[:, -1], y[:, -1]) + 8 > n
            unlike = differ != 0
            ended = unlike.any(axis=1)
            first = unlike.argmax(axis=1)[ended]
            word = differ[ended, first]
            out[live[ended]] += 8 * first + sum((word < (U(1) << U(8 * k))).astype(np.int64) for k in range(1, 8))
            out[live[~ended & ~over]] += 8 * span
            live = live[~ended & ~over]
            span = min(64, max(1, 4096 // max(len(live), 1)))
        return out

    def statistics(self) -> np.ndarray:
        """For every position the length of its longest match that starts anywhere else."""
        n = len(self.text)
        common = self._common(self.first[1:], self.last[:-1])
        best = np.zeros(n, dtype=np.int64)
        for sampled, length in ((self.first, np.append(0, common)), (self.last, np.append(common, 0))):
            value = np.zeros(n, dtype=np.int64)
            value[sampled] = length + sampled  # of the positions up to the next sample: less their distance
            at = np.zeros(n, dtype=np.int64)
            at[sampled] = sampled
            streamed = value[np.maximum.accumulate(at)] - np.arange(n)
            np.maximum(best, streamed, out=best)
        return best


# --- regions and anchors ---------------------------------------------------------------------------------------------


def regions(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of some texts laid end to end: document, start, number of starts, anchor and content hash of every region, and whether
    it holds its anchor more than once, so that strings of the region may equal each other."""
    n, sizes = len(data), np.diff(offsets)
    starts = np.maximum(sizes - length + 1, 0)
    if not starts.sum():
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, U, U, bool))
    up, down = _text.powers(n + 1)
    total = np.zeros(n + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * up[:n], out=total[1:])
    m = n - gram + 1
    grams = least = _text.mix((total[gram:] - total[:m]) * down[:m])
    width, wanted = 1, length - gram + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    doc = np.repeat(np.arange(len(sizes)), starts)
    at = np.repeat(offsets[:-1], starts) + np.arange(len(doc)) - np.repeat(np.cumsum(starts) - starts, starts)
    anchor = least[at]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))
    first = np.flatnonzero(new)
    run = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
    first = np.flatnonzero(run % LONGEST == 0)
    many = np.diff(np.append(first, len(doc)))
    a = at[first]
    content = _text.mix((total[a + many + length - 1] - total[a]) * down[a] + many.astype(U))
    # an anchor that also is where a string starts that isn't the region's last, or ends one that isn't its first, occurs again
    again = (grams[at] == anchor) & (np.append(run[1:], 0) % LONGEST != 0) | (grams[at + wanted - 1] == anchor) & (run % LONGEST != 0)
    return doc[first], a - offsets[doc[first]], many, anchor[first], content, np.logical_or.reduceat(again, first)


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """A slice as it is, or a long text in overlapping pieces: bytes, offsets, place of the piece."""
    if len(data) <= PIECE + length or len(offsets) > 2:
        yield data, offsets, 0
        return
    for place in range(0, len(data) - length + 1, PIECE):
        part = data[place : place + PIECE + length - 1]
        yield part, np.array([0, len(part)]), place


#: Words are what lies between white space; bytes of UTF-8 are below 254, so all can be raised by one to make room for 0.
_SPACED = np.arange(1, 257, dtype=np.int64).astype(np.uint8)
_SPACED[[0x20, *range(0x09, 0x0E)]] = 0


def _worded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of bytes to texts of words, each word a 64-bit hash; a long text is hashed in pieces that end at white space."""
    if len(data) <= PIECE or len(offsets) > 2:
        found, counts = _text.words(data, offsets, _SPACED)
        return found, np.append(0, np.cumsum(counts))
    cuts = np.flatnonzero(_SPACED[data] == 0)
    cuts = np.unique(cuts[np.minimum(np.searchsorted(cuts, np.arange(PIECE, len(data), PIECE)), len(cuts) - 1)]) if len(cuts) else cuts
    edges = [0, *cuts.tolist(), len(data)]
    found = np.concatenate([_text.words(data[a:b], np.array([0, b - a]), _SPACED)[0] for a, b in zip(edges[:-1], edges[1:], strict=True)])
    return found, np.array([0, len(found)])


def _anchored(length: int, gram: int, worded: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in _text.slices(batch.column("text")):
                if worded:
                    data, offsets = _worded(data, offsets)
                for part, ends, place in _pieces(data, offsets, length):
                    doc, a, n, anchor, content, again = regions(part, ends, length, gram)
                    found, where = np.unique(doc, return_index=True)
                    bounds = pa.array(np.append(where, len(doc)), pa.int32())
                    lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in ((a + place).astype(np.int32), n.astype(np.int32), anchor.view(np.int64), content.view(np.int64), again)]
                    ids = [batch.column(c).take(pa.array(found + low)) for c in ("i", "t")]
                    yield pa.RecordBatch.from_arrays([*ids, *lists], ["i", "t", "a", "n", "anchor", "content", "again"])

    return run


# --- shards ----------------------------------------------------------------------------------------------------------


def _bodies(column: pa.Array) -> list[np.ndarray]:
    """Every text's bytes."""
    for _, _, data, offsets in _text.slices(column, 1 << 62):
        return [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    return []


def _cut_out(length: int):
    """Texts with the regions wanted of them, to segments: neighbouring regions of one shard in one piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"shard": pa.int64(), "body": pa.binary(), **{c: pa.list_(pa.int64()) for c in ("a", "n", "anchor", "content", "m")}}
        for batch in batches:
            rows = {c: [] for c in kinds}
            for data, wanted in zip(_bodies(batch.column("text")), batch.column("wanted").to_pylist(), strict=True):
                wanted.sort(key=lambda r: r["a"])
                group: list[dict] = []
                for r in [*wanted, None]:
                    if group and (r is None or r["shard"] is None or r["shard"] != group[-1]["shard"] or r["a"] != group[-1]["a"] + group[-1]["n"]):
                        start, end = group[0]["a"], group[-1]["a"] + group[-1]["n"] + length - 1
                        rows["shard"].append(group[0]["shard"])
                        rows["body"].append(data[start:end].tobytes())
                        for c in ("n", "anchor", "content", "m"):
                            rows[c].append([x[c] for x in group])
                        rows["a"].append([x["a"] - start for x in group])
                        group = []
                    if r:
                        group.append(r)
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds[c]) for c, v in rows.items()], list(kinds))

    return run


_MARKS = "anchor long, content long, marks array<struct<low:int,high:int>>"
_MARK = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end places of the runs of true flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _matched(length: int):
    """A shard's segments to the repeated starts of each region."""

    def run(shard: pa.Table) -> pa.Table:
        bodies = shard.column("body").to_pylist()
        text = np.frombuffer(b"".join(b.translate(_UP) + b"\0" for b in bodies), dtype=np.uint8)
        longest = RunIndex(text).statistics()
        out, place = {"anchor": [], "content": [], "marks": []}, 0
        for body, *columns in zip(bodies, *(shard.column(c).to_pylist() for c in ("a", "n", "anchor", "content", "m")), strict=True):
            for a, n, anchor, content, m in zip(*columns, strict=True):
                repeated = longest[place + a : place + a + n] >= length
                low, high = _runs(repeated | (m > 1))
                if len(low):
                    out["anchor"].append(anchor)
                    out["content"].append(content)
                    out["marks"].append([{"low": x, "high": y} for x, y in zip(low.tolist(), high.tolist(), strict=True)])
            place += len(body) + 1
        return pa.table({"anchor": pa.array(out["anchor"], pa.int64()), "content": pa.array(out["content"], pa.int64()), "marks": pa.array(out["marks"], _MARK)})

    return run


#: Bytes of UTF-8 are below 254, so all can be raised by one to make room for 0.
_UP = bytes((b + 1) & 255 for b in range(256))


def _strings(length: int):
    """Segments of one hot region each, to a row for each of their strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, anchor, content, m in zip(*(batch.column(c).to_pylist() for c in ("body", "anchor", "content", "m")), strict=True):
                data = np.frombuffer(body, dtype=np.uint8)
                up, down = _text.powers(len(data) + 1)
                total = np.zeros(len(data) + 1, dtype=U)
                np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=total[1:])
                n = len(data) - length + 1
                string = _text.mix((total[length:] - total[:n]) * down[:n]).view(np.int64)
                columns = [np.full(n, anchor[0]), np.full(n, content[0]), np.full(n, m[0]), np.arange(n, dtype=np.int32), string]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "content", "m", "low", "string"])

    return run


def repeated_starts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """i, t, starts: hashes that name a row of docs(doc_id, text), and the runs (low, high) of starts of strings that start elsewhere too."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.xxhash64("doc_id").alias("i"), F.xxhash64("text", F.length("text")).alias("t"), "text").filter(F.octet_length("text") >= length)
    anchors = cut(texts.mapInArrow(_anchored(length, gram), "i long, t long, a array<int>, n array<int>, anchor array<long>, content array<long>, again array<boolean>"), "anchors")
    every = anchors.select("i", "t", F.explode(F.arrays_zip("a", "n", "anchor", "content", "again")).alias("r")).select("i", "t", "r.*")

    kinds = cut(every.groupBy("anchor", "content").agg(F.count("*").alias("m"), F.min(F.struct("i", "t", "a")).alias("at"), F.max("n").alias("n"), F.max("again").alias("again")), "kinds")
    size = (F.col("n") + length - 1).cast("long")
    met = kinds.groupBy("anchor").agg(F.sum("m").alias("m"), F.sum(size).alias("bytes"), F.min("at.i").alias("leader"), F.max("again").alias("again"))
    met = met.filter("m > 1 or again").drop("m", "again")
    met = cut(met, "met")
    led = met.filter(F.col("bytes") <= hot).groupBy("leader").agg(F.sum("bytes").alias("all"))
    n_shards = int((led.agg(F.sum("all")).first()[0] or 0) // shard) + 1
    spread = F.when(F.col("all") > shard, F.pmod(F.xxhash64("anchor"), F.ceil(F.col("all") / shard))).otherwise(0)
    homes = met.join(led, "leader", "left").select("anchor", F.when(F.col("bytes") <= hot, F.pmod(F.xxhash64("leader", spread), F.lit(n_shards))).alias("shard"))
    wanted = kinds.join(homes, "anchor").select("at.i", "at.t", F.struct("at.a", "n", "shard", "anchor", "content", "m").alias("r"))
    wanted = cut(wanted.groupBy("i", "t").agg(F.collect_list("r").alias("wanted")), "wanted")

    ids = broadcast_if(wanted.select("i", "t"), BROADCAST_IDS)
    holders = texts.join(ids, ["i", "t"], "left_semi").dropDuplicates(["i", "t"])
    segments = holders.join(wanted, ["i", "t"]).select("text", "wanted")
    lists = ", ".join(f"{c} array<long>" for c in ("a", "n", "anchor", "content", "m"))
    segments = cut(segments.mapInArrow(_cut_out(length), f"shard long, body binary, {lists}"), "segments")
    marks = segments.filter("shard is not null").groupBy("shard").applyInArrow(_matched(length), _MARKS)
    strings = segments.filter("shard is null").mapInArrow(_strings(length), "anchor long, content long, m long, low int, string long")
    often = strings.groupBy("anchor", "string").agg(F.sum("m").alias("times")).filter("times > 1").drop("times")
    single = strings.join(often, ["anchor", "string"], "left_semi").groupBy("anchor", "content").agg(F.array_sort(F.collect_list("low")).alias("lows"))
    marks = cut(marks.unionByName(single.select("anchor", "content", F.transform("lows", lambda x: F.struct(x.alias("low"), (x + 1).alias("high"))).alias("marks"))), "marks")
    discard(kinds, met, wanted, segments)

    found = every.select("i", "t", "a", "anchor", "content").join(marks, ["anchor", "content"])
    found = found.select("i", "t", F.transform("marks", lambda x: F.struct((x["low"] + F.col("a")).alias("low"), (x["high"] + F.col("a")).alias("high"))).alias("starts"))
    out = cut(found.groupBy("i", "t").agg(F.flatten(F.collect_list("starts")).alias("starts")), "starts")
    discard(anchors, marks)
    return out


# --- passages of words -----------------------------------------------------------------------------------------------


def _windows(words: int):
    """Texts with the regions wanted of them, to the hashes of each region's runs of so many words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, strings = {"shard": [], "anchor": [], "content": [], "far": [], "d": []}, [np.zeros(0, dtype=U)]
            for data, d, wanted in zip(_bodies(batch.column("text")), batch.column("d").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                found, _ = _worded(data, np.array([0, len(data)]))
                up, down = _text.powers(len(found) + 1)
                total = np.zeros(len(found) + 1, dtype=U)
                np.cumsum((found + U(1)) * up[: len(found)], out=total[1:])
                m = len(found) - words + 1
                string = _text.mix((total[words:] - total[:m]) * down[:m])
                strings += [string[r["a"] : r["a"] + r["n"]] for r in wanted]
                for c in ("shard", "anchor", "content", "far"):
                    rows[c] += [r[c] for r in wanted]
                rows["d"] += [d] * len(wanted)
            ends = np.cumsum([len(x) for x in strings]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(strings).view(np.int64)))
            columns = [pa.array(v, pa.bool_() if c == "far" else pa.int64()) for c, v in rows.items()]
            yield pa.RecordBatch.from_arrays([*columns, lists], [*rows, "strings"])

    return run


def _met(shard: pa.Table) -> pa.Table:
    """A shard's regions to the starts of each whose run of words another document has."""
    shard = shard.combine_chunks()
    lists = shard.column("strings").combine_chunks()
    n = np.diff(np.asarray(lists.offsets))
    string = np.asarray(lists.flatten())
    row = np.repeat(np.arange(len(n)), n)
    anchor, far, d = (np.asarray(shard.column(c)) for c in ("anchor", "far", "d"))
    turn = np.lexsort((string, anchor[row]))
    own, of = string[turn], row[turn]
    new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (anchor[of[1:]] != anchor[of[:-1]])))
    often = np.logical_or.reduceat(far[of], new) | (np.minimum.reduceat(d[of], new) < np.maximum.reduceat(d[of], new))
    repeated = np.zeros(len(string), dtype=bool)
    repeated[turn] = np.repeat(often, np.diff(np.append(new, len(own))))
    first = np.cumsum(n) - n
    begins = repeated & np.append(True, ~repeated[:-1] | (row[1:] != row[:-1]))
    stops = repeated & np.append(~repeated[1:] | (row[1:] != row[:-1]), True)
    low, high = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    held, where = np.unique(row[low], return_index=True)
    place = first[row[low]]
    runs = pa.StructArray.from_arrays([pa.array((low - place).astype(np.int32)), pa.array((high - place).astype(np.int32))], ["low", "high"])
    marks = pa.ListArray.from_arrays(pa.array(np.append(where, len(low)).astype(np.int32)), runs)
    return pa.table({"anchor": pa.array(anchor[held]), "content": shard.column("content").take(pa.array(held)), "marks": marks})


def repeated_passages(docs: DataFrame, words: int = PASSAGE, gram: int = WORD_GRAM, shard: int = WINDOWS, hot: int = HOT_WINDOWS) -> DataFrame:
    """i, t, n_repeated_words: hashes that name a row of docs(doc_id, text), and the number of its words that lie in a run of so
    many words which also is in another document. Texts without any are left out; rows of one doc_id and text are one document.

    Words are maximal runs of other bytes than white space, case kept. Regions of one anchor and content are one kind. An anchor of
    one kind is repeated whole if two documents have it; else the kinds' runs of words meet as hashes in the shard of their anchor, or
    in a row each where an anchor has more than ``hot`` of them."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.xxhash64("doc_id").alias("i"), F.xxhash64("text", F.length("text")).alias("t"), "text").filter(F.octet_length("text") >= 2 * words - 1)
    anchors = cut(texts.mapInArrow(_anchored(words, gram, True), "i long, t long, a array<int>, n array<int>, anchor array<long>, content array<long>, again array<boolean>"), "passage-anchors")
    every = anchors.select("i", "t", F.explode(F.arrays_zip("a", "n", "anchor", "content")).alias("r")).select("i", "t", "r.*")
    d = F.xxhash64("i", "t")
    kinds = cut(every.groupBy("anchor", "content").agg(F.min(d).alias("first"), F.max(d).alias("last"), F.min(F.struct("i", "t", "a")).alias("at"), F.max("n").alias("n")), "passage-kinds")
    met = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum(F.col("n").cast("long")).alias("all"), F.min("first").alias("least"), F.max("last").alias("most"))
    met = cut(kinds.join(met.filter("least < most").select("anchor", "kinds", "all"), "anchor"), "passage-met")
    n_shards = int((met.filter((F.col("kinds") > 1) & (F.col("all") <= hot)).agg(F.sum(F.col("n").cast("long"))).first()[0] or 0) // shard) + 1

    home = F.when(F.col("all") <= hot, F.pmod(F.xxhash64("anchor"), F.lit(n_shards)))
    wanted = met.filter("kinds > 1").select("at.i", "at.t", F.struct("at.a", "n", home.alias("shard"), "anchor", "content", (F.col("first") < F.col("last")).alias("far")).alias("r"))
    wanted = cut(wanted.groupBy("i", "t").agg(F.collect_list("r").alias("wanted")), "passage-wanted")
    ids = broadcast_if(wanted.select("i", "t"), BROADCAST_IDS)
    holders = texts.join(ids, ["i", "t"], "left_semi").dropDuplicates(["i", "t"]).join(wanted, ["i", "t"]).select(d.alias("d"), "text", "wanted")
    windows = cut(holders.mapInArrow(_windows(words), "shard long, anchor long, content long, far boolean, d long, strings array<long>"), "passage-windows")
    some = windows.filter("shard is not null").groupBy("shard").applyInArrow(_met, _MARKS)
    single = windows.filter("shard is null").select("anchor", "content", "far", "d", F.posexplode("strings").alias("low", "string"))
    often = single.groupBy("anchor", "string").agg(F.max("far").alias("far"), F.min("d").alias("least"), F.max("d").alias("most"))
    often = often.filter("far or least < most").select("anchor", "string")
    single = single.join(often, ["anchor", "string"], "left_semi").groupBy("anchor", "content").agg(F.array_sort(F.collect_list("low")).alias("lows"))
    single = single.select("anchor", "content", F.transform("lows", lambda x: F.struct(x.alias("low"), (x + 1).alias("high"))).alias("marks"))
    whole = met.filter("kinds = 1").select("anchor", "content", F.array(F.struct(F.lit(0).alias("low"), F.col("n").alias("high"))).alias("marks"))
    marks = cut(whole.unionByName(some).unionByName(single), "passage-marks")
    discard(kinds, met, wanted, windows)

    found = every.select("i", "t", "a", "anchor", "content").join(marks, ["anchor", "content"])
    found = found.select("i", "t", F.transform("marks", lambda x: F.struct((x["low"] + F.col("a")).alias("low"), (x["high"] + F.col("a") + words - 1).alias("high"))).alias("runs"))
    found = found.groupBy("i", "t").agg(F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("runs", start, lambda acc, x: F.struct((acc["n"] + F.greatest(x["high"] - F.greatest(x["low"], acc["end"]), F.lit(0))).alias("n"), F.greatest(acc["end"], x["high"]).alias("end")))
    out = cut(found.select("i", "t", covered["n"].alias("n_repeated_words")), "passages")
    discard(anchors, marks)
    return out


def _kept(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found, bodies = [], []
            for data, starts in zip(_bodies(batch.column("text")), batch.column("starts"), strict=True):
                raw, runs = data.tobytes(), []
                if starts.is_valid:
                    bounds = starts.values.flatten()
                    low, high = (np.asarray(b, dtype=np.int64) for b in bounds)
                    turn = np.argsort(low, kind="stable")
                    low, end = low[turn], np.maximum.accumulate(high[turn] + length - 1)
                    new = np.append(True, low[1:] > end[:-1])
                    runs = list(zip(low[new].tolist(), end[np.append(new[1:], True)].tolist(), strict=True))
                edges = [0, *(x for r in runs for x in r), len(raw)]
                bodies.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if runs else raw)
                found.append([{"start": a, "end": b} for a, b in runs])
            columns = [batch.column("doc_id"), pa.array([len(d) for d in _bodies(batch.column("text"))], pa.int64()), pa.array(found, spans), pa.array(bodies, pa.binary())]
            more = batch.schema.names[3:]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in more)], ["doc_id", "n_bytes", "spans", "kept", *more])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD, hot: int = HOT, words: int = 0) -> DataFrame:
    """doc_id, n_bytes, spans (start and end of the runs of removed bytes), kept (the bytes left): a row for each row of docs.
    With words also n_repeated_words: the words in runs of so many that are in another document too, removed or not."""
    marked = repeated_starts(docs, length, gram, shard, hot)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("i"), F.xxhash64("text", F.length("text")).alias("t"))
    rows = rows.join(marked, ["i", "t"], "left")
    more = []
    if words:
        rows = rows.join(repeated_passages(docs, words), ["i", "t"], "left")
        more = [F.coalesce("n_repeated_words", F.lit(0).cast("long")).alias("n_repeated_words")]
    rows = rows.select("doc_id", "text", "starts", *more)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_kept(length), f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary" + ", n_repeated_words long" * bool(words))
