"""Benchmark decontamination by winnowing (Schleimer, Wilkerson, Aiken 2003), in DataFrame functions only.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z is lower-cased. Of every window of ``WINDOW`` words the
least hash of its runs of ``GRAM`` words is kept; neighbouring windows mostly keep the same one. Texts that share a whole
window share its kept hash, so the equi-join of the distinct kept hashes misses none. Documents that meet an item there are
read again and extended: the hashes of all words of their windows are joined to those of the items' windows.

An item shorter than a window is one window of its own length; only where there are such items are runs of these lengths
(nine at most) compared too. Items' windows are broadcast up to ``BROADCAST_WINDOWS`` of them, else joined by a shuffle.

Nulls: a null text has no words; a null item_id marks words but is not listed. Documents and items that repeat are
handled row by row: a repeated row gives a repeated result, a repeated item counts once. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.llm._spark import broadcast_if, cut

WINDOW, GRAM = 10, 5
#: 16 bytes each.
BROADCAST_WINDOWS, BROADCAST_IDS = 500_000, 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text; lower() is the fast way of lower-casing A-Z where all is ASCII."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _zipped(a: str, b: str, shift: int, length: Column, how) -> Column:
    """how(a[i], b[i + shift]) for the first ``length`` places."""
    m = F.greatest(length, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), m), F.slice(b, F.lit(1 + shift), m), how)


def with_runs(df: DataFrame, lengths: set[int]) -> DataFrame:
    """Adds r{k}, hashes of all runs of k words, for each k, from ``h``, hashes of the ``n`` words; each from two shorter ones."""
    parts: dict[int, tuple[int, int]] = {}

    def need(k: int) -> None:
        if k > 1 and k not in parts:
            big = 1 << (k - 1).bit_length() - 1
            parts[k] = (big, k - big)
            need(big)
            need(k - big)

    for k in lengths:
        need(k)
    df = df.withColumnRenamed("h", "r1")
    for k in sorted(parts):
        a, b = parts[k]
        df = df.withColumn(f"r{k}", _zipped(f"r{a}", f"r{b}", a, F.col("n") - (k - 1), lambda x, y: F.xxhash64(x, y)))
    return df


# Arrays are exploded by the outer forms: before the others the optimizer puts a filter on the array's size, and pushing it
# down copies all that the array is made of, many times over.
def hashed(df: DataFrame, column: str = "words") -> DataFrame:
    """Adds ``n``, the number of words, and ``h``, their hashes, in place of the words."""
    return df.withColumns({"n": F.size(column), "h": F.transform(column, lambda w: F.xxhash64(w))}).drop(column)


def with_kept(df: DataFrame, window: int, gram: int, short: list[int]) -> DataFrame:
    """Adds ``kept``, the distinct least hashes of the windows and the hashes of all runs of the short lengths, to a frame with n and h."""
    df = with_runs(df, {gram, *short})
    width, k, least = window - gram + 1, 1, f"r{gram}"
    while k < width:  # least over 1, 2, 4 .. neighbours, then over all of a window
        step = min(k, width - k)
        df = df.withColumn(f"m{k + step}", _zipped(least, least, step, F.col("n") - (gram - 1) - (k + step - 1), lambda x, y: F.least(x, y)))
        k, least = k + step, f"m{k + step}"
    kept = F.array_distinct(F.slice(least, F.lit(1), F.greatest(F.col("n") - (window - 1), F.lit(0))))
    return df.withColumn("kept", F.concat(kept, *(F.array_distinct(f"r{i}") for i in short)))


def with_windows(df: DataFrame, window: int, short: list[int]) -> DataFrame:
    """One row for each window (and run of a short length) of a frame with n and h: at, length, window (its hash)."""
    df = with_runs(df, {window, *short})
    rest = [c for c in df.columns if c not in ("h",) and not (c[0] == "r" and c[1:].isdigit())]
    parts = [df.select(*rest, F.lit(k).alias("length"), F.posexplode_outer(f"r{k}").alias("at", "window")) for k in (window, *short)]
    for part in parts[1:]:
        parts[0] = parts[0].unionByName(part)
    return parts[0]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings, comma-joined), contaminated; a row for each row of docs(doc_id, text)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    short = sorted(r.n for r in items.select(F.size("words").alias("n")).filter(F.col("n") < window).distinct().collect())
    items = cut(hashed(items), "items")
    long_items, short_items = items.filter(F.col("n") >= window), items.filter(F.col("n") < window)
    kept = with_kept(long_items, window, gram, []).select(F.explode_outer("kept").alias("hash"))
    own = with_windows(long_items, window, []).select("item_id", "length", "window")
    if short:
        runs = with_windows(short_items, window, short).filter(F.col("length") == F.col("n")).select("item_id", "length", "window")
        own, kept = own.unionByName(runs), kept.unionByName(runs.select(F.col("window").alias("hash")))
    own = cut(own.distinct(), "windows")
    hashes = broadcast_if(cut(kept.distinct(), "kept"), BROADCAST_WINDOWS)
    windows = broadcast_if(own.select("length", "window").distinct(), BROADCAST_WINDOWS)

    key = ["doc_id", "text_hash"]
    rows = docs.select("doc_id", F.xxhash64("text", F.length("text")).alias("text_hash"), words(F.col("text")).alias("words"))
    # a row that stands for the document, and one for each of its kept hashes that is an item's
    every = with_kept(hashed(rows), window, gram, short).select(*key, "n", F.posexplode_outer(F.concat(F.array(F.lit(None).cast("long")), "kept")).alias("i", "hash"))
    every = every.join(hashes.withColumn("of_item", F.lit(True)), "hash", "left").filter("i = 0 or of_item")
    seen = cut(every.groupBy(*key).agg(F.max("n").alias("n_words"), F.sum(F.when(F.col("i") == 0, 1).otherwise(0)).alias("copies"), F.max("of_item").alias("hit")), "seen")

    ids = broadcast_if(seen.filter("hit").select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")), BROADCAST_IDS)
    suspects = docs.select("doc_id", F.xxhash64("text", F.length("text")).alias("text_hash"), "text")
    suspects = suspects.join(ids, suspects.doc_id.eqNullSafe(ids.d) & (suspects.text_hash == ids.t), "left_semi").select(*key, words(F.col("text")).alias("words"))
    hits = with_windows(hashed(suspects), window, short).join(windows, ["length", "window"])
    found = hits.groupBy(*key).agg(F.collect_set(F.struct("at", "length")).alias("spans"), F.collect_set("window").alias("windows"))
    found = cut(found, "found")
    step = lambda acc, s: F.struct(F.greatest(acc["end"], s["at"] + s["length"]).alias("end"), (acc["hit"] + F.greatest(F.lit(0), s["at"] + s["length"] - F.greatest(acc["end"], s["at"]))).alias("hit"))
    hit = F.aggregate(F.array_sort("spans"), F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")), step, lambda acc: acc["hit"])
    named = found.select(*key, F.explode("windows").alias("window"))
    by_window = broadcast_if(own.filter("item_id is not null").select("window", "item_id").distinct(), BROADCAST_WINDOWS)
    named = named.join(by_window, "window").select(*key, "item_id").distinct().groupBy(*key).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    named = named.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), "items")
    found = found.join(named, found.doc_id.eqNullSafe(named.d) & (found.text_hash == named.t), "left")
    found = found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), hit.alias("n_hit"), F.size("items").alias("n_items"), F.array_join("items", ",").alias("items"))
    out = seen.join(found, seen.doc_id.eqNullSafe(found.d) & (seen.text_hash == found.t), "left")
    out = out.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", F.col("n_words").cast("long"), zero("n_hit"), zero("n_items"), F.coalesce("items", F.lit("")).alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
