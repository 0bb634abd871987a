"""Duplicates inside blocks: exact survivors, pairs by token overlap, greedy groups."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.operators.signatures import WORDS, bitmaps, frequent, signatures
from funnelspark.sources.folders import broadcast_if, cut, discard


def survivors(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """Adds ``survivor`` (first of its group in a total order) and group_size; partial aggregation before the shuffle is left to the window limit."""
    w = W.partitionBy(*group)
    return rows.withColumns({"survivor": F.row_number().over(w.orderBy(*order)) == 1, "group_size": F.count("*").over(w)})


def first_wins(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter("_r = 1").drop("_r")


#: Different tokens whose numbers of sets may be broadcast, 24 bytes each.
BROADCAST_TOKENS = 1_000_000


def ordered_sets(rows: DataFrame, block: list[str], id_column: str, tokens: str, often: DataFrame | None = None) -> DataFrame:
    """block, id, n, t: the distinct tokens of each row as 64-bit hashes, the rarest first (by how many sets of the block hold
    them, or by a table often(block, token, often) of hashes, of which others are the rarest), ties by hash. Empty sets are left out."""
    sets = rows.select(*block, F.col(id_column).alias("id"), F.array_distinct(F.transform(tokens, lambda x: F.xxhash64(x))).alias("t")).filter(F.size("t") > 0)
    each = sets.select(*block, "id", F.explode("t").alias("token"))
    counts = each.groupBy(*block, "token").agg(F.count("*").alias("often")).filter("often > 1") if often is None else often
    counts = broadcast_if(cut(counts.select(*(F.col(b).alias(f"_b_{b}") for b in block), F.col("token").alias("_token"), "often"), "often"), BROADCAST_TOKENS)
    ranked = each.join(counts, _same(block, F.col("token") == F.col("_token")), "left").select(*block, "id", F.struct(F.coalesce("often", F.lit(0)).alias("often"), "token").alias("x"))
    ranked = ranked.groupBy(*block, "id").agg(F.array_sort(F.collect_list("x")).alias("x"))  # a row's own tokens
    return ranked.select(*block, "id", F.size("x").alias("n"), F.transform("x", lambda s: s["token"]).alias("t"))


def _same(block: list[str], also: Column) -> Column:
    for b in block:
        also = also & F.col(b).eqNullSafe(F.col(f"_b_{b}"))
    return also


def prefixes(sets: DataFrame, block: list[str], threshold: float) -> DataFrame:
    """block, id, n, i, token: the first tokens of ordered_sets(), of which two sets that overlap by the threshold share one."""
    size = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    return sets.select(*block, "id", "n", F.posexplode(F.slice("t", F.lit(1), size.cast("int"))).alias("i", "token"))


def _need(threshold: float) -> Column:
    """How many tokens sets of n_a and n_b must have in common."""
    return F.ceil((F.col("n_a") + F.col("n_b")) * threshold / (1 + threshold) - 1e-9)


def _candidates(met: DataFrame, threshold: float) -> DataFrame:
    """id_a, id_b of the rows of a join of prefixes that may overlap so far: by their sizes, by what is left from the first common
    token on, and by what is left after the last one.

    A common token with too little left on either side says nothing that the ones before it didn't, so its row goes before the shuffle."""
    left, need = F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b")), _need(threshold)
    fits = met.filter(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * threshold - 1e-9).filter(left >= need)
    agg = fits.groupBy("id_a", "id_b", "n_a", "n_b").agg(F.count("*").alias("m"), F.max("i_a").alias("i_a"), F.max("i_b").alias("i_b"))
    return agg.filter(F.col("m") + left - 1 >= need).select("id_a", "id_b")


#: The threshold from which on sets meet by signatures of several tokens.
BY_SIGNATURES = 0.7

#: Buckets of tokens whose numbers bound what two sets have in common.
BUCKETS = 64


def _bounded(pairs: DataFrame, a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """Those pairs whose sets may overlap by the threshold, by how many tokens each has in every bucket: no bucket shares more than the fewer."""
    own = lambda x, k: x.select(F.col("id").alias(f"id_{k}"), F.size("t").alias(f"n_{k}"), F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.size(F.filter("t", lambda h: F.pmod(h, F.lit(BUCKETS)) == i)).cast("short")).alias(f"g_{k}"))
    both = pairs.join(own(a, "a"), "id_a").join(own(b, "b"), "id_b")
    common = F.aggregate(F.zip_with("g_a", "g_b", lambda x, y: F.least(x, y)), F.lit(0), lambda n, v: n + v)
    return both.filter(common >= _need(threshold)).select("id_a", "id_b")


def _verified(pairs: DataFrame, a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """id_a, id_b, n_common, jaccard of those candidates whose sets overlap by the threshold."""
    return compared(_bounded(pairs, a, b, threshold), a, b, threshold)  # sets are many times as long


def compared(pairs: DataFrame, a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """id_a, id_b, n_common, jaccard of those pairs whose sets overlap by the threshold."""
    a, b = (x.select(F.col("id").alias(f"id_{k}"), F.col("t").alias(f"t_{k}")) for x, k in ((a, "a"), (b, "b")))
    both = pairs.join(a, "id_a").join(b, "id_b").withColumn("n_common", F.size(F.array_intersect("t_a", "t_b")))
    both = both.withColumn("jaccard", F.col("n_common") / (F.size("t_a") + F.size("t_b") - F.col("n_common")))
    return both.filter(F.col("jaccard") >= threshold).select("id_a", "id_b", F.col("n_common").cast("long"), "jaccard")


def _side(prefix: DataFrame, x: str) -> DataFrame:
    return prefix.withColumnsRenamed({"id": f"id_{x}", "n": f"n_{x}", "i": f"i_{x}"})


def hashed(block: list[str], tokens: str) -> Column:
    """A row's distinct tokens as 64-bit hashes in order; rows of two blocks share none."""
    of_block = [F.col(b) for b in block] if len(block) == 1 else [x for i, b in enumerate(block) for x in (F.col(b), F.lit(i))]
    return F.sort_array(F.array_distinct(F.transform(tokens, lambda x: F.xxhash64(x, *of_block))))


#: Ids that may be broadcast to pick out sets, many times as long, without a shuffle of all of them.
BROADCAST_IDS = 1_000_000


def _some(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets of some ids."""
    return sets.join(broadcast_if(ids.distinct(), BROADCAST_IDS), "id", "left_semi")


#: Members of a family that meet those of another part of it in one group.
FAMILY_PART = 512


def meeting_signatures(signed: DataFrame) -> DataFrame:
    """The signatures that several sets have, one of them in its own class, with the least id that has each (``first``)."""
    w = W.partitionBy("sig")
    all_of = {"_many": F.count("*").over(w), "_own": F.max("own").over(w), "first": F.min("id").over(w)}
    return cut(signed.withColumns(all_of).filter("_many > 1 and _own").drop("_many", "_own"), "met")


def _families(met: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """id, n, head, plus, minus: sets that are near their head, the least set of most of their signatures, and what they have more and less than it.

    A family's members are told apart by these few tokens; those that no head is near are no member of any."""
    votes = met.groupBy("id", "first").agg(F.count("*").alias("_v"), F.max("depth").alias("_d")).filter("_v >= _d")
    heads = cut(votes.groupBy("id").agg(F.max_by("first", F.struct("_v", "first")).alias("head")).filter("head <> id"), "heads")
    of = _some(sets, heads.select(F.col("head").alias("id"))).select(F.col("id").alias("head"), F.col("t").alias("_t"))
    near = sets.join(broadcast_if(heads, BROADCAST_IDS), "id").join(of, "head").select("id", F.size("t").alias("n"), "head", F.array_except("t", "_t").alias("plus"), F.array_except("_t", "t").alias("minus"))
    near = cut(near.filter(F.size("plus") + F.size("minus") <= F.col("n") * (1 - threshold) / threshold), "near")
    none = F.array().cast("array<long>")
    alone = _some(sets.select("id", F.size("t").alias("n")), near.select(F.col("head").alias("id"))).join(near.select("id"), "id", "left_anti")
    return near.unionByName(alone.select("id", "n", F.col("id").alias("head"), none.alias("plus"), none.alias("minus")))


def _within(families: DataFrame, threshold: float, part: int) -> DataFrame:
    """id_a, id_b, n_common, jaccard of the members of each family, in parts of about so many that all meet each other."""
    parts = families.groupBy("head").agg(F.ceil(F.count("*") / part).cast("int").alias("_p")).filter("_p > 0")
    dealt = families.join(parts, "head").withColumn("_i", F.pmod(F.hash("id"), F.col("_p")))
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "plus", "minus")]
    a = dealt.select("head", "_i", F.explode(F.sequence("_i", F.col("_p") - 1)).alias("_j"), *side("a"))
    b = dealt.select("head", F.explode(F.sequence(F.lit(0), "_i")).alias("_i"), F.col("_i").alias("_j"), *side("b"))
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    met = a.join(b, ["head", "_i", "_j"]).filter((F.col("_i") < F.col("_j")) | (F.col("id_a") < F.col("id_b"))).filter(least >= most * threshold - 1e-9)
    # what both have: all of a, less what it has more than the head and b hasn't, less what b lacks of the head and a has
    lost = F.size(F.array_except("minus_b", "minus_a")) + F.size(F.array_except("plus_a", "plus_b"))
    met = met.select("id_a", "id_b", (F.col("n_a") - lost).cast("long").alias("n_common"), (F.col("n_a") + F.col("n_b")).alias("_n"))
    met = met.withColumn("jaccard", F.col("n_common") / (F.col("_n") - F.col("n_common"))).filter(F.col("jaccard") >= threshold)
    return met.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "n_common", "jaccard")


def side_of(met: DataFrame, sets: DataFrame, x: str, families: DataFrame | None = None) -> DataFrame:
    """Signatures of sets with their bitmaps and, if any, heads, as one side (``x``) of a join."""
    each = bitmaps(sets)
    each = each.withColumn("head", F.col("id")) if families is None else each.join(families.select("id", F.col("head").alias("_h")), "id", "left").withColumn("head", F.coalesce("_h", "id")).drop("_h")
    out = met.select("id", "n", "sig", "own", "depth").join(each, "id")
    return out.select(*(F.col(c).alias(f"{c}_{x}") for c in out.columns))


def candidates(a: DataFrame, b: DataFrame, on: Column, threshold: float) -> DataFrame:
    """id_a, id_b, once each, of two sides of signatures that have enough of them in common. Where their sizes or bitmaps differ too much they
    never meet, so that few rows are shuffled however often unlike sets share a signature."""
    fits = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * threshold - 1e-9
    differ = sum((F.bit_count(F.col(f"w{i}_a").bitwiseXOR(F.col(f"w{i}_b"))) for i in range(WORDS)), F.lit(0))
    near = differ <= F.floor((F.col("n_a") + F.col("n_b")) * (1 - threshold) / (1 + threshold) + 1e-9)
    met = a.join(b, (F.col("sig_a") == F.col("sig_b")) & on & (F.col("own_a") | F.col("own_b")) & fits & near)
    return met.groupBy("id_a", "id_b").agg(F.count("*").alias("_m"), F.max("depth_a").alias("_d")).filter("_m >= _d").select("id_a", "id_b")


def set_pairs(sets: DataFrame, met: DataFrame, threshold: float, part: int = FAMILY_PART) -> DataFrame:
    """id_a, id_b, n_common, jaccard of sets (id, t: hashed tokens) that overlap by the threshold, from their meeting_signatures().

    Near copies of one text are a family: they meet each other by it, once, with what tells them from its head. All other pairs
    meet by their signatures, and only those that may overlap are compared whole."""
    families = cut(_families(met, sets, threshold), "families")
    apart = (F.col("id_a") < F.col("id_b")) & (F.col("head_a") != F.col("head_b"))
    pairs = cut(candidates(side_of(met, sets, "a", families), side_of(met, sets, "b", families), apart, threshold), "candidates")
    return compared(pairs, *(_some(sets, pairs.select(F.col(f"id_{x}").alias("id"))) for x in "ab"), threshold).unionByName(_within(families, threshold, part))


def hashed_pairs(rows: DataFrame, id_column: str, tokens: str, threshold: float) -> DataFrame:
    """overlap_pairs() of rows on file whose tokens are hashed() already, as those of collapsed() are."""
    sets = rows.select(F.col(id_column).alias("id"), F.col(tokens).alias("t")).filter(F.size("t") > 0)
    return set_pairs(sets, meeting_signatures(signatures(sets, threshold, frequent(sets))), threshold)


def overlap_pairs(rows: DataFrame, block: list[str], id_column: str, tokens: str, threshold: float) -> DataFrame:
    """id_a, id_b, n_common, jaccard of rows of one block whose distinct tokens overlap by the threshold (ids differ).

    From ``BY_SIGNATURES`` on by signatures of several tokens (set_pairs). Below, these would be single tokens, so prefixes are
    joined: of two sets that overlap so far, the first tokens in one order must meet; sizes and places of the common tokens bound
    the overlap before the sets themselves meet."""
    if threshold >= BY_SIGNATURES:
        return hashed_pairs(cut(rows.select(id_column, hashed(block, tokens).alias(tokens)), "sets"), id_column, tokens, threshold)
    sets = cut(ordered_sets(rows, block, id_column, tokens), "sets")
    prefix = prefixes(sets, block, threshold)
    other = _side(prefix, "b").withColumnsRenamed({b: f"_b_{b}" for b in block} | {"token": "_token"})
    met = _side(prefix, "a").join(other, _same(block, F.col("token") == F.col("_token"))).filter("id_a < id_b")
    return _verified(_candidates(met, threshold), sets, sets, threshold)


#: Open links, of 17 bytes each, that are settled by one task.
GATHERED = 500_000


def _in_order(links: pd.DataFrame) -> pd.DataFrame:
    """Whether each open row (id_b) is kept, from its smaller matches (id_a) and what is known of them (_k)."""
    kept: dict = {}
    for row, matches in links.sort_values(["id_b", "id_a"]).groupby("id_b", sort=True):
        kept[row] = not any(kept.get(a, False) if k is None or k != k else bool(k) for a, k in zip(matches.id_a, matches._k, strict=True))
    return pd.DataFrame({"id": list(kept), "_new": list(kept.values())})


def greedy_groups(pairs: DataFrame, members: DataFrame, gathered: int = GATHERED) -> DataFrame:
    """id, kept, duplicate_of: in id order a row is dropped if it matches a kept one (the least such); dropped rows match nothing.

    While more than ``GATHERED`` links are open, in rounds over the linked rows: one is dropped once a smaller match is kept, and
    kept once all its smaller ones are dropped; the least open row of every connected part is settled each round, most rows in
    the first ones. What is left then, however long its chains, is settled in order by one task."""
    links = cut(pairs.select("id_a", "id_b"), "links")
    smaller = links.groupBy(F.col("id_b").alias("id")).agg(F.count("*").alias("_n"))
    ends = links.select(F.col("id_a").alias("id")).unionByName(links.select(F.col("id_b").alias("id"))).distinct()
    state = cut(ends.join(smaller, "id", "left").select("id", F.when(F.col("_n").isNull(), True).alias("kept")), "greedy")
    while True:
        open_ = links.join(state.filter("kept is null").select(F.col("id").alias("id_b")), "id_b", "left_semi")
        left = open_.count()
        if not left:
            break
        met = open_.join(state.select(F.col("id").alias("id_a"), F.col("kept").alias("_k")), "id_a")
        if left <= gathered:
            new = met.groupBy(F.lit(0).alias("_one")).applyInPandas(_in_order, f"id {links.schema['id_b'].dataType.simpleString()}, _new boolean")
        else:
            settled = met.groupBy(F.col("id_b").alias("id")).agg(F.max(F.coalesce("_k", F.lit(False))).alias("_dropped"), F.min(F.col("_k").isNotNull()).alias("_all"))
            new = settled.select("id", F.when(F.col("_dropped"), False).when(F.col("_all"), True).alias("_new"))
        state = cut(state.join(new, "id", "left").select("id", F.coalesce("kept", "_new").alias("kept")), "greedy")
    of = links.join(state.filter("kept").select(F.col("id").alias("id_a")), "id_a", "left_semi").groupBy(F.col("id_b").alias("id")).agg(F.min("id_a").alias("_of"))
    out = members.select("id").join(state, "id", "left").join(of, "id", "left").withColumn("kept", F.coalesce("kept", F.lit(True)))
    return out.select("id", "kept", F.when(~F.col("kept"), F.col("_of")).alias("duplicate_of"))


def collapsed(rows: DataFrame, block: list[str], id_column: str, tokens: str) -> tuple[DataFrame, DataFrame]:
    """The rows with the least id of each set of tokens in a block, with hashed() tokens, and (first, id, n) of all rows; rows without tokens
    stay by themselves. Rows are read, and their tokens made, once."""
    sets = cut(rows.select(*block, id_column, hashed(block, tokens).alias(tokens)), "tokens")
    alone = F.when(F.size(tokens) > 0, F.lit(None)).otherwise(F.col(id_column))
    code = F.struct(F.xxhash64(tokens), F.xxhash64(F.lit(1), tokens))
    keys = sets.select(*block, F.col(id_column).alias("id"), F.when(F.size(tokens) > 0, code).alias("_h"), alone.alias("_a"), F.greatest(F.size(tokens), F.lit(0)).alias("n"))
    w = W.partitionBy(*block, "n", "_h", "_a")
    copies = cut(keys.select(F.min("id").over(w).alias("first"), "id", "n"), "copies")
    later = copies.groupBy(F.col("id").alias(id_column)).agg(F.max(F.col("first") == F.col("id")).alias("_f")).filter("not _f").drop("_f")
    firsts = cut(sets.join(broadcast_if(later, BROADCAST_IDS), id_column, "left_anti"), "firsts")
    discard(sets)
    return firsts, copies


def spread_pairs(pairs: DataFrame, copies: DataFrame) -> DataFrame:
    """Pairs of first rows as pairs of all their copies, with those among the copies of one row."""
    a, b = (copies.select(F.col("first").alias(f"first_{x}"), F.col("id").alias(x)) for x in "ab")
    met = pairs.withColumnsRenamed({"id_a": "first_a", "id_b": "first_b"}).join(a, "first_a").join(b, "first_b")
    met = met.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"), "n_common", "jaccard")
    other = copies.select("first", F.col("id").alias("id_b"))
    own = copies.filter("n > 0").join(other, "first").filter("id < id_b")
    return met.unionByName(own.select(F.col("id").alias("id_a"), "id_b", F.col("n").cast("long").alias("n_common"), F.lit(1.0).alias("jaccard")))


def star_pairs(pairs: DataFrame, copies: DataFrame) -> DataFrame:
    """Pairs of first rows, and each copy with its first row: all that spread_pairs says, in a row for each copy instead of each pair."""
    own = copies.filter("n > 0 and id <> first")
    return pairs.unionByName(own.select(F.col("first").alias("id_a"), F.col("id").alias("id_b"), F.col("n").cast("long").alias("n_common"), F.lit(1.0).alias("jaccard")))


def spread_groups(groups: DataFrame, copies: DataFrame) -> DataFrame:
    """Greedy groups of first rows for all their copies: a copy is dropped for its first row, or for what that was dropped for."""
    out = copies.join(groups.withColumnRenamed("id", "first"), "first")
    of = F.when(F.col("kept"), F.when(F.col("id") != F.col("first"), F.col("first"))).otherwise(F.col("duplicate_of"))
    return out.select("id", (F.col("kept") & (F.col("id") == F.col("first"))).alias("kept"), of.alias("duplicate_of"))


def new_arrivals(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return rows.join(known.select(key).distinct(), key, "left_anti")
