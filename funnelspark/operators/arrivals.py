"""Near duplicates among arrivals and against a pool that grows: the pool's index stays on file and is probed, not rebuilt.

The pool is a store of snapshots with two tables, a part for each batch: ``pool`` (sets of tokens) and ``index`` (their
signatures). How often tokens are is fixed by the first batch, so signatures never change; tokens it hadn't count as rare. A
batch meets the index by its own signatures, and what nothing kept matches then meets itself; what is kept goes into the pool, in
the same commit as the verdicts. Batches in the order of their ids give what one greedy pass over all rows gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.operators.dedup import _some, candidates, collapsed, compared, greedy_groups, meeting_signatures, set_pairs, side_of, spread_groups
from funnelspark.operators.signatures import frequent, signatures
from funnelspark.sources.folders import cut
from funnelspark.sources.snapshots import Parts, Snapshots

POLICIES = ("drop", "warn", "off")


def absorb(store: Snapshots, batch: DataFrame, number: int, block: list[str], id_column: str, tokens: str, threshold: float, policy: str = "drop") -> DataFrame:
    """Takes rows in; the table ``verdicts`` (id, kept, duplicate_of, batch) of all batches so far.

    drop: a row that matches a kept one before it isn't kept, nor matched by others. warn: all are kept, duplicate_of is the least
    match. off: nothing is compared. Rows without tokens are kept. Ids are unique over all batches and rise from batch to batch."""
    if policy not in POLICIES:
        raise ValueError(f"no such policy: {policy}")
    spark = batch.sparkSession
    store = Snapshots(spark, store.folder, store.keep)
    batch, copies = collapsed(batch, block, id_column, tokens)  # rows of equal tokens meet through the first of them
    members = batch.select(F.col(id_column).alias("id"), F.col(tokens).alias("t"))
    sets, members = members.filter(F.size("t") > 0), members.select("id")
    often = store.read("often")
    first = often is None
    if first:
        often = spark.createDataFrame(frequent(sets), "token long, weight int")
    signed = cut(signatures(sets, threshold, [tuple(r) for r in often.collect()]).withColumn("new", F.lit(True)), "signed")
    state = members.select("id", F.lit(True).alias("kept"), F.lit(None).cast(members.schema["id"].dataType).alias("duplicate_of"))
    if policy != "off":
        known, matched = store.read("index"), None
        met = meeting_signatures(signed if known is None else signed.unionByName(known.drop("batch").withColumn("new", F.lit(False))))
        if known is not None:
            pool = store.read("pool")
            pairs = cut(candidates(side_of(met.filter("not new"), pool, "a"), side_of(met.filter("new"), sets, "b"), F.lit(True), threshold), "probed")
            matched = cut(compared(pairs, _some(pool, pairs.select(F.col("id_a").alias("id"))), _some(sets, pairs.select(F.col("id_b").alias("id"))), threshold).groupBy(F.col("id_b").alias("id")).agg(F.min("id_a").alias("of")), "matched")
            met = met.filter("new")
            if policy == "drop":  # these are out, and match nothing
                met = met.join(matched.select("id"), "id", "left_anti")
            met = met.withColumn("first", F.min("id").over(W.partitionBy("sig")))
        own = set_pairs(sets if matched is None or policy == "warn" else sets.join(matched.select("id"), "id", "left_anti"), met, threshold)
        if policy == "warn":
            own = own.groupBy(F.col("id_b").alias("id")).agg(F.min("id_a").alias("of"))
            every = own if matched is None else own.unionByName(matched)
            state = members.join(every.groupBy("id").agg(F.min("of").alias("duplicate_of")), "id", "left").select("id", F.lit(True).alias("kept"), "duplicate_of")
        else:
            state = greedy_groups(own, members)
            if matched is not None:
                state = state.join(matched, "id", "left").select("id", (F.col("kept") & F.col("of").isNull()).alias("kept"), F.coalesce("of", "duplicate_of").alias("duplicate_of"))
    state = cut(state, "verdicts")
    kept = state.filter("kept").select("id")
    if policy == "drop":
        state = spread_groups(state, copies)
    elif policy == "warn":
        every = copies.join(state.withColumnRenamed("id", "first"), "first")
        state = every.select("id", "kept", F.coalesce("duplicate_of", F.when(F.col("id") != F.col("first"), F.col("first"))).alias("duplicate_of"))
    else:
        state = copies.select("id", F.lit(True).alias("kept"), F.lit(None).cast(state.schema["id"].dataType).alias("duplicate_of"))
    part = lambda df: Parts(df.withColumn("batch", F.lit(number)), "batch", [number])
    changes: dict[str, DataFrame | Parts] = {"verdicts": part(state), "pool": part(sets.join(kept, "id", "left_semi").select(*sets.columns)), "index": part(signed.drop("new").join(kept, "id", "left_semi"))}
    if first:
        changes["often"] = often
    store.commit(changes, batch=number)
    return store.read("verdicts")
