"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only.

A document's size is its number of ``[^\\x20\\x09-\\x0D]+``. Sources, by code point and null last, weigh ``weights`` in
turn and share all sizes; a target stops at ``max_repeats`` times its source's size and the excess goes to the others by
weight until none is above. A source's documents, in the order of md5(doc_id), lie end to end on the axis of its demand,
stretched to its target: a document takes the whole words of its stretch, at most ``max_repeats`` times its own.

While training runs from 0 to 1, a source's rate is ``target * (1 + a * (2t - 1))`` with slopes a from -1/2 for the first
source to 1/2 for the last. Integrated, the demand up to t is ``target * (t + a * (t^2 - t))``; inverting that at the
start of each stretch gives the document's position, by which the result is range-sorted. A document taken several times
has a position for each time: the starts of its words laid end to end in its stretch.

The running sum within a source is split in ``16 ** HEX`` buckets of the md5 order, so a source of a third of all rows is
no single task; results do not depend on the number of buckets.

Nulls: a null text has size 0; null is a source of its own; a null doc_id goes first in its source. Rows that repeat are
documents of their own; ones alike in doc_id and size are interchangeable. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.llm._spark import cut

WEIGHTS, MAX_REPEATS, HEX = (5, 2, 1), 3, 3
SPACES = r"[\x20\x09-\x0D]+"


def size(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target, slope from sizes(source, size): a row a source; windows over sources only."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = W.orderBy(F.col("source").asc_nulls_last())
    whole = W.partitionBy()
    turn = (F.row_number().over(every) - 1) % len(weights)
    ranked = by_source.select("*", F.get(F.array(*map(F.lit, weights)), turn).cast("long").alias("weight"), (F.row_number().over(every) - 1).alias("rank"), F.count("*").over(whole).alias("n"), F.sum("source_size").over(whole).alias("all"))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_repeats)
    by_fill = W.orderBy(F.col("cap") / F.col("weight"), "rank")  # the sources that reach their cap first
    before, after = by_fill.rowsBetween(W.unboundedPreceding, -1), by_fill.rowsBetween(0, W.unboundedFollowing)
    level = (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / F.sum("weight").over(after)
    filled = ranked.withColumn("level", level).withColumn("place", F.row_number().over(by_fill))
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("place"))
    last = filled.withColumn("last", F.min_by("level", free).over(whole))
    slope = F.when(F.col("n") > 1, F.col("rank").cast("double") / (F.col("n") - 1) - 0.5).otherwise(0.0)
    return last.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("last") * F.col("weight")).alias("target"), slope.alias("slope"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, position, positions of each row of docs(doc_id, source, text), by position.

    positions has one for each time that a document is read, none if it isn't; position is that of its stretch.
    """
    order = F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit(""))
    rows = cut(docs.select("doc_id", "source", size(F.col("text")).alias("size"), order.alias("order"), F.substring(order, 1, HEX).alias("bucket")), "sizes")
    goal = targets(rows, weights, max_repeats)
    offsets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("own"))
    offsets = offsets.select(F.col("source").alias("s"), F.col("bucket").alias("b"), (F.sum("own").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("own")).alias("offset"))
    offsets = offsets.join(goal, offsets.s.eqNullSafe(goal.source)).drop("source")
    running = F.sum("size").over(W.partitionBy("source", "bucket").orderBy("order", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    laid = rows.withColumn("before", running)
    laid = laid.join(offsets, laid.source.eqNullSafe(offsets.s) & (laid.bucket == offsets.b)).withColumn("start", F.col("offset") + F.col("before"))
    stretch = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    taken = F.least(F.floor(stretch * (F.col("start") + F.col("size"))) - F.floor(stretch * F.col("start")), F.col("size") * max_repeats)
    inverse = lambda u: 2 * u / ((1 - F.col("slope")) + F.sqrt((1 - F.col("slope")) * (1 - F.col("slope")) + 4 * F.col("slope") * u))
    u = F.when(F.col("source_size") > 0, F.col("start") / F.col("source_size")).otherwise(0.0)
    laid = laid.select("doc_id", "source", "size", "source_size", "target", "slope", taken.cast("long").alias("taken"), u.alias("u"))
    times = F.when(F.col("taken") > 0, F.sequence(F.lit(0), (F.ceil(F.col("taken") / F.col("size")) - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    each = F.transform(times, lambda i: inverse(F.col("u") + i * F.col("size") / F.col("target")))
    out = laid.select("doc_id", "source", "size", "source_size", "target", "taken", inverse(F.col("u")).alias("position"), each.alias("positions"))
    return out.orderBy("position", "doc_id")


def training_order(mixed: DataFrame) -> DataFrame:
    """A row for each time that a document of mix() is read, range-sorted by its position (``at``); unread ones have none."""
    return mixed.select("*", F.explode("positions").alias("at")).orderBy("at", "doc_id")
