"""Hulls kept up to date: only the systems that a batch of entries touches are placed again.

Entries and placements live in one store of snapshots, in buckets by system. A batch reads the buckets of its systems, places
those systems anew, keeps the rows of the others as they are and commits both tables at once; files of other buckets are neither
read nor written. A batch that runs again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.operators.ranking import latest
from funnelspark.sources.folders import cut
from funnelspark.sources.snapshots import Parts, Snapshots

BUCKETS = 64


def bucket_of(sys: str = "sys", buckets: int = BUCKETS) -> F.Column:
    return F.pmod(F.xxhash64(sys), F.lit(buckets)).cast("int")


def absorb(store: Snapshots, batch: DataFrame, number: int, place: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> list[int]:
    """Takes a batch of entries(id, sys, seq, ..) in: of an id (in its system) the last by seq counts. The buckets it touched.

    place makes the placements, with the columns id and sys, of all entries of some systems."""
    store = Snapshots(batch.sparkSession, store.folder, store.keep)  # a stream's batches have a session of their own
    new = cut(batch.filter("sys is not null").withColumn("bucket", bucket_of(buckets=buckets)), "arrivals")
    touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        return []
    have = store.read("entries", parts=touched)
    rows = new if have is None else have.unionByName(new.select(have.columns))
    columns = [c for c in rows.columns if c not in ("sys", "id", "bucket")]
    entries = cut(latest(rows, ["bucket", "sys", "id"], "seq", columns).select(new.columns), "entries")
    dirty = new.select(F.col("sys").alias("_dirty")).distinct()
    placed = place(entries.join(dirty, entries.sys == dirty._dirty, "left_semi").drop("bucket")).withColumn("bucket", bucket_of(buckets=buckets))
    before = store.read("placements", parts=touched)
    if before is not None:
        placed = placed.unionByName(before.join(dirty, before.sys == dirty._dirty, "left_anti").select(placed.columns))
    store.commit({"entries": Parts(entries, "bucket", touched), "placements": Parts(placed, "bucket", touched)}, batch=number)
    return touched


def keep_placed(feed: DataFrame, store: Snapshots, checkpoint: str, place: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS):
    """Runs absorb() for each micro-batch of a stream of entries until the feed is used up."""
    writer = feed.writeStream.foreachBatch(lambda batch, number: absorb(store, batch, number, place, buckets) and None)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
