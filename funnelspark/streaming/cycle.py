"""Cycles over a feed of state changes: a fold into a table of latest states, a retry ladder per entity, windowed funnels.

One cycle is one micro-batch. Batches are idempotent: a state row carries the sequence number it comes from, and a batch
that is run again after a failure changes nothing. The batch twins give the same rows from all events at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from funnelspark.operators.ranking import latest

#: Life of an entity: where each state may lead.
TRANSITIONS = {
    "new": {"screening"},
    "screening": {"screened", "failed"},
    "screened": {"deduped", "filtered_out", "selected"},
    "selected": {"queued"},
    "queued": {"running", "failed"},
    "running": {"done", "failed", "queued"},
}


def allowed(before: F.Column, after: F.Column) -> F.Column:
    """Whether a change of state is one of TRANSITIONS; an entity begins as new."""
    pairs = [f"{a}>{b}" for a, bs in TRANSITIONS.items() for b in sorted(bs)]
    return F.concat_ws(">", F.coalesce(before, F.lit("new")), after).isin(*pairs)


def fold(events: DataFrame, key: str, seq: str, columns: list[str]) -> DataFrame:
    """Batch twin: the newest row of each key."""
    return latest(events, [key], seq, [seq, *columns])


BUCKETS = 64


def state_of(spark: SparkSession, table: str, before: int | None = None) -> DataFrame | None:
    """The rows of a table of states: of every bucket those of its newest batch (before a batch, if given); None where there are none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = spark.read.parquet(table)
    rows = rows if before is None else rows.filter(F.col("batch") < before)
    newest = rows.groupBy("bucket").agg(F.max("batch").alias("batch"))  # at most BUCKETS rows
    return rows.join(F.broadcast(newest), ["bucket", "batch"]).drop("bucket", "batch")


def run_cycles(feed: DataFrame, table: str, checkpoint: str, key: str, seq: str, columns: list[str], once: bool = True, buckets: int = BUCKETS):
    """Folds a streaming feed into a Parquet table of latest states, read by state_of; with ``once`` it ends when the feed is used up.

    A batch writes a new version of the buckets that its keys fall in, named by its number, from the versions before it; a
    batch that is run again writes the same folders again, and what was there before it stays until it is through."""

    def cycle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        new = latest(batch, [key], seq, [seq, *columns]).withColumn("bucket", bucket).persist()
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        if touched:
            old = state_of(spark, table, batch_id)
            both = new if old is None else old.withColumn("bucket", bucket).filter(F.col("bucket").isin(touched)).select(*new.columns).unionByName(new)
            merged = latest(both, ["bucket", key], seq, [seq, *columns]).withColumn("batch", F.lit(batch_id))
            merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(table)
            _forget(spark, table, touched, batch_id)
        new.unpersist()

    writer = feed.writeStream.foreachBatch(cycle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def _forget(spark: SparkSession, table: str, touched: list[int], batch_id: int) -> None:
    """Deletes all but the two newest versions of the buckets that a batch has written."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for b in touched:
        path = jvm.org.apache.hadoop.fs.Path(f"{table}/bucket={b}")
        fs = path.getFileSystem(conf)
        versions = sorted(((int(x.getPath().getName().split("=")[1]), x.getPath()) for x in fs.listStatus(path)), key=lambda v: v[0])
        for _, old in versions[:-2]:
            fs.delete(old, True)


LADDER = "key string, seq long, state string, attempt int, action string"
LADDER_COLUMNS = ["key", "seq", "state", "attempt", "action"]


def _climb(key: str, rows: pd.DataFrame, state: str, attempt: int, most: int) -> tuple[list[tuple], str, int]:
    out = []
    for seq, what in rows.sort_values("seq")[["seq", "state"]].itertuples(index=False):
        action = None
        if what == "failed":
            attempt += 1
            action = "retry" if attempt < most else "give_up"
        elif what == "done":
            attempt, action = 0, "finish"
        state = what
        out.append((key, seq, state, attempt, action))
    return out, state, attempt


def retry_ladder(feed: DataFrame, most: int = 3) -> DataFrame:
    """key, seq, state, attempt, action of a stream of (key string, seq long, state string), in order of seq within a batch."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        state, attempt = held.get if held.exists else ("new", 0)
        out, state, attempt = _climb(key[0], pd.concat(parts), state, attempt, most)
        held.update((state, attempt))
        yield pd.DataFrame(out, columns=LADDER_COLUMNS)

    return feed.groupBy("key").applyInPandasWithState(step, LADDER, "state string, attempt int", "append", GroupStateTimeout.NoTimeout)


def retry_ladder_batch(events: DataFrame, most: int = 3) -> DataFrame:
    """Batch twin of retry_ladder, by running counts: failures since the last success."""
    from pyspark.sql import Window as W

    w = W.partitionBy("key").orderBy("seq")
    runs = events.withColumn("_run", F.sum(F.when(F.col("state") == "done", 1).otherwise(0)).over(w))
    own = W.partitionBy("key", "_run").orderBy("seq")
    attempt = F.sum(F.when(F.col("state") == "failed", 1).otherwise(0)).over(own).cast("int")
    runs = runs.withColumn("attempt", F.when(F.col("state") == "done", F.lit(0)).otherwise(attempt))
    action = F.when(F.col("state") == "failed", F.when(F.col("attempt") < most, "retry").otherwise("give_up")).when(F.col("state") == "done", "finish")
    return runs.select("key", "seq", "state", "attempt", action.alias("action"))


def windowed_funnel(feed: DataFrame, time: str, gate: str, passed: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """window start, gate, seen, passed; on a stream, events later than ``late`` are dropped by the watermark."""
    rows = feed.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), gate)
    return rows.agg(F.count("*").alias("seen"), F.sum(F.when(F.col(passed), 1).otherwise(0)).alias("passed")).select(F.col("w.start").alias("start"), gate, "seen", "passed")


def feed_of(spark: SparkSession, path: str, files_per_cycle: int = 1) -> DataFrame:
    """A stream of the Parquet files of a folder (or a single file), a few a cycle, with the schema they have now."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_cycle)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():  # a stream reads folders
        return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return reader.parquet(path)
