"""Small helpers on sessions: reading tables, cutting lineage into the shared folder, checked broadcasts, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch that goes to a Python worker; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, a temporary one on a single machine and an error on a cluster."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.conf.get("funnelspark.shared.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="funnelspark-")
        spark.conf.set("funnelspark.shared.dir", folder)
    return folder


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: later steps, and retries after a lost executor, start there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of cut() that nothing needs any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._cut_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if(df: DataFrame, rows: int, row_bytes: int = 64) -> DataFrame:
    """The frame with a broadcast hint if it has at most so many rows, and so many bytes a row in columns of no fixed width
    on average, else as it is, to be joined by a shuffle. Rows and bytes are counted by tasks, nothing is gathered."""
    sizes = []
    for f in df.schema:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            sizes.append(F.octet_length(F.col(f"`{f.name}`")))
        elif kind in ("array", "map", "struct"):
            sizes.append(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))))
    width = sum((F.coalesce(s, F.lit(0)) for s in sizes), F.lit(0).cast("long"))
    got = df.agg(F.count("*").alias("n"), F.sum(width).alias("bytes")).first()
    return F.broadcast(df) if got.n <= rows and (got.bytes or 0) <= rows * row_bytes else df


def small_batches(spark: SparkSession) -> None:
    """Bounds the bytes of Arrow batches, by default 64 MB, so that a worker's arrays stay small however long the rows are."""
    now = spark.conf.get(_BYTES, "64m").lower()
    units = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    number, unit = (now[:-1], now[-1]) if now[-1] in units else (now, "b")
    if int(number) < 0 or int(number) * units[unit] > BATCH_BYTES:
        spark.conf.set(_BYTES, f"{BATCH_BYTES}b")
