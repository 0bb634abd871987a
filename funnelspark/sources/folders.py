"""Where jobs may put files that every executor sees, and tables that cut a plan there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, a temporary one on a single machine and an error on a cluster."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.conf.get("funnelspark.shared.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="funnelspark-")  # one for the session
        spark.conf.set("funnelspark.shared.dir", folder)
    return folder


def cut(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back, where a plan is used several times or grows round by round."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(table: DataFrame) -> None:
    """Deletes a table of cut() that nothing needs any more."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._cut_path)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint on a frame of numbers and short keys if it has at most so many rows."""
    return F.broadcast(df) if df.count() <= rows else df
