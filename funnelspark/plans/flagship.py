"""The flagship query: hull placement, gates with events, cap after cut, and each survivor's events beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.plans.bindings import Tables, cascade


def selected_parts(spark: SparkSession, folder: str) -> DataFrame:
    capped, events = cascade(Tables(spark, folder))
    kept = capped.filter("kept").select("p_partkey", "p_type", "e_above_hull", "rank")
    gates = events.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "gate", F.col("passed").cast("string")))), ", ").alias("gates"))
    return kept.join(gates, F.col("id") == F.col("p_partkey")).drop("id").orderBy("e_above_hull", "p_partkey")
