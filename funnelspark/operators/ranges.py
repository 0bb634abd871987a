"""Joins by order: the nearest break at or below and above a value, in a group, and what lies between them.

Rows and breaks are laid in one order and dealt over range partitions, so a group, or a value, of any size is spread; inside
a partition the last break is carried along, and the last one of the partitions before is carried over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.sources.folders import cut


def bracket(rows: DataFrame, breaks: DataFrame, group: list[str], at: str) -> DataFrame:
    """Adds ``low`` and ``high`` to rows: the break of the row's group at or below its value, the last such, and the first one above.

    Structs of all columns of breaks, null where there is none. Of breaks of equal value the least (by their columns) counts for
    both. Rows of a null value have neither; null groups are a group."""
    payload = F.struct(*breaks.columns)
    lone = breaks.filter(F.col(at).isNotNull()).groupBy(*group, at).agg(F.min(payload).alias("_break"))
    kind = lone.schema["_break"].dataType
    kept = F.struct(*rows.columns)
    left = rows.select(*group, F.col(at).alias(at), F.lit(1).alias("_row"), F.xxhash64(*rows.columns).alias("_salt"), kept.alias("_kept"), F.lit(None).cast(kind).alias("_break"))
    right = lone.select(*group, at, F.lit(0).alias("_row"), F.lit(0).cast("long").alias("_salt"), F.lit(None).cast(left.schema["_kept"].dataType).alias("_kept"), "_break")
    whole = left.unionByName(right)
    spread = cut(whole.repartitionByRange(*group, at, "_row", "_salt").withColumn("_part", F.spark_partition_id()), "ranges")
    own = W.partitionBy(*group, "_part").orderBy(at, "_row")
    spread = spread.withColumn("_low", F.last("_break", ignorenulls=True).over(own.rowsBetween(W.unboundedPreceding, 0)))
    # upwards from the end: a frame that ends there is read anew for every row
    back = W.partitionBy(*group, "_part").orderBy(F.desc(at), F.desc("_row"))
    spread = spread.withColumn("_high", F.last("_break", ignorenulls=True).over(back.rowsBetween(W.unboundedPreceding, 0)))
    # the ends of every partition of a group, to those after and before it
    ends = spread.filter("_row = 0").groupBy(*group, "_part").agg(F.max_by("_break", at).alias("_last"), F.min_by("_break", at).alias("_first"))
    parts = spread.select(*group, "_part").distinct().join(ends.withColumnsRenamed({g: f"_g_{g}" for g in group} | {"_part": "_p"}), _same(group, F.col("_part") == F.col("_p")), "left")
    order = W.partitionBy(*group).orderBy("_part")
    carried = parts.select(
        *(F.col(g).alias(f"_g_{g}") for g in group), F.col("_part").alias("_p"),
        F.last("_last", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)).alias("_before"),
        F.last("_first", ignorenulls=True).over(W.partitionBy(*group).orderBy(F.desc("_part")).rowsBetween(W.unboundedPreceding, -1)).alias("_after"))
    met = spread.filter("_row = 1").join(carried, _same(group, F.col("_part") == F.col("_p")), "left")
    found = F.col(at).isNotNull()
    return met.select("_kept.*", F.when(found, F.coalesce("_low", "_before")).alias("low"), F.when(found, F.coalesce("_high", "_after")).alias("high"))


def _same(group: list[str], also: Column) -> Column:
    for g in group:
        also = also & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return also


def as_of(rows: DataFrame, breaks: DataFrame, group: list[str], at: str, columns: list[str]) -> DataFrame:
    """Adds columns of the last break at or before each row's value, nulls where there is none."""
    met = bracket(rows, breaks.select(*group, at, *columns), group, at)
    return met.select(*rows.columns, *(F.col("low")[c].alias(c) for c in columns))


def interpolated(rows: DataFrame, curve: DataFrame, group: list[str], at: str, value: str, beyond: str | None = "proportional") -> DataFrame:
    """Adds ``value`` by straight lines between the points of curve(group, at, value).

    Beyond the ends: in proportion to the value of the end point, or null (beyond=None). One point alone has no line: its
    own value there, the same rule elsewhere."""
    met = bracket(rows, curve.select(*group, at, value), group, at)
    low, high, x = F.col("low"), F.col("high"), F.col(at)
    line = low[value] + (high[value] - low[value]) * (x - low[at]) / (high[at] - low[at])
    outside = F.when(x == low[at], low[value])
    if beyond == "proportional":
        end = F.coalesce(low, high)
        outside = F.coalesce(outside, end[value] * x / end[at])
    return met.select(*rows.columns, F.when(low.isNotNull() & high.isNotNull(), line).otherwise(outside).alias(value))
