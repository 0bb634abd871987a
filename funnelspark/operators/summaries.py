"""Summaries of a store: counts by state, tables of states by stage, sums by group, ranked lists, comparisons of two placements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def counts_by(rows: DataFrame, state: str, where: Column | None = None) -> DataFrame:
    """state, n, of all rows or of those that a condition holds for."""
    return (rows if where is None else rows.filter(where)).groupBy(state).agg(F.count("*").alias("n"))


def state_table(rows: DataFrame, stage: str, state: str, states: list[str]) -> DataFrame:
    """stage, and how many of its rows are in each of some states, 0 where none is."""
    return rows.groupBy(stage).agg(*(F.count_if(F.col(state) == s).alias(s) for s in states))


def orphans(jobs: DataFrame, number: str, state: str, waiting: str = "pending") -> DataFrame:
    """Jobs that wait but were never given a scheduler's number."""
    return jobs.filter((F.coalesce(number, F.lit("")) == "") & (F.col(state) == waiting))


def members(rows: DataFrame, group: str, name: str) -> DataFrame:
    """group, names: its distinct names in order, as one text; for groups of bounded size."""
    return rows.select(group, name).distinct().groupBy(group).agg(F.array_join(F.array_sort(F.collect_list(name)), ",").alias("names"))


def spread(rows: DataFrame, group: str, value: Column) -> DataFrame:
    """group, n, total, mean, low, high, spread of a value; nulls aside."""
    v = rows.withColumn("_v", value).groupBy(group)
    return v.agg(F.count("_v").alias("n"), F.sum("_v").alias("total"), F.avg("_v").alias("mean"), F.min("_v").alias("low"), F.max("_v").alias("high"), (F.max("_v") - F.min("_v")).alias("spread"))


def plan_totals(plan: DataFrame, source: str, atoms: str, cost: str, kind: str) -> DataFrame:
    """source, atoms, middle, largest, cost, kinds of a plan's rows, by source."""
    return plan.groupBy(source).agg(F.sum(atoms).alias("atoms"), F.median(atoms).alias("middle"), F.max(atoms).alias("largest"), F.sum(cost).alias("cost"), F.count_distinct(kind).alias("kinds"))


def ranked(rows: DataFrame, group: str, merit: str, n: int, width: int = 40) -> DataFrame:
    """group, merit, place, bar: the best of each group, the first n groups by it, with a bar in proportion to the first."""
    best = rows.groupBy(group).agg(F.max(merit).alias("merit")).orderBy(F.desc("merit"), group).limit(n)  # n rows
    place = F.row_number().over(W.orderBy(F.desc("merit"), group))
    bar = F.round(width * F.col("merit") / F.max("merit").over(W.partitionBy()))
    return best.withColumns({"place": place.cast("long"), "bar": bar.cast("long")})


def largest_needs(items: DataFrame, job: str, memory: Column, default: float, time: Column) -> DataFrame:
    """job, memory, time that serve every item of a job; memory that can't be read counts as the default."""
    return items.groupBy(job).agg(F.max(F.coalesce(memory, F.lit(default))).alias("memory"), F.max(time).alias("time"))


def relative_to(rows: DataFrame, group: str, value: str, parent: Column) -> DataFrame:
    """Adds ``relative``: how far a row's value lies above the least of its group's parents; null where there is none."""
    best = rows.filter(parent).groupBy(F.col(group).alias("_g")).agg(F.min(value).alias("_best"))
    return rows.join(best, F.col(group) == F.col("_g"), "left").withColumn("relative", F.col(value) - F.col("_best")).drop("_g", "_best")


def paired(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Every row of a with every row of b of its key, and the difference of their values; columns of b end in _b."""
    other = b.select(F.col(key).alias("_k"), *(F.col(c).alias(f"{c}_b") for c in b.columns if c != key))
    return a.join(other, F.col(key) == F.col("_k")).drop("_k").withColumn("difference", F.col(value) - F.col(f"{value}_b"))
