"""Readers of past work's folder trees: which run of which structure, its newest step, and what its files say.

A tree is listed without opening a file; what a path pattern names become columns, on which systems are chosen, counted and cut
before any content is read. Of each run the newest step wins, and only the files of that one are opened.
"""

from __future__ import annotations

from functools import reduce
from itertools import batched

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.functions.values import last_match
from funnelspark.sources import mounted
from funnelspark.sources.trees import run_tree

#: Files whose paths go into one read.
CHUNK = 10_000


def newest_steps(tree: DataFrame, run: list[str], step: str) -> DataFrame:
    """The files of the greatest step of each run, with ``steps``, how many the run has."""
    last = tree.groupBy(*(F.col(c).alias(f"_{c}") for c in run)).agg(F.max(step).alias("_step"), F.count_distinct(step).alias("steps"))
    same = F.col(step) == F.col("_step")
    for c in run:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return tree.join(last, same).drop("_step", *(f"_{c}" for c in run))


def first_groups(tree: DataFrame, group: str, limit: int | None) -> DataFrame:
    """The files of the first ``limit`` groups in order."""
    if limit is None:
        return tree
    return tree.join(F.broadcast(tree.select(group).distinct().orderBy(group).limit(limit)), group, "left_semi")  # limit rows


def contents(spark: SparkSession, files: DataFrame) -> DataFrame:
    """files with ``content`` (text) of each path; nothing else is opened. Tasks read what they mount, the rest is read in chunks of paths."""
    near = F.startswith("path", F.lit("file:"))
    out = mounted.contents(files.filter(near)).withColumn("content", F.col("content").cast("string"))
    far, parts = files.filter(~near), []
    for some in batched((r.path for r in far.select("path").toLocalIterator()), CHUNK):
        parts.append(spark.read.format("binaryFile").load(list(some)).select("path", F.col("content").cast("string").alias("content")))
    return out.unionByName(far.join(reduce(DataFrame.unionByName, parts), "path")) if parts else out


def runs(spark: SparkSession, root: str, pattern: str, names: list[str], run: list[str], step: str, chosen: Column | None = None, limit: int | None = None) -> DataFrame:
    """One row a file of each run's newest step: path, the parts of the path, steps, content.

    chosen: a condition on the parts, held against the listing; limit: so many of the first groups (the first of ``run``)."""
    tree = run_tree(spark, root, pattern, names)
    tree = first_groups(tree.filter(chosen) if chosen is not None else tree, run[0], limit)
    return contents(spark, newest_steps(tree, run, step))


def properties(files: DataFrame, numbers: dict[str, str], finished: str, reached: str) -> DataFrame:
    """files with the last match of each number's pattern (a double, null if there is none), converged, and a warning where the
    geometry is that of the last step only."""
    out = files.withColumns({name: last_match(F.col("content"), pattern).cast("double") for name, pattern in numbers.items()})
    ended, met = F.contains("content", F.lit(finished)), F.contains("content", F.lit(reached))
    return out.withColumn("converged", ended & met).withColumn("warning", F.when(~ended, "cut_off").when(~met, "last_step_only"))


def attached(rows: DataFrame, energies: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """rows with columns of another model's results by id, and whether there was one; of an id's results the least counts."""
    best = energies.groupBy(F.col(key).alias("_k")).agg(F.min(F.struct(*columns)).alias("_r"))
    out = rows.join(best, F.col(key) == F.col("_k"), "left")
    return out.select(*rows.columns, *(F.col(f"_r.{c}").alias(c) for c in columns), F.col("_k").isNotNull().alias("attached"))
