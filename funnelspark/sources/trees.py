"""Files of runs and generators: extended xyz frames, trees of run folders, results and archives, and what is written back."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.operators.guards import Refused
from funnelspark.sources import mounted

FRAME = "path string, frame int, symbols array<string>, cell array<double>, positions array<array<double>>, fault string"


def _frames(path: str, text: str) -> Iterator[tuple]:
    lines, at, frame = text.splitlines(), 0, 0
    while at < len(lines):
        if not lines[at].strip():
            at += 1
            continue
        try:
            n = int(lines[at])
            cell = re.search(r'Lattice="([^"]*)"', lines[at + 1])
            rows = [lines[at + 2 + i].split() for i in range(n)]
            yield path, frame, [r[0] for r in rows], [float(x) for x in cell[1].split()] if cell else None, [[float(x) for x in r[1:4]] for r in rows], None
        except (ValueError, IndexError) as e:
            yield path, frame, None, None, None, f"unreadable: {e}"
            return
        at, frame = at + 2 + n, frame + 1


def extxyz(spark: SparkSession, path: str) -> DataFrame:
    """One row a frame of the extended xyz files of a folder; none at all is refused, a broken frame ends its file with a fault."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.extxyz").select(F.col("_metadata.file_path").alias("path"), "value")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, v in zip(batch.path, batch.value, strict=True):
                yield pd.DataFrame(list(_frames(p, v)), columns=["path", "frame", "symbols", "cell", "positions", "fault"])

    if files.isEmpty():
        raise Refused(f"no frames under {path}")
    return files.mapInPandas(parse, FRAME)


def extxyz_text(symbols: Column, positions: Column, cell: Column) -> Column:
    """A frame as text."""
    atoms = F.zip_with(symbols, positions, lambda s, p: F.concat_ws(" ", s, F.array_join(F.transform(p, lambda x: x.cast("string")), " ")))
    head = F.concat(F.lit('Lattice="'), F.array_join(F.transform(cell, lambda x: x.cast("string")), " "), F.lit('" Properties=species:S:1:pos:R:3'))
    return F.concat_ws("\n", F.size(symbols).cast("string"), head, F.array_join(atoms, "\n"))


def run_tree(spark: SparkSession, path: str, pattern: str, names: list[str]) -> DataFrame:
    """path, length, modificationTime and the parts of the path that a pattern names, of every file under a root; content isn't read."""
    at = mounted.local(spark, path)
    if at is not None and os.path.isdir(at):
        files = mounted.listed(spark, at)
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    parts = [F.regexp_extract("path", pattern, i + 1).alias(n) for i, n in enumerate(names)]
    return files.filter(F.col("path").rlike(pattern)).select("path", "length", "modificationTime", *parts)


def write_tree(rows: DataFrame, path: str, parts: list[str], value: str) -> None:
    """A text file a row, in the folder that its parts name; no two rows share a folder."""
    at = mounted.local(rows.sparkSession, path)
    if at is not None:
        mounted.write_text(rows, at, parts, value)
    else:
        rows.select(*parts, F.col(value).alias("value")).write.partitionBy(*parts).text(path)


def discovered(tree: DataFrame, owner: str, run: str) -> DataFrame:
    """One row a run of a tree: number and size of its files, the newest of them."""
    return tree.groupBy(owner, run).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest"))


def task_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Results that tasks have written as JSON lines; a line that can't be read is dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def archive(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An append-only archive of CSV parts with header."""
    return spark.read.schema(schema).option("header", True).csv(path)


def append_archive(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)


def write_records(df: DataFrame, path: str, by: list[str]) -> None:
    """One JSON line a record in order, parts range-sorted: an index or manifest."""
    df.orderBy(*by).select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def index_summary(rows: DataFrame, system: str, sums: dict[str, Column]) -> DataFrame:
    """One row: totals, and a map of a struct of sums for each system, for an index of a family of systems."""
    by = rows.groupBy(system).agg(F.count("*").alias("n"), *(F.sum(c).alias(k) for k, c in sums.items()))
    return by.agg(F.sum("n").alias("n"), *(F.sum(k).alias(k) for k in sums), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(system), F.struct("n", *sums))))).alias("systems"))


def system_list(given: DataFrame | None, listed: DataFrame | None, store: DataFrame, column: str = "chemsys") -> DataFrame:
    """Systems to work on: those given and listed together; where there are none, all of the store's; sorted and distinct."""
    asked = [d.select(column) for d in (given, listed) if d is not None]
    rows = asked[0] if asked else store.select(column)
    for other in asked[1:]:
        rows = rows.unionByName(other)
    return rows.distinct().orderBy(column)


def plan_rows(plan: DataFrame, relax: Column) -> tuple[DataFrame, DataFrame]:
    """(compositions, structures) of a plan(formula, n_target, seed): a seed comes in as new if it is to be relaxed, else as screened,
    and its composition, if there is no other, as generated with no target."""
    asked = plan.filter("seed is null").select("formula", "n_target", F.lit("planned").alias("state"))
    seeds = plan.filter("seed is not null")
    alone = seeds.select("formula").distinct().join(asked.select("formula"), "formula", "left_anti").select("formula", F.lit(0).cast("long").alias("n_target"), F.lit("generated").alias("state"))
    return asked.unionByName(alone), seeds.select("formula", "seed", F.when(relax, "new").otherwise("screened").alias("state"))


def parsers_agree(a: DataFrame, b: DataFrame, key: str, counts: str) -> DataFrame:
    """Keys that two readings give different compositions, or that only one has read."""
    shown = lambda c: F.array_sort(F.map_entries(c))
    both = a.select(key, F.col(counts).alias("_a")).join(b.select(key, F.col(counts).alias("_b")), key, "full")
    return both.filter(~shown(F.col("_a")).eqNullSafe(shown(F.col("_b")))).select(key)
