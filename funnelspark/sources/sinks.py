"""Writers and upserts. Parquet has no row updates, so an upsert is a new frame: old rows without new ones, and the new."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create(spark: SparkSession, path: str, schema: T.StructType) -> None:
    spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)


def _last(rows: DataFrame, key: list[str], seq: str | None) -> DataFrame:
    if seq is None:
        return rows
    return rows.withColumn("_r", F.row_number().over(W.partitionBy(*key).orderBy(F.desc(seq)))).filter("_r = 1").drop("_r")


def upsert_last(old: DataFrame, new: DataFrame, key: list[str], seq: str | None = None) -> DataFrame:
    """New rows replace old ones of their key; of several new ones the last by ``seq``."""
    new = _last(new, key, seq)
    return old.join(new.select(*key), key, "left_anti").unionByName(new.select(*old.columns))


def insert_or_ignore(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New rows of new keys only; the first wins."""
    return old.unionByName(new.join(old.select(*key), key, "left_anti").select(*old.columns))


def upsert_columns(old: DataFrame, new: DataFrame, key: list[str], update: list[str]) -> DataFrame:
    """Existing rows take only the ``update`` columns (where not null) of new ones; new keys come in whole."""
    n = new.select(*key, *(F.col(c).alias(f"_n_{c}") for c in old.columns if c not in key), F.lit(True).alias("_new"))
    o = old.withColumn("_old", F.lit(True))
    both = o.join(n, key, "full")
    pick = lambda c: F.when(F.col("_old").isNull(), F.col(f"_n_{c}")).otherwise(F.coalesce(f"_n_{c}", c) if c in update else F.col(c)).alias(c)
    return both.select(*(F.col(c) if c in key else pick(c) for c in old.columns))


def amended(old: DataFrame, changes: DataFrame, key: str, allowed: list[str]) -> DataFrame:
    """Rows with the columns that changes(key, ..) give anew (nulls leave what is there); only ``allowed`` columns may change, keys
    that old lacks change nothing."""
    given = [c for c in changes.columns if c != key]
    if fixed := sorted(set(given) - set(allowed)):
        raise ValueError(f"these columns can't be changed: {fixed}")
    new = changes.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_n_{c}") for c in given))
    both = old.join(new, old[key] == F.col("_k"), "left")
    return both.select(*(F.coalesce(f"_n_{c}", c).alias(c) if c in given else F.col(c) for c in old.columns))


def moved(old: DataFrame, changes: DataFrame, key: str, state: str, allowed: Callable[[F.Column, F.Column], F.Column], also: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows in their new states, refused changes): a change of state, with columns that come with it, is taken where it is allowed."""
    also = also or []
    new = changes.select(F.col(key).alias("_k"), F.col(state).alias("_s"), *(F.col(c).alias(f"_n_{c}") for c in also))
    both = old.join(new, old[key] == F.col("_k"), "left").withColumn("_ok", F.coalesce(allowed(F.col(state), F.col("_s")), F.lit(False)))
    pick = lambda c: F.when(F.col("_ok"), F.coalesce("_s" if c == state else f"_n_{c}", c)).otherwise(F.col(c)).alias(c)
    refused = both.filter(F.col("_k").isNotNull() & ~F.col("_ok")).select(F.col("_k").alias(key), F.col(state).alias("before"), F.col("_s").alias("after"))
    return both.select(*(pick(c) if c in (state, *also) else F.col(c) for c in old.columns)), refused


def appended(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows and new ones, which must have the same columns."""
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    return old.unionByName(new)


def delete(old: DataFrame, gone: DataFrame, key: list[str]) -> DataFrame:
    return old.join(gone.select(*key).distinct(), key, "left_anti")


def update_map(rows: DataFrame, column: str, changes: DataFrame, key: str, dropped: list[str] | None = None) -> DataFrame:
    """Key-values of a map column merged with changes(key, column), and keys deleted; the new value wins."""
    both = rows.join(changes.select(key, F.col(column).alias("_c")), key, "left")
    empty = F.create_map().cast(rows.schema[column].dataType)
    mine = F.map_filter(F.col(column), lambda k, _: ~F.coalesce(F.map_contains_key("_c", k), F.lit(False)) & ~k.isin(*(dropped or [""])))
    return both.withColumn(column, F.map_concat(mine, F.coalesce("_c", empty))).drop("_c")


def replace_table(df: DataFrame, path: str) -> None:
    """Writes beside a table and then swaps, so that a reader never sees half of it."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    to, beside, was = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}-{uuid.uuid4().hex}", f"{path}-old-{uuid.uuid4().hex}"))
    df.write.parquet(beside.toString())
    fs = to.getFileSystem(conf)
    if fs.exists(to):
        fs.rename(to, was)
    fs.rename(beside, to)
    if fs.exists(was):
        fs.delete(was, True)


def write_csv(df: DataFrame, path: str, meanings: dict[str, str] | None = None) -> None:
    """One CSV of a small report, its columns explained in ``#`` lines first."""
    head = [f"# {c}: {meanings[c]}" for c in df.columns if meanings and c in meanings] + [",".join(df.columns)]
    cell = lambda c: F.when(F.col(c).cast("string").rlike('[",\n]'), F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(F.col(c).cast("string"), F.lit("")))
    lines = df.select(F.concat_ws(",", *(cell(c) for c in df.columns)).alias("value"))
    top = df.sparkSession.createDataFrame([(h,) for h in head], "value string").coalesce(1)
    top.unionAll(lines.coalesce(1)).coalesce(1).write.mode("overwrite").text(path)


def unpivot_properties(rows: DataFrame, key: str, columns: list[str], source: str) -> DataFrame:
    """key, name, value, source of the non-null cells of some columns."""
    texts = rows.select(key, *(F.col(c).cast("string").alias(c) for c in columns))
    return texts.unpivot([key], columns, "name", "value").filter("value is not null").withColumn("source", F.lit(source))


def pivot_properties(properties: DataFrame, key: str, names: list[str]) -> DataFrame:
    return properties.groupBy(key).pivot("name", names).agg(F.first("value", ignorenulls=True))


def status_json(counts: DataFrame, path: str, extra: dict | None = None) -> None:
    """A small (name, n) table as one JSON text."""
    text = counts.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n"))))).alias("counts"))
    text.select(F.concat(F.lit('{"extra": '), F.lit(json.dumps(extra or {}, sort_keys=True)), F.lit(', "counts": '), F.coalesce("counts", F.lit("{}")), F.lit("}")).alias("value")).coalesce(1).write.mode("overwrite").text(path)
