"""Readers: tables with a checked schema, composition lists, index files, JSON caches, structure files, scheduler text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.operators.guards import Refused


def open_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table that has the columns of the schema, by name and type; refused otherwise."""
    df = spark.read.parquet(path)
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f.name for f in schema if have.get(f.name) != f.dataType]
    if wrong:
        raise Refused(f"{path} lacks or mistypes {wrong}")
    return df


def by_id(df: DataFrame, column: str, value: object) -> DataFrame:
    """The row of an id; refused where there is none."""
    row = df.filter(F.col(column) == value).limit(1)
    if row.isEmpty():
        raise Refused(f"no row with {column} = {value}")
    return row


def composition_list(spark: SparkSession, path: str, z: tuple[int, int] = (1, 1), n_structures: int | None = None) -> DataFrame:
    """line formula, z_min, z_max, n_structures of ``formula[,z_min,z_max,n_structures]``: ``#`` lines and a header are dropped,
    blanks inherit (one z from the other first), and a cell that is no integer raises, naming the formula."""
    raw = spark.read.schema("formula string, z_min string, z_max string, n_structures string").option("comment", "#").option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    raw = raw.filter(F.lower("formula") != "formula")

    def integer(name: str):
        text = F.nullif(F.trim(name), F.lit(""))
        return F.when(text.isNotNull() & text.try_cast("int").isNull(), F.raise_error(F.concat(F.lit(f"{name} of "), F.col("formula"), F.lit(" is no integer: "), text))).otherwise(text.try_cast("int"))

    low, high = integer("z_min"), integer("z_max")
    return raw.select("formula", F.coalesce(low, high, F.lit(z[0])).alias("z_min"), F.coalesce(high, low, F.lit(z[1])).alias("z_max"), F.coalesce(integer("n_structures"), F.lit(n_structures)).cast("int").alias("n_structures"))


INDEX = "mp_id string, formula string, chemsys string, n_atoms int, folder string, mlip_state string, e_mlip_relaxed double, relax_state string, relax_converged string, relax_core_hours double, static_state string, e_static_eV double, e_per_atom_eV double, magnetization_uB double, ready string, fail_reason string"


def store_index(spark: SparkSession, path: str) -> DataFrame:
    """An index of computed phases, with ``usable``: static energy, relaxed, static step done."""
    df = spark.read.schema(INDEX).option("header", True).csv(path)
    return df.withColumn("usable", F.coalesce(F.col("e_static_eV").isNotNull() & (F.lower("relax_converged") == "true") & (F.col("static_state") == "done"), F.lit(False)))


CACHE = "chemsys string, entries array<struct<mp_id:string,chemsys:string,counts:map<string,bigint>,n_atoms:bigint,e_raw_per_atom:double,e_corrected_per_atom:double,run_type:string,e_above_hull:double>>"


def entry_cache(spark: SparkSession, path: str) -> DataFrame:
    """Entries of cached JSON files; of an id in several files the first file's, by name."""
    files = spark.read.schema(CACHE).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_path"))
    rows = files.select("file", F.posexplode("entries").alias("at", "e")).select("file", "at", "e.*")
    return rows.withColumn("_r", F.row_number().over(W.partitionBy("mp_id").orderBy("file", "at"))).filter("_r = 1").drop("_r", "file", "at")


def id_list(spark: SparkSession, path: str, field: str) -> DataFrame:
    """id, why of a JSON object of ids; empty where it can't be read."""
    text = spark.read.text(path, wholetext=True)
    entries = F.from_json(F.get_json_object("value", f"$.{field}"), "map<string,string>")
    why = F.coalesce(F.get_json_object("reason", "$.why"), F.get_json_object("reason", "$.decision"), F.lit("excluded"))
    return text.select(F.explode(F.coalesce(entries, F.create_map().cast("map<string,string>"))).alias("id", "reason")).select("id", why.alias("why"))


STRUCTURE = "path string, comment string, symbols array<string>, cell array<array<double>>, frac array<array<double>>, reason string"


def _parse_structure(path: str, text: str) -> tuple:
    lines = text.splitlines()
    fail = lambda why: (path, lines[0] if lines else "", None, None, None, why)
    if len(lines) < 8:
        return fail("too few lines")
    if re.fullmatch(r"[\s0-9+-]+", lines[5]):
        return fail("no species line")
    try:
        scale = float(lines[1].split()[0])
        cell = [[float(x) * scale for x in lines[i].split()[:3]] for i in (2, 3, 4)]
        species, counts = lines[5].split(), [int(x) for x in lines[6].split()]
        at = 7 + lines[7].strip().lower().startswith("s")
        if not lines[at].strip().lower().startswith("d"):
            return fail("coordinates are not direct")
        symbols = [s for s, n in zip(species, counts, strict=True) for _ in range(n)]
        frac = [[float(x) for x in lines[at + 1 + i].split()[:3]] for i in range(len(symbols))]
    except (ValueError, IndexError) as e:
        return fail(f"unreadable: {e}")
    if any(not re.fullmatch(r"[A-Z][a-z]?", s) for s in species):
        return fail("partial or unknown species")
    return path, lines[0], symbols, cell, frac, None


def structure_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """One row a file: parsed lattice, symbols and direct coordinates, or the reason why not."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=recursive).select(F.col("_metadata.file_path").alias("path"), "value").dropDuplicates(["path"])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([_parse_structure(p, v) for p, v in zip(batch.path, batch.value, strict=True)], columns=["path", "comment", "symbols", "cell", "frac", "reason"])

    return files.mapInPandas(parse, STRUCTURE)


def scheduler_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Pipe-delimited output of a scheduler, all text, with a normalised ``state`` if there is one."""
    df = spark.read.schema(", ".join(f"{c} string" for c in columns)).option("sep", "|").csv(path)
    return df.withColumn("state", F.lower(F.regexp_extract("state", r"^([A-Za-z_]+)", 1))) if "state" in columns else df


def keyed_csv(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A CSV with header by key: rows of blank key are skipped and the last of a key wins, by place in the file and files by name."""
    df = spark.read.option("header", True).csv(path)
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    rows = df.select(at.alias("_at"), F.struct(*df.columns).alias("_row")).filter(F.coalesce(F.trim(F.col("_row")[key]), F.lit("")) != "")
    last = rows.groupBy(F.col("_row")[key].alias("_k")).agg(F.max_by("_row", "_at").alias("_row"))
    return last.select("_row.*")
