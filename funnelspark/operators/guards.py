"""Integrity guards: each returns the rows that violate it, and ``enforce`` refuses by raising before anything is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Refused(ValueError):
    """A guard found violations."""


def enforce(violations: DataFrame, message: str, show: int = 5) -> None:
    """Raises if there is a violation; this is an action, to be run before the write that depends on it."""
    if rows := violations.limit(show).collect():
        raise Refused(f"{message}: " + "; ".join(str(r.asDict()) for r in rows))


def one_value(rows: DataFrame, group: list[str], column: str, blank_exempt: bool = False) -> DataFrame:
    """Groups with more than one value (blank ones aside if exempt): one energy scale, one functional, one convention."""
    value = F.nullif(F.trim(column), F.lit("")) if blank_exempt else F.col(column)
    return rows.groupBy(*group).agg(F.count_distinct(value).alias("n"), F.array_sort(F.collect_set(value)).alias("found")).filter("n > 1")


def end_members(entries: DataFrame, group: str, counts: str = "counts") -> DataFrame:
    """Groups whose elements lack an entry of that element alone."""
    keys = entries.select(group, F.map_keys(counts).alias("k"))
    found = keys.groupBy(group).agg(F.flatten(F.collect_set("k")).alias("k"), F.array_distinct(F.flatten(F.collect_set(F.when(F.size("k") == 1, F.col("k"))))).alias("alone"))
    return found.select(group, F.array_sort(F.array_except(F.array_distinct("k"), "alone")).alias("missing")).filter(F.size("missing") > 0)


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def not_in(rows: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows whose state is outside an enumeration."""
    return rows.filter(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))


def forbidden_pair(rows: DataFrame, a: str, b: str, pairs: list[tuple[str, str]]) -> DataFrame:
    bad = F.lit(False)
    for x, y in pairs:
        bad = bad | (F.col(a) == x) & (F.col(b) == y)
    return rows.filter(bad)


def outside(rows: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return rows.filter(~F.coalesce(F.col(column).between(low, high), F.lit(False)))


def count_mismatch(rows: DataFrame, n: str, counts: str) -> DataFrame:
    """Rows whose size isn't the sum of their counts."""
    total = F.aggregate(F.map_values(counts), F.lit(0).cast("long"), lambda a, v: a + v)
    return rows.filter(~F.col(n).eqNullSafe(total))


def id_elsewhere(rows: DataFrame, key: str, owner: list[str]) -> DataFrame:
    """Keys that more than one owner uses."""
    return rows.groupBy(key).agg(F.count_distinct(*owner).alias("owners")).filter("owners > 1")


def missing_keys(required: list[str], given: Column) -> Column:
    return F.array_except(F.array(*map(F.lit, required)), F.map_keys(given))


def normal_tag(value: Column) -> Column:
    """A setting in one spelling: numbers as doubles, truth values as T or F, else upper case."""
    v = F.upper(F.trim(value))
    truth = F.when(v.isin(".TRUE.", "TRUE", "T"), "T").when(v.isin(".FALSE.", "FALSE", "F"), "F")
    return F.coalesce(truth, v.try_cast("double").cast("string"), v)


def expected_tags(tags: DataFrame, group: str, tag: str, value: str) -> DataFrame:
    """group, tag, value where all rows of the group agree; no vote of the majority."""
    v = normal_tag(F.col(value))
    return tags.groupBy(group, tag).agg(F.count_distinct(v).alias("n"), F.min(value).alias("value")).filter("n = 1").drop("n")
