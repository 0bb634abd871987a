"""Lower convex hulls: how far each entry of a system lies above the best mixture of the others.

``hull(x) = min sum(l * e)`` over mixtures l of entries with composition x. Only the least energy of a composition can be
a vertex, and no compound above the line between its end members, so both are dropped before anything meets in a task.

This module is for two components; facets.py has any number. Hulls of salted parts come before the hull of their vertices,
which is the same; an entry lies on one tie line of its system's.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STABLE = 1e-9
#: Compositions of one system whose hull is found in one task.
ONE_TASK = 100_000


def _lower(points: pd.DataFrame) -> pd.DataFrame:
    """Vertices of the lower hull of points (x, e), by increasing x."""
    out: list[tuple[float, float]] = []
    for x, e in points.groupby("x")["e"].min().items():
        while len(out) > 1 and (out[-1][1] - out[-2][1]) * (x - out[-2][0]) >= (e - out[-2][1]) * (out[-1][0] - out[-2][0]) - 1e-12:  # on a line too
            out.pop()
        out.append((x, e))
    return pd.DataFrame(out, columns=["x", "e"])


def binary_vertices(entries: DataFrame) -> DataFrame:
    """sys, x, e of the lower hull of entries(sys, x, e)."""
    schema = f"sys {entries.schema['sys'].dataType.simpleString()}, x double, e double"

    def part(key: tuple, points: pd.DataFrame) -> pd.DataFrame:
        out = _lower(points)
        out.insert(0, "sys", key[0])
        return out

    least = entries.filter("x is not null and e is not null").groupBy("sys", "x").agg(F.min("e").alias("e"))
    size = least.groupBy("sys").agg(F.ceil(F.count("*") / ONE_TASK).alias("parts"))
    sized = least.join(size, "sys")
    # a system too large for one task: hulls of its parts first
    parts = sized.filter("parts > 1").groupBy("sys", F.pmod(F.xxhash64("x"), F.col("parts")).alias("part")).applyInPandas(lambda key, points: part(key, points), schema)
    whole = sized.filter("parts = 1").select("sys", "x", "e").unionByName(parts)
    return whole.groupBy("sys").applyInPandas(lambda key, points: part(key, points), schema)


def tie_lines(vertices: DataFrame) -> DataFrame:
    """sys, x0, e0, x1, e1 of neighbouring vertices."""
    from pyspark.sql import Window as W

    w = W.partitionBy("sys").orderBy("x")
    return vertices.select("sys", F.col("x").alias("x0"), F.col("e").alias("e0"), F.lead("x").over(w).alias("x1"), F.lead("e").over(w).alias("e1"))


def place_binary(entries: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Adds hull, e_above_hull and stable to entries(sys, x, e); null where x is outside the system's end members.

    A system's vertices travel as one array, as many as its hull has, to its entries, so a row is placed where it is."""
    vertices = binary_vertices(entries) if vertices is None else vertices
    corners = vertices.groupBy("sys").agg(F.array_sort(F.collect_list(F.struct("x", "e"))).alias("v")).withColumnRenamed("sys", "of")
    ends = F.zip_with(F.slice("v", F.lit(1), F.size("v") - 1), F.slice("v", F.lit(2), F.size("v")), lambda a, b: F.struct(a["x"].alias("x0"), a["e"].alias("e0"), b["x"].alias("x1"), b["e"].alias("e1")))
    known = corners.select("of", ends.alias("_lines"), F.element_at("v", -1).alias("_last"))
    joined = entries.join(known, F.col("of") == F.col("sys"), "left")
    x = F.col("x")
    on = F.get(F.filter("_lines", lambda s: (x >= s["x0"]) & (x < s["x1"])), F.lit(0))
    line = F.when(x == F.col("_last.x"), F.col("_last.e")).otherwise(on["e0"] + (on["e1"] - on["e0"]) * (x - on["x0"]) / (on["x1"] - on["x0"]))
    return joined.withColumn("hull", line).drop("of", "_lines", "_last").withColumns({"e_above_hull": F.col("e") - F.col("hull"), "stable": F.col("e") - F.col("hull") <= STABLE})


def dirty_systems(candidates: DataFrame, placements: DataFrame, ref_hash: str = "ref_hash") -> DataFrame:
    """Systems with a candidate that has no placement at its system's present reference hash: each is rebuilt whole or not at all."""
    have = placements.select("id", ref_hash).distinct()
    return candidates.join(have, ["id", ref_hash], "left_anti").select("sys").distinct()
