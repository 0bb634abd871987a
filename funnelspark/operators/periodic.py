"""Neighbours in periodic cells: sites by fractions of three lattice vectors, met through a grid of cells that wraps around.

A cell of any shape is cut into slabs along each vector no thinner than the cutoff (measured by the heights of the cell, so
skew cells are right); where it is thinner than the cutoff as a whole, its images count as often as they reach. Every site
is sent to the cells around its own, with the shift of the image that it stands for there, and meets the sites of
that cell by an equi-join: nothing pairs up beyond the neighbouring cells, and an image of a site is a neighbour of the site too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.sources.folders import cut

#: Least distance as a share of the sum of two radii, and least distance between two atoms of one gated kind, by default.
MIN_SHARE, SAME_KIND = 0.80, 3.50


def _cross(a: Column, b: Column) -> Column:
    i = lambda v, n: F.element_at(v, n)
    return F.array(i(a, 2) * i(b, 3) - i(a, 3) * i(b, 2), i(a, 3) * i(b, 1) - i(a, 1) * i(b, 3), i(a, 1) * i(b, 2) - i(a, 2) * i(b, 1))


def _dot(a: Column, b: Column) -> Column:
    return sum((F.element_at(a, n) * F.element_at(b, n) for n in (2, 3)), F.element_at(a, 1) * F.element_at(b, 1))


def _heights(lattice: Column) -> Column:
    """The distance between opposite walls along each vector: the volume over the area of the wall."""
    v = [F.element_at(lattice, n) for n in (1, 2, 3)]
    walls = [_cross(v[1], v[2]), _cross(v[2], v[0]), _cross(v[0], v[1])]
    return F.array(*(F.coalesce(F.try_divide(F.abs(_dot(v[0], walls[0])), F.sqrt(_dot(w, w))), F.lit(0.0)) for w in walls))


def grids(cells: DataFrame, cutoff: float) -> DataFrame:
    """cell, lattice, slabs and reach (cells to either side) along each vector, of cells(cell, lattice: 3 by 3); flat cells are left out."""
    known = cells.select("cell", "lattice", F.transform(F.array("lattice"), _heights)[0].alias("height")).filter(F.array_min("height") > 1e-9)
    known = known.withColumn("slabs", F.transform("height", lambda h: F.greatest(F.floor(h / cutoff), F.lit(1)).cast("int")))
    reach = F.zip_with("height", "slabs", lambda h, n: F.ceil(F.lit(cutoff) * n / h).cast("int"))
    return known.select("cell", "lattice", "slabs", reach.alias("reach"))


def neighbours(sites: DataFrame, cells: DataFrame, cutoff: float) -> DataFrame:
    """cell, a, b, kind_a, kind_b, shift, distance: every site b (in the image that the shift names) within a cutoff of a site a.

    sites(cell, site, kind, at: 3 fractions of the lattice vectors), cells(cell, lattice). Both ways; a site's own images count,
    itself doesn't. Sites of unknown cells or without a place have no neighbours."""
    known = sites.filter("at is not null").join(cut(grids(cells, cutoff), "grids"), "cell")  # a row a cell, computed once
    wrapped = known.withColumn("w", F.transform("at", lambda x: x - F.floor(x)))
    # a fraction just below 1 rounds up to 1 at times
    wrapped = wrapped.withColumn("own", F.zip_with("w", "slabs", lambda x, n: F.least(F.floor(x * n).cast("int"), n - 1)))
    here = wrapped.select("cell", "own", F.col("site").alias("a"), F.col("kind").alias("kind_a"), F.col("w").alias("wa"), "lattice", F.col("at").alias("at_a"))
    for n in (1, 2, 3):
        wrapped = wrapped.withColumn(f"o{n}", F.explode(F.sequence(-F.element_at("reach", n), F.element_at("reach", n))))
    # the image of the site at shift s stands in the grid of the cell at own + slabs * s; it is asked for by the cells around
    target = [F.element_at("own", n) + F.col(f"o{n}") for n in (1, 2, 3)]
    shift = [F.floor(t / F.element_at("slabs", n)).cast("int") for n, t in enumerate(target, 1)]
    cell = [F.pmod(t, F.element_at("slabs", n)).cast("int") for n, t in enumerate(target, 1)]
    sent = wrapped.select("cell", F.array(*cell).alias("own"), F.col("site").alias("b"), F.col("kind").alias("kind_b"), F.col("w").alias("wb"), F.array(*(-s for s in shift)).alias("s"), F.col("at").alias("at_b"))
    met = here.join(sent, ["cell", "own"])
    apart = F.zip_with(F.zip_with("wb", "s", lambda x, s: x + s), "wa", lambda x, y: x - y)
    met = met.withColumn("d", apart)
    along = [sum((F.element_at("d", n) * F.element_at(F.element_at("lattice", n), m) for n in (2, 3)), F.element_at("d", 1) * F.element_at(F.element_at("lattice", 1), m)) for m in (1, 2, 3)]
    met = met.withColumn("distance", F.sqrt(along[0] * along[0] + along[1] * along[1] + along[2] * along[2]))
    itself = (F.col("a") == F.col("b")) & (F.array_max(F.transform("s", lambda s: F.abs(s))) == 0)
    # shifts are told between the places as given, not as wrapped
    told = F.zip_with("s", F.zip_with("at_a", "at_b", lambda x, y: F.floor(x) - F.floor(y)), lambda s, f: (s + f).cast("int"))
    return met.filter((F.col("distance") <= cutoff) & ~itself).select("cell", "a", "b", "kind_a", "kind_b", told.alias("shift"), "distance")


def contact_faults(sites: DataFrame, cells: DataFrame, radii: DataFrame, gated: list[str], share: float = MIN_SHARE, same_kind: float = SAME_KIND, default_radius: float = 1.3) -> DataFrame:
    """cell, n_sites, worst (the least distance over its limit, share times the sum of the radii), close_kind and close (the gated kind
    whose atoms come nearest to each other, and how near), fault of every cell of sites; radii(kind, radius).

    fault: contact where worst is below 1, else gate where atoms of a gated kind are nearer than same_kind, else null; the contacts
    come first. Distances are looked for as far as any limit reaches."""
    largest = radii.agg(F.max("radius")).first()[0]
    cutoff = max(2 * share * max(default_radius, largest or 0.0), same_kind)
    near = neighbours(sites, cells, cutoff)
    known = radii.select("kind", "radius")
    for x in "ab":
        near = near.join(known.withColumnsRenamed({"kind": f"kind_{x}", "radius": f"radius_{x}"}), f"kind_{x}", "left")
    limit = share * (F.coalesce("radius_a", F.lit(default_radius)) + F.coalesce("radius_b", F.lit(default_radius)))
    both = (F.col("kind_a") == F.col("kind_b")) & F.col("kind_a").isin(*gated) & (F.col("distance") < same_kind)
    found = near.groupBy("cell").agg(F.min(F.col("distance") / limit).alias("worst"), F.min(F.when(both, F.struct(F.col("distance").alias("close"), F.col("kind_a").alias("close_kind")))).alias("g"))
    out = sites.groupBy("cell").agg(F.count("*").alias("n_sites")).join(found.select("cell", "worst", "g.*"), "cell", "left")
    fault = F.when(F.col("worst") < 1, "contact").when(F.col("close").isNotNull(), "gate")
    return out.select("cell", "n_sites", F.when(F.col("worst") < 1, F.col("worst")).alias("worst"), "close_kind", "close", fault.alias("fault"))


def purity(sites: DataFrame, cells: DataFrame, cutoff: float) -> DataFrame:
    """cell, site, n, same: how many neighbours a site has within a cutoff, images of itself among them, and how many are of its kind."""
    found = neighbours(sites, cells, cutoff).groupBy("cell", F.col("a").alias("site")).agg(F.count("*").alias("n"), F.count_if(F.col("kind_a") == F.col("kind_b")).alias("same"))
    out = sites.select("cell", "site").join(found, ["cell", "site"], "left")
    return out.withColumns({"n": F.coalesce("n", F.lit(0)), "same": F.coalesce("same", F.lit(0))})


def region_share(sites: DataFrame, cells: DataFrame, kind: str, cutoff: float) -> DataFrame:
    """cell, n, share: the sites of a kind, and what part of them has no site of another kind within a cutoff.

    0 where there is none of the kind; 1 where there is nothing else."""
    near = neighbours(sites, cells, cutoff).filter((F.col("kind_a") == kind) & (F.col("kind_b") != kind)).select("cell", F.col("a").alias("site")).distinct()
    met = sites.join(near.withColumn("_near", F.lit(True)), ["cell", "site"], "left")
    mine = F.col("kind") == kind
    out = met.groupBy("cell").agg(F.count_if(mine).alias("n"), F.count_if(mine & F.col("_near").isNull()).alias("far"))
    return out.select("cell", "n", F.coalesce(F.try_divide(F.col("far"), F.col("n")), F.lit(0.0)).alias("share"))


def nearest(sites: DataFrame, cells: DataFrame, cutoff: float) -> DataFrame:
    """cell, site, to, distance: the nearest other site or image within a cutoff; of equally near ones the least."""
    w = W.partitionBy("cell", "a").orderBy("distance", "b", "shift")
    return neighbours(sites, cells, cutoff).withColumn("r", F.row_number().over(w)).filter("r = 1").select("cell", F.col("a").alias("site"), F.col("b").alias("to"), "distance")
