"""Lower hulls of systems of any number of components: facets, vertices, edges, placement, decomposition.

The lower hull of energies over compositions is a complex of facets, each a simplex of k corners with a plane through
them (``prices``, the energy of each pure component) that no entry lies below. As the hull is convex its energy at x is the
largest of ``x . prices`` over the facets, so an entry is placed by one matrix product, and the facet that gives the largest
decomposes it: shares of its corners that mix to x.

Facets are found by walking: the first is the best mixture at an inner point, by simplex steps from the end members; over
each ridge (a facet less one corner) its plane is turned until it meets the next entry. Ties, where more than k entries lie
in one plane, are split alike everywhere by lifting every composition by a fixed tiny amount (below ``LIFT``) of its own.

Only the least energy of a composition can be a corner, and no compound above the plane of its end members, so both are
dropped first. Systems of more than ``ONE_TASK`` compositions are walked in parts, of which only the corners go on. Compositions
are salted over tasks, the facets repeated; entries take what their composition got.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.sources.folders import broadcast_if, cut

STABLE = 1e-9
LIFT = 1e-11
SALTS = 16
ONE_TASK = 20_000
#: Placed compositions, of some 200 bytes each, that may be broadcast.
BROADCAST_POINTS = 50_000
CORNER = "array<struct<id:{id},fractions:array<double>,e:double>>"


def lifted(x: np.ndarray) -> np.ndarray:
    """A number from 0 to LIFT for every composition, 0 for end members; the same wherever the composition turns up."""
    spread = np.abs(np.sin(x @ (np.arange(x.shape[1]) + 1.6180339887) * 91.7)) * 43758.5453
    return np.where(x.max(axis=1) > 1 - 1e-12, 0.0, LIFT * (spread - np.floor(spread)))


def first_facet(x: np.ndarray, e: np.ndarray) -> list[int]:
    """Rows of the facet over a point near the middle, by simplex steps from the end members, which rows 0 .. k-1 are."""
    k = x.shape[1]
    target = 1 + 0.1 * np.sqrt(np.arange(2, k + 2)) % 0.05
    target /= target.sum()
    basis = list(range(k))
    for _ in range(50 * (len(e) + k)):
        inverse = np.linalg.inv(x[basis].T)
        gain = e - x @ (inverse.T @ e[basis])
        entering = int(gain.argmin())
        if gain[entering] > -1e-13:
            break
        share, step = inverse @ target, inverse @ x[entering]
        up = np.flatnonzero(step > 1e-12)
        basis[int(up[(share[up] / step[up]).argmin()])] = entering
    return basis


def walk(x: np.ndarray, e: np.ndarray) -> list[tuple[int, ...]]:
    """Corners of every facet, as rows of x (compositions, the end members first) and e."""
    k, lift = x.shape[1], e + lifted(x)
    start = tuple(sorted(first_facet(x, lift)))
    seen, todo = {start}, deque([start])
    while todo:
        facet = todo.popleft()
        inverse = np.linalg.inv(x[list(facet)])
        gain = lift - x @ (inverse @ lift[list(facet)])
        gain[list(facet)] = 0
        for i in range(k):
            turn = x @ -inverse[:, i]  # how a plane rises that turns about the ridge, falling at the corner left out
            ahead = turn > 1e-9
            if ahead.any():
                ratio = np.where(ahead, gain, np.inf) / np.where(ahead, turn, 1)
                found = tuple(sorted((*facet[:i], *facet[i + 1 :], int(ratio.argmin()))))
                if found not in seen:
                    seen.add(found)
                    todo.append(found)
    return sorted(seen)


def _ordered(rows: pd.DataFrame, k: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Rows with the end members first, in order of components; compositions; energies."""
    x = np.array(rows.fractions.tolist(), dtype=float).reshape(len(rows), k)
    ends = x.max(axis=1) > 1 - 1e-12
    turn = np.lexsort((*x.T, np.where(ends, x.argmax(axis=1), k)))
    return rows.iloc[turn].reset_index(drop=True), x[turn], rows.e.to_numpy(dtype=float)[turn]


def _is_end() -> Column:
    return F.array_max("fractions") > 1 - 1e-12


def least_entries(entries: DataFrame) -> DataFrame:
    """sys, fractions, e, id of the least entry of each composition (of equal energies the least id) of entries(id, sys, fractions, e)."""
    rows = entries.filter("e is not null and fractions is not null and sys is not null")
    return rows.groupBy("sys", "fractions").agg(F.min(F.struct("e", "id")).alias("m")).select("sys", "fractions", "m.e", "m.id")


def end_members(least: DataFrame, k: int) -> DataFrame:
    """sys, ends (energies of the k end members), of systems that have them all."""
    ends = least.filter(_is_end()).select("sys", F.array_position(F.transform("fractions", lambda v: v > 1 - 1e-12), F.lit(True)).alias("i"), "e")
    ends = ends.groupBy("sys").agg(F.array_sort(F.collect_list(F.struct("i", "e"))).alias("ends")).filter(F.size("ends") == k)  # k rows a system
    return ends.select("sys", F.transform("ends", lambda s: s["e"]).alias("ends"))


def facets(entries: DataFrame, k: int, one_task: int = ONE_TASK) -> DataFrame:
    """sys, facet, corners (id, fractions, e of each), prices of entries(id, sys, fractions: k doubles, e).

    Systems that lack an end member have no facets."""
    kinds = {c: entries.schema[c].dataType.simpleString() for c in ("id", "sys")}
    least = least_entries(entries)
    known = least.join(end_members(least, k), "sys")
    plane = F.aggregate(F.arrays_zip("fractions", "ends"), F.lit(0.0), lambda a, s: a + s["fractions"] * s["ends"])
    known = known.filter(_is_end() | (F.col("e") < plane))
    size = known.groupBy("sys").agg(F.count("*").alias("n")).select("sys", F.ceil(F.col("n") / one_task).alias("parts"))
    known = known.join(size, "sys").select("sys", "parts", "fractions", "e", "id")

    def corners(rows: pd.DataFrame) -> pd.DataFrame:
        rows, x, e = _ordered(rows, k)
        return rows.iloc[sorted({i for f in walk(x, e) for i in f})][["sys", "fractions", "e", "id"]]

    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    large = known.filter("parts > 1").withColumn("part", F.explode(F.when(_is_end(), every).otherwise(F.array(F.pmod(F.xxhash64("fractions"), F.col("parts"))))))
    large = large.groupBy("sys", "part").applyInPandas(lambda rows: corners(rows), f"sys {kinds['sys']}, fractions array<double>, e double, id {kinds['id']}").distinct()
    whole = known.filter("parts = 1").select("sys", "fractions", "e", "id").unionByName(large)

    def complex_of(rows: pd.DataFrame) -> pd.DataFrame:
        rows, x, e = _ordered(rows, k)
        labels, out = rows.id.tolist(), []
        for n, facet in enumerate(walk(x, e)):
            at = list(facet)
            named = [{"id": labels[i], "fractions": x[i].tolist(), "e": float(e[i])} for i in at]
            out.append((rows.sys[0], n, named, np.linalg.solve(x[at], e[at]).tolist()))
        return pd.DataFrame(out, columns=["sys", "facet", "corners", "prices"])

    return whole.groupBy("sys").applyInPandas(complex_of, f"sys {kinds['sys']}, facet int, corners {CORNER.format(**kinds)}, prices array<double>")


def vertices(complexes: DataFrame) -> DataFrame:
    """sys, id, fractions, e of the corners of facets()."""
    return complexes.select("sys", F.explode("corners").alias("c")).select("sys", "c.*").distinct()


def edges(complexes: DataFrame) -> DataFrame:
    """sys, a, b: every two corners that share a facet, the tie lines, each once with the smaller composition as a."""
    ordered = F.array_sort(F.transform("corners", lambda c: F.struct(c["fractions"].alias("fractions"), c["e"].alias("e"), c["id"].alias("id"))))
    named = complexes.select("sys", ordered.alias("c"))
    first = named.select("sys", "c", F.posexplode("c").alias("i", "a"))
    return first.select("sys", "a", F.explode(F.slice("c", F.col("i") + 2, F.size("c"))).alias("b")).distinct()


def placed(entries: DataFrame, complexes: DataFrame, k: int) -> DataFrame:
    """Adds hull, e_above_hull, formation, stable and decomposition (id, amount of the corners that the hull mixes there) to every
    row of entries(id, sys, fractions, e, ..); nulls where the system has no facets or the row no energy or composition.

    A composition is placed once in its system, whatever the number of its entries."""
    kind = lambda c: entries.schema[c].dataType.simpleString()
    decomposition = f"array<struct<id:{kind('id')},amount:double>>"
    schema = f"_of {kind('sys')}, _at array<double>, hull double, _base double, decomposition {decomposition}"
    points = entries.filter("fractions is not null").select("sys", "fractions").distinct()
    points = points.join(complexes.select("sys").distinct(), "sys", "left_semi").withColumn("_salt", F.pmod(F.xxhash64("fractions"), F.lit(SALTS)))
    spread = complexes.select(F.col("sys").alias("_of"), "corners", "prices", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_part"))

    def place(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=["_of", "_at", "hull", "_base", "decomposition"], dtype=object)
        x = np.array(rows.fractions.tolist(), dtype=float)
        prices = np.array(known.prices.tolist())
        named = [[(c["id"], np.asarray(c["fractions"], dtype=float), c["e"]) for c in corners] for corners in known.corners]
        ends = np.zeros(k)
        for corner in (c for f in named for c in f):
            if corner[1].max() > 1 - 1e-12:
                ends[int(corner[1].argmax())] = corner[2]
        best, hull = np.zeros(len(x), dtype=int), np.zeros(len(x))
        for low in range(0, len(x), 1024):  # bounds the product
            values = x[low : low + 1024] @ prices.T
            best[low : low + 1024], hull[low : low + 1024] = values.argmax(axis=1), values.max(axis=1)
        mixed: list = [None] * len(x)
        for f in np.unique(best):
            mine = np.flatnonzero(best == f)
            shares = np.linalg.solve(np.array([c[1] for c in named[f]]).T, x[mine].T).T
            for i, share in zip(mine, shares, strict=True):
                mixed[i] = [{"id": c[0], "amount": float(s)} for c, s in sorted(zip(named[f], share, strict=True), key=lambda z: z[0][1].tolist()) if s > 1e-9]
        return pd.DataFrame({"_of": rows.sys, "_at": rows.fractions, "hull": hull, "_base": x @ ends, "decomposition": mixed})

    at = points.groupBy("sys", "_salt").cogroup(spread.groupBy("_of", "_part")).applyInPandas(place, schema)
    at = broadcast_if(cut(at, "points"), BROADCAST_POINTS)
    out = entries.join(at, (F.col("sys") == F.col("_of")) & (F.col("fractions") == F.col("_at")), "left")
    e = F.when(~F.isnan("e"), F.col("e"))
    return out.select(*entries.columns, "hull", (e - F.col("hull")).alias("e_above_hull"), (e - F.col("_base")).alias("formation"), (e - F.col("hull") <= STABLE).alias("stable"), "decomposition")


def place(entries: DataFrame, k: int) -> DataFrame:
    """id, sys, e_above_hull, formation, stable, decomposition of every row of entries(id, sys, fractions, e) on the hull of all of them."""
    return placed(entries.select("id", "sys", "fractions", "e"), facets(entries, k), k).select("id", "sys", "e_above_hull", "formation", "stable", "decomposition")


def place_alone(candidates: DataFrame, reference: DataFrame, k: int) -> DataFrame:
    """id, sys, e_above_hull, below of each candidate on the hull of the reference and itself, as if no other candidate were there.

    One that lies under the reference's hull becomes a vertex: its distance is 0, and ``below`` is how far it lies under."""
    found = placed(candidates.select("id", "sys", "fractions", "e"), facets(reference, k), k)
    above = F.col("e_above_hull")
    return found.select("id", "sys", F.when(above < 0, 0.0).otherwise(above).alias("e_above_hull"), F.when(above > 0, 0.0).otherwise(-above).alias("below"))


def refusals(entries: DataFrame, k: int, scale: str = "scale", functional: str = "run_type") -> DataFrame:
    """sys, absent: the reason why a system of entries(sys, fractions, e, scale, functional) can't have a hull, null if it can.

    In this order: entries on several energy scales; of several functionals, blank ones aside; an end member that is missing."""
    blank = F.nullif(F.trim(functional), F.lit(""))
    ends = F.when(_is_end() & F.col("e").isNotNull(), F.array_position(F.transform("fractions", lambda v: v > 1 - 1e-12), F.lit(True)))
    found = entries.groupBy("sys").agg(F.count_distinct(scale).alias("scales"), F.count_distinct(blank).alias("functionals"), F.count_distinct(ends).alias("ends"))
    why = F.when(F.col("scales") > 1, "several energy scales").when(F.col("functionals") > 1, "several functionals").when(F.col("ends") < k, "an end member is missing")
    return found.select("sys", why.alias("absent"))


def placed_with_reasons(candidates: DataFrame, entries: DataFrame, k: int, scale: str = "scale", functional: str = "run_type") -> DataFrame:
    """Adds hull, e_above_hull, formation, stable, decomposition and ``absent`` to every row of candidates(id, sys, fractions, e).

    A system that refusals() refuses is not placed; candidates don't shape the hull, and no row is lost."""
    known = refusals(entries, k, scale, functional)
    sound = entries.join(known.filter("absent is null").select("sys"), "sys", "left_semi")
    out = placed(candidates.select("id", "sys", "fractions", "e"), facets(sound, k), k)
    why = known.select(F.col("sys").alias("_s"), F.col("absent").alias("_why"), F.lit(True).alias("_known"))
    out = out.join(why, out.sys == F.col("_s"), "left")
    absent = F.when(F.col("_known").isNull(), "no reference entries").otherwise(F.coalesce("_why", F.when(F.col("fractions").isNull(), "no composition").when(F.col("e").isNull(), "no energy")))
    return out.withColumn("absent", absent).drop("_s", "_why", "_known")


def audit(entries: DataFrame, complexes: DataFrame, k: int) -> DataFrame:
    """sys, entries, vertices, facets, empty: how much a hull stands on, and how many of its systems of two components or more, the
    whole one among them, no entry of energy belongs to."""
    spans = F.array_join(F.transform("fractions", lambda v: F.when(v > 1e-12, "1").otherwise("0")), "")
    known = entries.filter("e is not null and fractions is not null").select("sys", spans.alias("spans"))
    seen = known.groupBy("sys").agg(F.count("*").alias("entries"), F.count_distinct(F.when(F.length(F.replace("spans", F.lit("0"), F.lit(""))) > 1, F.col("spans"))).alias("_seen"))
    corners = vertices(complexes).groupBy("sys").agg(F.count("*").alias("vertices"))
    out = seen.join(corners, "sys", "left").join(complexes.groupBy("sys").agg(F.count("*").alias("facets")), "sys", "left")
    return out.select("sys", "entries", F.coalesce("vertices", F.lit(0)).alias("vertices"), F.coalesce("facets", F.lit(0)).alias("facets"), (F.lit(2**k - k - 1) - F.col("_seen")).alias("empty"))


def coverage_refusals(wanted: DataFrame, have: DataFrame, near: float, allow_partial: bool = False) -> DataFrame:
    """sys, blocking, waivable, absent: phases of wanted(sys, id, distance) that have(id) lacks, and why the system has no hull.

    A missing phase blocks where it lies within ``near`` of the hull or nobody knows how near, else it can be waived; a
    system is refused for blocking ones, and for any missing one unless allow_partial. Complete systems have no reason."""
    lacking = wanted.join(have.select("id").distinct().withColumn("_have", F.lit(True)), "id", "left")
    missing, close = F.col("_have").isNull(), F.coalesce(F.col("distance") <= near, F.lit(True))
    out = lacking.groupBy("sys").agg(F.count_if(missing & close).alias("blocking"), F.count_if(missing & ~close).alias("waivable"))
    why = F.when(F.col("blocking") > 0, "phases near the hull are missing")
    return out.withColumn("absent", why if allow_partial else why.when(F.col("waivable") > 0, "phases are missing"))
