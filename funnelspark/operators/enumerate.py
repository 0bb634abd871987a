"""Constrained enumeration: stoichiometries of chosen elements, multiples of a formula, and shares of a total."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.functions import formula as fm
from funnelspark.operators.ranking import numbered
from funnelspark.sources.folders import cut

#: Vectors of counts that are sent to all tasks.
VECTORS = 200_000


def stoichiometries(spark: SparkSession, k: int, most: int, reduced: bool = True) -> DataFrame:
    """``v``: arrays of k positive counts with sum at most ``most``, of gcd 1 if reduced; each level only adds what still fits."""
    df = spark.range(1).select(F.array().cast("array<int>").alias("v"), F.lit(0).alias("s"))
    for i in range(k):
        top = F.lit(most - (k - 1 - i)) - F.col("s")
        df = df.filter(top >= 1).select("v", "s", F.explode(F.sequence(F.lit(1), top)).alias("n"))
        df = df.select(F.concat("v", F.array("n")).alias("v"), (F.col("s") + F.col("n")).alias("s"))
    return df.filter(fm.gcd_of(F.col("v")) == 1).select("v") if reduced else df.select("v")


def choices(spark: SparkSession, groups: dict[str, tuple[list[str], list[int]]]) -> DataFrame:
    """``elements``: every choice of the allowed numbers of elements from each group, sorted within a group; groups are joined level by level."""
    df = spark.range(1).select(F.array().cast("array<string>").alias("elements"))
    for members, picks in groups.values():
        members = sorted(members)
        n = len(members)
        subsets = spark.range(1 << n).select(F.filter(F.array(*map(F.lit, members)), lambda _, i: F.getbit(F.col("id"), i) == 1).alias("own")).filter(F.size("own").isin(*picks))
        df = df.crossJoin(F.broadcast(subsets)).select(F.concat("elements", "own").alias("elements"))  # the sizes are the plan's, not the data's
    return df


def chemical_space(spark: SparkSession, groups: dict[str, tuple[list[str], list[int]]], most: int, bounds: dict[str, tuple[float, float]] | None = None, max_rare_earths: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(formulas, rejected): formula, chemsys, counts, n_atoms of each distinct formula in the space; and those that a bound refuses, with its reason."""
    repeated = [e for e in (x for g, _ in groups.values() for x in g) if sum(e in g for g, _ in groups.values()) > 1]
    if repeated:
        raise ValueError(f"elements in more than one group: {sorted(set(repeated))}")
    sets = choices(spark, groups).filter(F.size("elements") > 0)
    if max_rare_earths is not None:
        sets = sets.filter(F.size(F.array_intersect("elements", F.array(*map(F.lit, fm.RARE_EARTHS)))) <= max_rare_earths)
    sizes = range(1, sum(max(p) for _, p in groups.values()) + 1)
    vectors = reduce(DataFrame.unionByName, (stoichiometries(spark, k, most) for k in sizes)).withColumn("k", F.size("v"))
    rows = sets.withColumn("k", F.size("elements")).join(vectors, "k").select(F.map_from_arrays("elements", F.transform("v", lambda n: n.cast("long"))).alias("counts"))
    rows = rows.withColumns({"formula": fm.canonical(F.col("counts")), "chemsys": fm.chemsys(F.col("counts")), "n_atoms": fm.n_atoms(F.col("counts"))})
    reason = F.lit(None).cast("string")
    for name, (low, high) in reversed(list((bounds or {}).items())):
        share = fm.group_fraction(F.col("counts"), groups[name][0])
        reason = F.when(share < low - 1e-12, f"{name} below {low}").when(share > high + 1e-12, f"{name} above {high}").otherwise(reason)
    judged = rows.withColumn("reason", reason)
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null").select("formula", "reason")


def stoichiometries_of(rows: DataFrame, k: str, most: str, top_k: int, reduced: bool = True) -> DataFrame:
    """rows with ``v``: every array of the row's k positive counts (at most top_k) with sum at most its ``most``, of gcd 1 if reduced."""
    df = rows.withColumns({"v": F.array().cast("array<int>"), "_s": F.lit(0)})
    for i in range(top_k):
        top = (F.col(most) - (F.col(k) - 1 - i) - F.col("_s")).cast("int")
        open_ = F.when(top >= 1, F.sequence(F.lit(1), top)).otherwise(F.array().cast("array<int>"))
        df = df.withColumn("_n", F.explode(F.when(F.col(k) > i, open_).otherwise(F.array(F.lit(0)))))
        df = df.withColumns({"v": F.when(F.col("_n") > 0, F.concat("v", F.array("_n"))).otherwise(F.col("v")), "_s": F.col("_s") + F.col("_n")})
    df = df.filter(F.col(k) <= top_k).drop("_s", "_n")
    return df.filter(fm.gcd_of(F.col("v")) == 1) if reduced else df


def claimed_twice(groups: DataFrame) -> DataFrame:
    """space, element, groups: elements that several groups of a space(space, grp, elements) claim."""
    each = groups.select("space", "grp", F.explode("elements").alias("element")).groupBy("space", "element").agg(F.array_sort(F.collect_set("grp")).alias("groups"))
    return each.filter(F.size("groups") > 1)


def chemical_spaces(groups: DataFrame, top_k: int, max_rare_earths: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(formulas, rejected, refused) of many spaces at once, from groups(space, grp, elements, least, most_of, low, high, most).

    A formula takes least to most_of elements of every group, in counts of gcd 1 with sum at most ``most`` (the space's), of at
    most top_k elements in all. It is rejected where a group's share of its atoms lies outside low to high (null: no bound; the
    first such group by name is the reason). A space in which two groups claim an element is refused whole."""
    twice = claimed_twice(groups).groupBy("space").agg(F.array_join(F.array_sort(F.collect_list("element")), ",").alias("elements"))
    sound = groups.join(twice.select("space"), "space", "left_anti")
    masks = F.sequence(F.lit(0).cast("long"), F.pow(F.lit(2.0), F.size("elements")).cast("long") - 1)
    own = F.transform(masks, lambda m: F.filter(F.array_sort("elements"), lambda _, i: F.getbit(m, i) == 1))
    fits = sound.withColumn("subsets", F.filter(own, lambda s: (F.size(s) >= F.col("least")) & (F.size(s) <= F.col("most_of"))))
    whole = fits.groupBy("space").agg(F.array_sort(F.collect_list(F.struct("grp", "subsets", "low", "high"))).alias("g"), F.max("most").alias("most"))  # a space's groups
    own_of = lambda b, i: F.transform(b, lambda e: F.struct(e.alias("e"), i.alias("i")))
    marked = F.transform("g", lambda g, i: F.transform(g["subsets"], lambda b: own_of(b, i)))
    crossed = F.aggregate(marked, F.array(F.array().cast("array<struct<e:string,i:int>>")), lambda acc, g: F.flatten(F.transform(acc, lambda a: F.transform(g, lambda b: F.concat(a, b)))))
    sets = whole.select("space", "g", "most", F.explode(crossed).alias("_c")).select("space", "g", "most", F.array_sort("_c").alias("_c"))
    # all that a choice has in common for its vectors
    sets = sets.select("space", F.transform("g", lambda g: F.struct(g["grp"], g["low"], g["high"])).alias("g"), "most", F.col("_c.e").alias("elements"), F.col("_c.i").alias("_i")).withColumn("k", F.size("elements")).filter("k > 0")
    sets = sets.withColumn("chemsys", F.array_join("elements", "-"))
    if max_rare_earths is not None:
        sets = sets.filter(F.size(F.array_intersect("elements", F.array(*map(F.lit, fm.RARE_EARTHS)))) <= max_rare_earths)
    sizes = groups.select("most").distinct().withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(top_k))))
    vectors = cut(stoichiometries_of(sizes, "k", "most", top_k), "vectors")
    rows = sets.join(F.broadcast(vectors), ["k", "most"]) if vectors.count() <= VECTORS else stoichiometries_of(sets, "k", "most", top_k)
    rows = rows.withColumn("n_atoms", F.aggregate("v", F.lit(0).cast("long"), lambda a, n: a + n))
    held = lambda i: F.aggregate(F.zip_with("_i", "v", lambda j, n: F.when(j == i, n).otherwise(0)), F.lit(0).cast("long"), lambda a, n: a + n)
    rows = rows.withColumn("_share", F.transform("g", lambda g, i: F.when(g["low"].isNotNull() | g["high"].isNotNull(), held(i) / F.col("n_atoms"))))
    fault = lambda g, s: F.when(s < g["low"] - 1e-12, F.concat(g["grp"], F.lit(" below its share"))).when(s > g["high"] + 1e-12, F.concat(g["grp"], F.lit(" above its share")))
    judged = rows.withColumn("reason", F.get(F.array_compact(F.zip_with("g", "_share", fault)), F.lit(0)))
    formula = F.array_join(F.zip_with("elements", "v", lambda e, n: F.concat(e, n.cast("string"))), "").alias("formula")
    counts = F.map_from_arrays("elements", F.transform("v", lambda n: n.cast("long"))).alias("counts")
    return judged.filter("reason is null").select("space", formula, "chemsys", counts, "n_atoms"), judged.filter("reason is not null").select("space", formula, "reason"), twice


def expand_z(formulas: DataFrame, z_min: str, z_max: str, max_atoms: int) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): a row for each number of formula units; cells above ``max_atoms`` are rejected, not clipped."""
    rows = formulas.filter(F.col(z_min) <= F.col(z_max)).withColumn("z", F.explode(F.sequence(z_min, z_max))).withColumn("cell_atoms", F.col("z") * F.col("n_atoms"))
    over = F.col("cell_atoms") > max_atoms
    return rows.filter(~over), rows.filter(over).withColumn("reason", F.concat(F.lit("cell of "), F.col("cell_atoms").cast("string"), F.lit(f" atoms exceeds {max_atoms}")))


def z_targets(formulas: DataFrame, key: str, z_min: str, z_max: str, max_atoms: int, per_atom: float | None = 2.0, fixed: int | None = None, scope: str = "per_z") -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): formulas(key, n_atoms, z_min, z_max) with z, cell_atoms and n_target, how many cells of that size are asked for.

    One row asks for ``fixed``, or for ``per_atom`` an atom (rounded half to even, at least 1). With scope total a formula has one
    budget, that of its largest cell (or fixed, once), at least 1 for each z, split by what each would ask for alone."""
    rows, rejected = expand_z(formulas, z_min, z_max, max_atoms)
    alone = F.lit(fixed).cast("long") if fixed is not None else F.greatest(F.bround(F.lit(per_atom) * F.col("cell_atoms"), 0).cast("long"), F.lit(1).cast("long"))
    rows = rows.withColumn("n_target", alone)
    if scope == "per_z":
        return rows, rejected
    if scope != "total":
        raise ValueError(f"no such scope: {scope}")
    budget = rows.groupBy(F.col(key).alias("_k")).agg(F.greatest(F.max("n_target"), F.count("*")).alias("_budget"))  # as many rows as z values
    rows = rows.join(budget, F.col(key) == F.col("_k")).withColumnRenamed("n_target", "_alone")
    out = split_total(rows.withColumn("_alone", F.col("_alone").cast("double")), [key], "_budget", "_alone", "z")
    return out.withColumnRenamed("share", "n_target").drop("_k", "_budget", "_alone"), rejected


def produced_shares(rows: DataFrame, formula: str, ask: str, produced: str) -> DataFrame:
    """Adds ``share``: the ask of a formula, split over its rows by what each produced, each rounded half to even; 0 where nothing was."""
    total = rows.groupBy(F.col(formula).alias("_f")).agg(F.sum(produced).alias("_all"))
    out = rows.join(total, F.col(formula) == F.col("_f"))
    share = F.when(F.coalesce("_all", F.lit(0)) > 0, F.bround(F.col(ask) * F.coalesce(produced, F.lit(0)) / F.col("_all"), 0)).otherwise(0)
    return out.withColumn("share", share.cast("long")).drop("_f", "_all")


def split_total(rows: DataFrame, group: list[str], total: str, weight: str, key: str) -> DataFrame:
    """Adds ``share``: the total of a group split by weight, at least 1 each, what the floors leave by largest remainder (ties by key).

    Where the floors of 1 exceed the total, the sum does too."""
    exact = F.col(total) * F.col(weight) / F.col("_w")
    sums = lambda df, c, name: df.groupBy(*group).agg(F.sum(c).alias(name))
    out = rows.join(sums(rows, weight, "_w"), group).withColumn("_x", exact).withColumn("_f", F.greatest(F.floor("_x"), F.lit(1).cast("long")))
    out = out.join(sums(out, "_f", "_all"), group).withColumn("_left", F.col(total) - F.col("_all")).withColumn("_d", F.floor("_x") - F.col("_x"))
    out = numbered(out, group, [F.col("_d"), F.col(key)], "_r").drop("_w", "_all", "_d")
    return out.withColumn("share", F.col("_f") + F.when(F.col("_r") <= F.col("_left"), 1).otherwise(0)).drop("_x", "_f", "_left", "_r")
