"""Agreement of two estimates of one quantity: errors, rank correlation, fits, verdicts, samples."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.sources.folders import cut

#: Distinct values of a column whose ranks are sent to all tasks, a few numbers each.
RANKS = 200_000


def parity(points: DataFrame, group: list[str], a: str, b: str) -> DataFrame:
    """n, mae, rmse, bias, worst of a - b by group, over pairs with both values."""
    err = F.col(a) - F.col(b)
    both = points.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumn("_e", err)
    return both.groupBy(*group).agg(F.count("*").alias("n"), F.avg(F.abs("_e")).alias("mae"), F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"), F.avg("_e").alias("bias"), F.max(F.abs("_e")).alias("worst"))


def running_counts(counts: DataFrame, group: list[str], column: str, n: str | list[str]) -> DataFrame:
    """Adds ``_below``, how many rows of the group have a smaller value, to counts by distinct value (of a list of counts: ``_below_`` and its name).

    The counts are dealt over ranges of (group, value) once; a value has below it those of its own part and the totals of the
    group's parts before, so no window holds a group. Nulls are smallest, as in an ascending order."""
    names = {n: "_below"} if isinstance(n, str) else {c: f"_below_{c}" for c in n}
    spread = counts.repartitionByRange(*group, column).withColumn("_part", F.spark_partition_id())
    spread = cut(spread, "ranges")
    totals = spread.groupBy(*group, "_part").agg(*(F.sum(c).alias(f"_t_{c}") for c in names))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, 0)
    earlier = [(F.sum(f"_t_{c}").over(before) - F.col(f"_t_{c}")).alias(f"_before_{c}") for c in names]
    totals = totals.select(*(F.col(g).alias(f"_g_{g}") for g in group), F.col("_part").alias("_p"), *earlier)
    inside = W.partitionBy(*group, "_part").orderBy(column).rowsBetween(W.unboundedPreceding, 0)
    same = F.col("_part") == F.col("_p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    out = spread.withColumns({f"_inside_{c}": F.sum(c).over(inside) - F.col(c) for c in names}).join(totals, same)
    out = out.withColumns({name: F.col(f"_before_{c}") + F.col(f"_inside_{c}") for c, name in names.items()})
    return out.drop("_part", "_p", *(f"_before_{c}" for c in names), *(f"_inside_{c}" for c in names), *(f"_g_{g}" for g in group))


def average_ranks(rows: DataFrame, group: list[str], column: str, name: str) -> DataFrame:
    """Adds the rank of a number in its group, ties sharing their mean rank: from counts by distinct value."""
    counts = rows.groupBy(*group, column).agg(F.count("*").alias("_n"))
    ranks = running_counts(counts, group, column, "_n").withColumn(name, F.col("_below") + (F.col("_n") + 1) / 2.0).drop("_n", "_below")
    return rows.join(ranks, [*group, column])


def spearman(points: DataFrame, group: list[str], a: str, b: str, least: int = 2) -> DataFrame:
    """n and rho by group; null for fewer than ``least`` points or a constant side."""
    both = points.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*group, a, b).agg(F.count("*").alias("_m"))
    for column, name in ((a, "_ra"), (b, "_rb")):
        counts = both.groupBy(*group, column).agg(F.sum("_m").alias("_n"))
        ranks = running_counts(counts, group, column, "_n").withColumn(name, F.col("_below") + (F.col("_n") + 1) / 2.0).drop("_n", "_below")
        both = both.join(ranks, [*group, column])
    m, x, y = F.col("_m"), F.col("_ra"), F.col("_rb")
    sums = both.groupBy(*group).agg(F.sum(m).alias("n"), F.sum(m * x).alias("sx"), F.sum(m * x * x).alias("sxx"), F.sum(m * y * y).alias("syy"), F.sum(m * x * y).alias("sxy"))
    mean = F.col("sx") / F.col("n")  # of either side's ranks
    cov, va, vb = F.col("sxy") - F.col("n") * mean * mean, F.col("sxx") - F.col("n") * mean * mean, F.col("syy") - F.col("n") * mean * mean
    rho = F.when(F.col("n") >= least, F.try_divide(cov, F.nullif(F.sqrt(va * vb), F.lit(0.0))))
    return sums.select(*group, "n", rho.alias("rho"))


def _rho(n: Column, sxx: Column, syy: Column, sxy: Column, least: int) -> Column:
    square = n * ((n + 1) / 2.0) * ((n + 1) / 2.0)  # of the mean rank of either side
    return F.when(n >= least, F.try_divide(sxy - square, F.nullif(F.sqrt((sxx - square) * (syy - square)), F.lit(0.0))))


def rank_correlations(rows: DataFrame, columns: list[str], least: int = 2) -> DataFrame:
    """a, b, n, rho: spearman of every pair of columns over the rows that have both.

    Every column is ranked once, beside each of the others (among the rows that have that one too), and all pairs are summed in one
    pass: rows aren't copied for each pair."""
    rows = rows.select(*(F.col(c).cast("double").alias(c) for c in columns))
    at, k = {c: i for i, c in enumerate(columns)}, len(columns)
    each = rows.select(F.explode(F.array(*(F.struct(F.lit(at[c]).alias("c"), F.col(c).alias("v"), *(F.col(d).isNotNull().cast("int").alias(f"n{at[d]}") for d in columns)) for c in columns))).alias("s")).select("s.*")
    beside = [f"n{i}" for i in range(k)]
    counts = each.filter("v is not null").groupBy("c", "v").agg(*(F.sum(n).alias(n) for n in beside))
    ranks = running_counts(counts, ["c"], "v", beside)
    ranks = cut(ranks.select("c", "v", *((F.col(f"_below_{n}") + (F.col(n) + 1) / 2.0).alias(f"r{i}") for i, n in enumerate(beside))), "ranks")
    sizes = {r.c: r["count"] for r in ranks.groupBy("c").count().collect()}
    for c in sorted(columns, key=lambda c: -sizes.get(at[c], 0)):
        own = ranks.filter(F.col("c") == at[c]).select(F.col("v").alias(f"_v{at[c]}"), *(F.col(f"r{i}").alias(f"_r{at[c]}_{i}") for i in range(k) if i != at[c]))
        own = F.broadcast(own) if sizes.get(at[c], 0) <= RANKS else own
        rows = rows.join(own, F.col(c) == F.col(f"_v{at[c]}"), "left").drop(f"_v{at[c]}")
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
    sums = []
    for i, j in pairs:
        both, x, y = F.col(columns[i]).isNotNull() & F.col(columns[j]).isNotNull(), F.col(f"_r{i}_{j}"), F.col(f"_r{j}_{i}")
        total = lambda v, both=both: F.sum(F.when(both, v))
        sums.append(F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), F.count_if(both).alias("n"), total(x * x).alias("xx"), total(y * y).alias("yy"), total(x * y).alias("xy")))
    out = rows.agg(F.array(*sums).alias("s")).select(F.explode("s").alias("s")).select("s.*").filter("n > 0")
    return out.select("a", "b", "n", _rho(F.col("n"), F.col("xx"), F.col("yy"), F.col("xy"), least).alias("rho"))


def share_weighted_mae(points: DataFrame, part: str, error: str, share: str) -> DataFrame:
    """part, n, mae: mean over the points that hold a part of |error| times its share (not divided by the shares)."""
    return points.groupBy(part).agg(F.count("*").alias("n"), F.avg(F.abs(error) * F.col(share)).alias("mae"))


def fit_line(points: DataFrame, group: list[str], x: str, y: str) -> DataFrame:
    """n, alpha, beta, r2 of y = alpha * x + beta; null for fewer than 3 points or a constant x; r2 null for a constant y."""
    both = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    sums = both.groupBy(*group).agg(F.count("*").alias("n"), F.regr_slope(y, x).alias("alpha"), F.regr_intercept(y, x).alias("beta"), F.regr_r2(y, x).alias("r2"), F.regr_sxx(y, x).alias("_sxx"), F.regr_syy(y, x).alias("_syy"))
    ok = (F.col("n") >= 3) & (F.col("_sxx") > 0)
    return sums.select(*group, "n", F.when(ok, F.col("alpha")).alias("alpha"), F.when(ok, F.col("beta")).alias("beta"), F.when(ok & (F.col("_syy") > 0), F.col("r2")).alias("r2"))


def upper_median(values: Column) -> Column:
    """Of an array: the element in the middle, the upper of two."""
    return F.try_element_at(F.array_sort(values), (F.floor(F.size(values) / 2) + 1).cast("int"))


def verdict(fails: list[tuple[Column, str]], warns: list[tuple[Column, str]]) -> tuple[Column, Column]:
    """(verdict, reasons): fail before warn before pass, with the reasons of both in order."""
    named = [F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for c, r in (*fails, *warns)]
    any_of = lambda pairs: F.coalesce(F.greatest(*(F.coalesce(c, F.lit(False)).cast("int") for c, _ in pairs), F.lit(0)), F.lit(0)) == 1
    return F.when(any_of(fails), "fail").when(any_of(warns), "warn").otherwise("pass"), F.array_compact(F.array(*named))


def top_n_agreement(rows: DataFrame, key: str, a: str, b: str, n: int) -> DataFrame:
    """One row: n, shared, agreement and the keys of the b-side top n that the a-side misses, by least values, ties by key."""
    first = lambda c, name: rows.filter(F.col(c).isNotNull()).orderBy(c, key).limit(n).select(key, F.lit(True).alias(name))
    both = first(a, "in_a").join(first(b, "in_b"), key, "full")
    return both.agg(
        F.sum(F.when(F.col("in_b"), 1).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("in_a") & F.col("in_b"), 1).otherwise(0)).alias("shared"),
        F.array_sort(F.collect_list(F.when(F.col("in_b") & F.col("in_a").isNull(), F.col(key)))).alias("missed"),
    ).withColumn("agreement", F.try_divide(F.col("shared"), F.col("n")))


def positions(n_rows: Column, n: int) -> Column:
    """n evenly spaced places in 0 .. n_rows - 1, both ends in, half-even; doubled places collapse."""
    last = F.greatest(n_rows - 1, F.lit(0))
    at = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.bround(i * last / F.lit(max(1, n - 1)), 0).cast("long"))
    return F.array_distinct(at)


def stratified_sample(rows: DataFrame, value: str, key: str, n: int, fill: bool = True) -> DataFrame:
    """n rows spread over the order of a value (ties by key), filled up with the first others where places coincide.

    Places are found without ordering the rows in one task: counts by distinct value give each value's first place."""
    counts = rows.groupBy(value).agg(F.count("*").alias("_n"))
    starts = running_counts(counts, [], value, "_n").withColumnRenamed("_below", "_s").drop("_n")
    placed = rows.join(starts, rows[value].eqNullSafe(starts[value])).drop(starts[value])
    placed = placed.withColumn("_at", F.col("_s") + F.row_number().over(W.partitionBy(value).orderBy(key)) - 1)
    total = rows.agg(F.count("*").alias("_total"))
    wanted = total.select(F.explode(positions(F.col("_total"), n)).alias("_at"))
    chosen = placed.join(F.broadcast(wanted), "_at", "left_semi")
    if fill:
        short = n - wanted.count()  # n places at most
        if short > 0:
            more = placed.join(F.broadcast(wanted), "_at", "left_anti").orderBy("_at").limit(short)
            chosen = chosen.unionByName(more)
    return chosen.drop("_s").withColumnRenamed("_at", "place")


def share_r2(points: DataFrame, key: str, part: str, share: str, y: str) -> DataFrame:
    """One row: n, parts, r2 of least squares of y on the shares alone, no intercept; null if n < 3, parts >= n or y is constant.

    Sums of products by pairs of parts are made by Spark; only that table, parts squared, is solved in one place."""
    a = points.select(F.col(key).alias("k"), F.col(part).alias("p"), F.col(share).alias("s"), F.col(y).alias("y"))
    b = a.select("k", F.col("p").alias("q"), F.col("s").alias("t"))
    gram = a.join(b, "k").groupBy("p", "q").agg(F.sum(F.col("s") * F.col("t")).alias("v"))
    right = a.groupBy(F.col("p")).agg(F.sum(F.col("s") * F.col("y")).alias("v")).select("p", F.lit(None).cast("string").alias("q"), "v")
    one = a.groupBy("k").agg(F.first("y").alias("y")).agg(F.count("*").alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"))

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        n, sy, syy = int(rows.n.iloc[0]), rows.sy.iloc[0], rows.syy.iloc[0]
        parts = sorted(rows.p.unique())
        at = {p: i for i, p in enumerate(parts)}
        m, v = np.zeros((len(parts), len(parts))), np.zeros(len(parts))
        for r in rows.itertuples():
            if r.q is None or r.q != r.q:
                v[at[r.p]] = r.v
            else:
                m[at[r.p], at[r.q]] = r.v
        w = np.linalg.pinv(m) @ v
        total, rest = syy - sy * sy / n, syy - 2 * w @ v + w @ m @ w
        r2 = 1 - rest / total if n >= 3 and len(parts) < n and total > 0 else None
        return pd.DataFrame({"n": [n], "parts": [len(parts)], "r2": [r2]})

    table = gram.unionByName(right).crossJoin(one)  # one row on the right
    return table.groupBy(F.lit(1).alias("_")).applyInPandas(lambda rows: solve(rows), "n long, parts long, r2 double")


def duplicates_report(entries: DataFrame, formula: str, source: str, epa: str) -> DataFrame:
    """formula, n, sources, spread of formulas with several entries from several non-blank sources."""
    blank = F.nullif(F.trim(source), F.lit(""))
    return entries.groupBy(formula).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(blank)).alias("sources"), (F.max(epa) - F.min(epa)).alias("spread")).filter("n > 1 and size(sources) > 1")
