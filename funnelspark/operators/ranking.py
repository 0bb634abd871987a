"""Orders, caps, queues, fronts and positions in sequences; every order is total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.sources.folders import cut

#: Rows that a task sorts, where their number is known.
PART = 1_000_000


def pareto_front(rows: DataFrame, group: list[str], least: str, most: str, parts: int = 1) -> DataFrame:
    """Rows that none dominates (least down, most up, one strictly); ties stay, nulls are left out.

    The best of each least-value must beat the running maximum of the cheaper ones. With parts > 1 fronts of parts come first,
    which leaves few rows of a large group to its last task; the front of fronts is the same."""
    rows = rows.filter(F.col(least).isNotNull() & F.col(most).isNotNull())
    keys = [group] if parts == 1 else [[*group, "_part"], group]
    if parts > 1:
        rows = rows.withColumn("_part", F.pmod(F.xxhash64(least, most), F.lit(parts)))
    for key in keys:
        best = rows.groupBy(*key, least).agg(F.max(most).alias(most))
        cheaper = F.max(most).over(W.partitionBy(*key).orderBy(least).rowsBetween(W.unboundedPreceding, -1))
        front = best.withColumn("_cheaper", cheaper).filter(F.col("_cheaper").isNull() | (F.col(most) > F.col("_cheaper"))).drop("_cheaper")
        rows = rows.join(front, [*key, least, most], "left_semi")
    return rows.drop("_part") if parts > 1 else rows


def queue(rows: DataFrame, started: Column, by: str, key: str, cap: int) -> DataFrame:
    """Adds ``place`` and ``admitted``: what has started first, then by a rank (nulls last), then by key; at least all started are admitted.

    The first places are a limit, so the whole queue is never in one task."""
    marked = rows.withColumn("_started", F.coalesce(started, F.lit(False)))
    n = marked.filter("_started").count()
    first = marked.orderBy(F.desc("_started"), F.asc_nulls_last(by), key).limit(max(cap, n))
    return first.withColumn("place", F.row_number().over(W.orderBy(F.desc("_started"), F.asc_nulls_last(by), key))).drop("_started")


def candidate_order(dft: str, mlip: str, key: str) -> list[Column]:
    """Those with the better measurement first, by it; then by the other; then the rest."""
    return [F.when(F.col(dft).isNotNull(), 0).when(F.col(mlip).isNotNull(), 1).otherwise(2), F.coalesce(dft, mlip).asc_nulls_last(), F.col(key)]


def latest(rows: DataFrame, group: list[str], seq: str, columns: list[str]) -> DataFrame:
    """The newest row of each group, by an aggregate that merges before the shuffle."""
    return rows.groupBy(*group).agg(F.max_by(F.struct(*columns), F.col(seq)).alias("_l")).select(*group, *(f"_l.{c}" for c in columns))


def tail_swing(rows: DataFrame, group: str, seq: str, value: str, n: int = 10) -> DataFrame:
    """group, n, swing: max - min over the last n rows of each."""
    last = rows.withColumn("_r", F.row_number().over(W.partitionBy(group).orderBy(F.desc(seq)))).filter(F.col("_r") <= n)
    return last.groupBy(group).agg(F.count("*").alias("n"), (F.max(value) - F.min(value)).alias("swing"))


def step_consistency(rows: DataFrame, group: str, seq: str, energy: str, moment: str, energy_limit: float, moment_limit: float) -> DataFrame:
    """Adds ``verdict`` against the step before: ok within the energy limit (or unmeasurable), else moment_changed or energy_only."""
    w = W.partitionBy(group).orderBy(seq)
    de, dm = F.abs(F.col(energy) - F.lag(energy).over(w)), F.abs(F.col(moment) - F.lag(moment).over(w))
    out = rows.withColumns({"d_energy": de, "d_moment": dm})
    ok = F.col("d_energy").isNull() | (F.col("d_energy") <= energy_limit)
    return out.withColumn("verdict", F.when(ok, "ok").when(F.col("d_moment") > moment_limit, "moment_changed").otherwise("energy_only"))


def numbered(rows: DataFrame, group: list[str], by: list[Column], name: str, n_rows: int = 0) -> DataFrame:
    """Adds the place of a row, from 1, in the total order of its group, without a group in one task.

    Rows are range-partitioned, sorted and written with their place in the part; to that a row adds the number of rows of its
    group in the parts before, and the part's rows of earlier groups don't count. n_rows, if known, bounds the rows of a part."""
    keys = [*map(F.col, group), *by]
    parts = parts_of(rows, n_rows)
    dealt = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    place = F.monotonically_increasing_id()  # the part, and 33 bits of the place in it
    spread = dealt.sortWithinPartitions(*keys).withColumn("_id", place)
    spread = cut(spread.withColumns({"_part": F.shiftright("_id", 33), "_own": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_id"), "numbered")
    counts = spread.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_own").alias("_start"))
    before = F.sum("_n").over(W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")
    offsets = counts.select(*(F.col(g).alias(f"_{g}") for g in group), F.col("_part").alias("_at"), (before - F.col("_start") + 1).alias("_before"))
    same = spread["_part"] == offsets["_at"]
    for g in group:
        same = same & spread[g].eqNullSafe(offsets[f"_{g}"])
    return spread.join(offsets, same).withColumn(name, F.col("_before") + F.col("_own")).drop("_own", "_part", "_at", "_before", *(f"_{g}" for g in group))


def parts_of(rows: DataFrame, n_rows: int) -> int:
    """How many parts so many rows need beyond the session's, 0 if those do."""
    n = -(-n_rows // PART)
    return n if n > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else 0


def claims(rows: DataFrame, by: list[Column], size: int, group: list[str] | None = None) -> DataFrame:
    """Adds ``chunk``, numbers of chunks of at most ``size`` rows in order, within each group if given."""
    return numbered(rows, group or [], by, "_place").withColumn("chunk", F.floor((F.col("_place") - 1) / size)).drop("_place")


def idle_runs(cycles: DataFrame, seq: str, active: str, group: list[str]) -> DataFrame:
    """Adds ``idle``: consecutive cycles without activity up to this one."""
    w = W.partitionBy(*group).orderBy(seq)
    island = F.sum(F.when(F.col(active), 1).otherwise(0)).over(w)
    return cycles.withColumn("_i", island).withColumn("idle", F.sum(F.when(F.col(active), 0).otherwise(1)).over(W.partitionBy(*group, "_i").orderBy(seq))).drop("_i")


def segments(lines: DataFrame, group: str, seq: str, closes: Column) -> DataFrame:
    """group, segment, n: rows in each run that a closing row ends, and in the open one after it."""
    w = W.partitionBy(group).orderBy(seq).rowsBetween(W.unboundedPreceding, -1)
    numbered = lines.withColumn("segment", F.coalesce(F.sum(F.when(closes, 1).otherwise(0)).over(w), F.lit(0)))
    return numbered.groupBy(group, "segment").agg(F.count("*").alias("n"))
