"""Gates that record why each row passed or failed, and the tables made of their events.

An event is (id, gate, passed, value, threshold, detail). A cascade judges every row by its gates in order; a row's first
failure is its reason, and later gates only see rows that passed the earlier ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gate:
    """A named predicate; null counts as failed unless ``null_passes``."""

    name: str
    passed: Column
    value: Column | None = None
    threshold: float | None = None
    null_passes: bool = False

    def holds(self) -> Column:
        return F.coalesce(self.passed, F.lit(self.null_passes))


def at_most(name: str, column: str, threshold: float, null_passes: bool = False) -> Gate:
    return Gate(name, F.col(column) <= threshold, F.col(column), threshold, null_passes)


def at_least(name: str, column: str, threshold: float, null_passes: bool = False) -> Gate:
    return Gate(name, F.col(column) >= threshold, F.col(column), threshold, null_passes)


def judge(rows: DataFrame, gates: list[Gate]) -> DataFrame:
    """Adds ``reason``, the first gate that fails (null if none), in one projection."""
    reason = F.lit(None).cast("string")
    for gate in reversed(gates):
        reason = F.when(~gate.holds(), F.lit(gate.name)).otherwise(reason)
    return rows.withColumn("reason", reason)


def events(judged: DataFrame, gates: list[Gate], id_column: str) -> DataFrame:
    """One event a row and gate that it reached, unpivoted from the judged frame."""
    names = F.array(*(F.lit(g.name) for g in gates))
    stopped = F.coalesce(F.array_position(names, F.col("reason")), F.lit(len(gates))).cast("int")
    each = [F.struct(F.lit(g.name).alias("gate"), g.holds().alias("passed"), (g.value if g.value is not None else F.lit(None)).cast("double").alias("value"), F.lit(g.threshold).cast("double").alias("threshold")) for g in gates]
    reached = F.slice(F.array(*each), F.lit(1), stopped)
    return judged.select(F.col(id_column).alias("id"), F.explode(reached).alias("e")).select("id", "e.*")


def cap_per_group(rows: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """Adds rank, group_size and ``kept`` for at most n of a group, in a total order."""
    w = W.partitionBy(group)
    return rows.withColumns({"rank": F.row_number().over(w.orderBy(*order)), "group_size": F.count("*").over(w)}).withColumn("kept", F.col("rank") <= n)


def funnel(gate_events: DataFrame, order: list[str]) -> DataFrame:
    """gate, seen, passed, rejected and place: the fixed gates in order, then the others by name."""
    counts = gate_events.groupBy("gate").agg(F.count("*").alias("seen"), F.sum(F.when(F.col("passed"), 1).otherwise(0)).alias("passed"))
    at = F.array_position(F.array(*map(F.lit, order)), F.col("gate"))
    return counts.withColumns({"rejected": F.col("seen") - F.col("passed"), "place": F.when(at > 0, at).otherwise(F.lit(len(order) + 1))})


def rejection_log(judged: DataFrame, id_column: str, reasons: list[str], examples: int = 5) -> DataFrame:
    """reason, n, examples (least ids): a row for each known reason, also those that rejected nothing.

    The least ids are kept by a window, so no list grows with the rows."""
    spark = judged.sparkSession
    known = spark.createDataFrame([(r,) for r in reasons], "reason string")
    rejected = judged.filter(F.col("reason").isNotNull()).select("reason", F.col(id_column).alias("id"))
    counts = rejected.groupBy("reason").agg(F.count("*").alias("n"))
    first = rejected.withColumn("r", F.row_number().over(W.partitionBy("reason").orderBy("id"))).filter(F.col("r") <= examples)
    first = first.groupBy("reason").agg(F.array_sort(F.collect_list("id")).alias("examples"))
    return known.join(counts, "reason", "full").join(first, "reason", "left").select("reason", F.coalesce("n", F.lit(0)).alias("n"), "examples")


def calibrated_threshold(calibrations: DataFrame, literal: float, prefer: tuple[str, ...] = ("pilot", "mp")) -> DataFrame:
    """(threshold, how) in one row: (literal - beta) / alpha of the newest fit of the preferred kind, else the literal."""
    usable = calibrations.filter(F.col("alpha").isNotNull() & (F.col("alpha") != 0) & F.col("beta").isNotNull() & F.col("kind").isin(*prefer))
    place = F.array_position(F.array(*map(F.lit, prefer)), F.col("kind"))
    best = usable.agg(F.max_by(F.struct("alpha", "beta", "kind"), F.struct(-place, F.col("id"))).alias("fit"))
    return best.select(
        F.coalesce((F.lit(literal) - F.col("fit.beta")) / F.col("fit.alpha"), F.lit(literal)).alias("threshold"),
        F.when(F.col("fit").isNull(), "literal (no calibration fit available)").otherwise(F.concat(F.lit("calibrated by "), F.col("fit.kind"))).alias("how"),
    )


def last_stop(gate_events: DataFrame, id_column: str, seq: str, prefixes: tuple[str, ...] = ()) -> DataFrame:
    """id, gate, value of the newest failed event of each id, of gates that begin with a prefix if any is given."""
    failed = gate_events.filter(~F.col("passed"))
    if prefixes:
        failed = failed.filter(F.col("gate").rlike("^(" + "|".join(prefixes) + ")"))
    return failed.groupBy(id_column).agg(F.max_by(F.struct("gate", "value"), F.col(seq)).alias("s")).select(id_column, "s.gate", "s.value")
