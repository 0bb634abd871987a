"""Histories of jobs and states: reconciliation, accounting, throttling, retries, arrays of tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.functions.values import ladder


def merge_status(live: DataFrame, finished: DataFrame, key: str, state: str, terminal: list[str], unknown: str = "unknown") -> DataFrame:
    """key, state, source: what finished overrides only what is absent, unknown, or not terminal while it is itself terminal."""
    a = live.select(key, F.col(state).alias("_l"))
    b = finished.select(key, F.col(state).alias("_f"))
    overrides = F.col("_f").isNotNull() & (F.col("_l").isNull() | (F.col("_l") == unknown) | (~F.col("_l").isin(*terminal) & F.col("_f").isin(*terminal)))
    both = a.join(b, key, "full")
    return both.select(key, F.when(overrides, F.col("_f")).otherwise(F.col("_l")).alias(state), F.when(overrides, "finished").otherwise("live").alias("source"))


def aggregate_tasks(tasks: DataFrame, job: str, state: str, live_order: list[str], terminal_order: list[str], elapsed: str, cpus: str) -> DataFrame:
    """job, state, elapsed, cpus: the best live state if any task lives, else the worst terminal one; longest time, all cpus."""
    place = lambda order: F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(state)), F.lit(0).cast("long"))
    grouped = tasks.groupBy(job).agg(F.min_by(state, place(live_order)).alias("_live"), F.min_by(state, place(terminal_order)).alias("_done"), F.max(elapsed).alias(elapsed), F.sum(cpus).alias(cpus))
    return grouped.select(job, F.coalesce("_live", "_done").alias(state), elapsed, cpus)


def promote_causes(jobs: DataFrame, steps: DataFrame, job: str, state: str, cause: str) -> DataFrame:
    """jobs whose step (``job.step``) stopped for a cause take that cause as their state."""
    caused = steps.filter(F.col(state) == cause).select(F.substring_index("step", ".", 1).alias(job)).distinct().withColumn("_c", F.lit(True))
    return jobs.join(caused, job, "left").withColumn(state, F.when(F.col("_c"), cause).otherwise(F.col(state))).drop("_c")


def share_out(rows: DataFrame, whole: DataFrame, job: str, hours: str) -> DataFrame:
    """rows of a job without an answer of their own get an even share of the whole job's hours."""
    w = W.partitionBy(job)
    lacking = F.sum(F.when(F.col(hours).isNull(), 1).otherwise(0)).over(w)
    marked = rows.withColumn("_n", lacking).join(whole.select(job, F.col(hours).alias("_all")), job, "left")
    return marked.withColumn(hours, F.coalesce(hours, F.try_divide("_all", F.nullif("_n", F.lit(0).cast("long"))))).drop("_n", "_all")


def accounting(jobs: DataFrame, group: list[str], state: str, hours: str, done: list[str], running: list[str]) -> DataFrame:
    """n, spent, in_flight, mean_done and projected (in-flight jobs at the mean of done ones with hours) by group."""
    is_done, runs = F.col(state).isin(*done), F.col(state).isin(*running)
    out = jobs.groupBy(*group).agg(
        F.count("*").alias("n"),
        F.sum(F.when(is_done, F.coalesce(hours, F.lit(0.0))).otherwise(0.0)).alias("spent"),
        F.sum(F.when(runs, 1).otherwise(0)).alias("in_flight"),
        F.avg(F.when(is_done & (F.col(hours) > 0), F.col(hours))).alias("mean_done"),
    )
    return out.withColumn("projected", F.col("spent") + F.col("in_flight") * F.coalesce("mean_done", F.lit(0.0)))


def outcomes(attempts: DataFrame, engine: str, entity: str, converged: str) -> DataFrame:
    """engine, outcome, n in distinct entities: converged; not converged by any attempt; retried, with attempts of both kinds. Zeros are left out."""
    by_entity = attempts.groupBy(engine, entity).agg(F.max(F.col(converged).cast("int")).alias("ok"), F.min(F.col(converged).cast("int")).alias("all_ok"))
    counts = by_entity.groupBy(engine).agg(F.sum("ok").alias("converged"), F.sum(1 - F.col("ok")).alias("not_converged"), F.sum(F.when(F.col("ok") > F.col("all_ok"), 1).otherwise(0)).alias("retried"))
    return counts.unpivot([engine], ["converged", "not_converged", "retried"], "outcome", "n").filter("n > 0")


def yield_of(rows: DataFrame, target: str, produced: str) -> DataFrame:
    """One row: n, target, produced and short (fewer than asked); zeros on no rows."""
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return rows.agg(F.count("*").alias("n"), zero(F.sum(target)).alias("target"), zero(F.sum(produced)).alias("produced"), zero(F.sum(F.when(F.col(produced) < F.col(target), 1).otherwise(0))).alias("short"))


def throttle(loads: DataFrame, in_flight: str, limits: list[tuple[str, Column]], floor: int = 0) -> DataFrame:
    """Adds ``room`` (least limit less what is in flight, at least ``floor``) and ``binding``, the first limit that gives it."""
    out = loads.withColumn("_least", F.least(*(c for _, c in limits), F.lit(2**31 - 1)))
    binding = ladder(*((c == F.col("_least"), name) for name, c in limits))
    return out.withColumns({"room": F.greatest(F.col("_least") - F.col(in_flight), F.lit(floor)), "binding": binding}).drop("_least")


def retry(jobs: DataFrame, triggers: Column, rules: list[tuple[str, str, int]], attempts: str) -> DataFrame:
    """Adds ``action``: of the first rule (trigger, action, most attempts) that is triggered, or give_up beyond its attempts; null without a rule."""
    steps = [(F.array_contains(triggers, when), F.when(F.col(attempts) < most, action).otherwise("give_up")) for when, action, most in rules]
    return jobs.withColumn("action", ladder(*steps, otherwise=F.lit(None).cast("string")))


def reconcile(tables: dict[str, DataFrame], key: str, state: str) -> DataFrame:
    """key, a state of every named source, and ``agrees``: full outer joins of what each says."""
    out = None
    for name, table in tables.items():
        one = table.select(key, F.col(state).alias(name))
        out = one if out is None else out.join(one, key, "full")
    names = list(tables)
    same = F.lit(True)
    for name in names[1:]:
        same = same & F.col(names[0]).eqNullSafe(F.col(name))
    return out.withColumn("agrees", same)


def task_estimate(rows: DataFrame, group: str, size: int) -> DataFrame:
    """One row: n, tasks = sum over groups of ceil(rows / size)."""
    counts = rows.groupBy(group).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.ceil(F.col("n") / size)), F.lit(0)).alias("tasks"))
