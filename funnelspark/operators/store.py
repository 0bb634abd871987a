"""Operations of a store of records: what to add, submit, exclude or requeue, who won, what is missing and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.functions import records as rec
from funnelspark.operators import hull, ranking


def tally(rows: DataFrame, by: list[str], top: int | None = None) -> DataFrame:
    """Counts by reason, verdict or source, most first, ties by name; the first ``top`` of them if given."""
    out = rows.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by)
    return out.limit(top) if top else out


def additions(found: DataFrame, store: DataFrame, key: str, distance: str, geometry: str, cut: float) -> DataFrame:
    """Adds ``action`` to found rows: ``have``, ``far`` (above the cut; an unknown distance isn't), ``no_geometry`` or ``create``."""
    have = store.select(F.col(key).alias("_k")).distinct().withColumn("_have", F.lit(True))
    joined = found.join(have, found[key] == F.col("_k"), "left").drop("_k")
    action = F.when(F.col("_have"), "have").when(F.col(distance) > cut, "far").when(F.col(geometry).isNull(), "no_geometry").otherwise("create")
    return joined.withColumn("action", action).drop("_have")


def to_submit(index: DataFrame, key: str, ready: Column, ignored: DataFrame, in_flight: DataFrame, inside: Column, by: str, limit: int | None = None) -> DataFrame:
    """Rows to hand to the scheduler: not ready, not ignored, in no live job, inside the asked system; the first ``limit`` by order."""
    rows = index.filter(~F.coalesce(ready, F.lit(False)) & inside)
    rows = rows.join(ignored.select(key).distinct(), key, "left_anti").join(in_flight.select(key).distinct(), key, "left_anti").orderBy(by)
    return rows.limit(limit) if limit else rows


def outstanding(index: DataFrame, key: str, ready: Column, ignored: DataFrame) -> DataFrame:
    """Adds ``standing``: ready, ignored or outstanding."""
    skip = ignored.select(F.col(key).alias("_k")).distinct().withColumn("_s", F.lit(True))
    joined = index.join(skip, index[key] == F.col("_k"), "left").drop("_k")
    return joined.withColumn("standing", F.when(ready, "ready").when(F.col("_s"), "ignored").otherwise("outstanding")).drop("_s")


def requeue(rows: DataFrame, state: str, fault: str, contains: str) -> DataFrame:
    """Adds ``action`` to failed rows: ``requeue`` where the fault of the last stage is there and holds a text, ``skip`` where they failed before it, else ``leave``."""
    found = rows.filter(F.col(state) == "failed")
    return found.withColumn("action", F.when(F.coalesce(fault, F.lit("")) == "", "skip").when(F.contains(F.col(fault), F.lit(contains)), "requeue").otherwise("leave"))


def excluded(rows: DataFrame, wanted: DataFrame, key: str, state: str, reason: str) -> DataFrame:
    """Rows with the asked ones filtered out and the reason kept; what is done is refused (``refused`` says so)."""
    ask = wanted.select(F.col(key).alias("_k"), F.col(reason).alias("_r")).dropDuplicates(["_k"])
    joined = rows.join(ask, rows[key] == F.col("_k"), "left")
    asked, done = F.col("_k").isNotNull(), F.col(state) == "dft_done"
    out = joined.withColumn("refused", asked & done).withColumn("exclusion", F.when(asked & ~done, F.col("_r")))
    return out.withColumn(state, F.when(asked & ~done, F.lit("filtered_out")).otherwise(F.col(state))).drop("_k", "_r")


def handed_back(claims: DataFrame, task: str, finished: DataFrame) -> DataFrame:
    """Claims of finished tasks only."""
    return claims.join(finished.select(task).distinct(), task, "left_semi")


def recarried(structures: DataFrame, outputs: DataFrame, key: str, state: str, geometry: str, busy: list[str]) -> DataFrame:
    """Structures with the geometry of their task's output, but for those that have gone on."""
    new = outputs.select(F.col(key).alias("_k"), F.col(geometry).alias("_g"))
    joined = structures.join(new, structures[key] == F.col("_k"), "left")
    take = F.col("_g").isNotNull() & ~F.col(state).isin(*busy)
    return joined.withColumn("recarried", take).withColumn(geometry, F.when(take, F.col("_g")).otherwise(F.col(geometry))).drop("_k", "_g")


def latest_faults(logs: DataFrame, folder: str, written: str, fault: str) -> DataFrame:
    """folder, fault of its newest log; a clean one clears what came before."""
    newest = logs.groupBy(folder).agg(F.max_by(F.struct(fault), F.struct(written, F.coalesce(fault, F.lit("")))).alias("l"))
    return newest.select(folder, F.col(f"l.{fault}").alias(fault)).filter(F.col(fault).isNotNull())


def first_bad_step(steps: DataFrame, key: str, seq: str, name: str, converged: str, marker: str) -> DataFrame:
    """key, step: the step that a job's own mark names, else its first one that isn't converged; null where all are."""
    bad = F.min_by(F.col(name), F.when(~F.coalesce(F.col(converged), F.lit(False)), F.col(seq)))
    return steps.groupBy(key).agg(F.coalesce(F.max(F.when(F.col(marker) == F.col(name), F.col(name))), bad).alias("step"))


def note_summary(notes: DataFrame, system: str, reason: str, show: int = 3) -> DataFrame:
    """reason (its first sentence), n, systems: the first few and how many more."""
    named = notes.select(F.col(system).alias("s"), rec.short_reason(F.col(reason)).alias("reason"))
    counts = named.groupBy("reason").agg(F.count("*").alias("n"))
    place = F.row_number().over(W.partitionBy("reason").orderBy("s"))  # cut to so many rows before the shuffle
    first = named.filter("s is not null").distinct().withColumn("_p", place).filter(F.col("_p") <= show)
    first = first.groupBy(F.col("reason").alias("_r")).agg(F.array_sort(F.collect_list("s")).alias("all"))
    more = F.when(F.col("n") > show, F.concat(F.lit(" and "), (F.col("n") - show).cast("string"), F.lit(" more"))).otherwise("")
    joined = counts.join(first, F.col("reason").eqNullSafe(F.col("_r")), "left")
    return joined.select("reason", "n", F.concat(F.array_join(F.coalesce("all", F.array().cast("array<string>")), ", "), more).alias("systems"))


def batch_stats(results: DataFrame, error: str, converged: str) -> DataFrame:
    """One row: total, converged, step_limited, rejected, failed."""
    bad = F.coalesce(F.col(error), F.lit("")) != ""
    rejected = bad & F.startswith(F.col(error), F.lit("rejected:"))
    n = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0)).cast("long")
    return results.agg(F.count("*").alias("total"), n(~bad & F.col(converged)).alias("converged"), n(~bad & ~F.coalesce(F.col(converged), F.lit(False))).alias("step_limited"), n(rejected).alias("rejected"), n(bad & ~rejected).alias("failed"))


def absorbed(results: DataFrame, key: str, epa: str, converged: str, error: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(relaxations, states, events) that worker results give: one pass over the results each, nothing is read twice for its rows."""
    bad = F.coalesce(F.col(error), F.lit("")) != ""
    relaxations = results.filter(~bad).select(key, epa, F.coalesce(F.col(converged), F.lit(False)).alias("converged"))
    states = results.select(key, F.when(bad, "failed").otherwise("screened").alias("state"), F.when(bad, F.col(error)).alias("fail_reason"))
    events = results.select(key, F.lit("screen").alias("gate"), (~bad).alias("passed"), F.when(~bad, F.col(epa)).alias("value"))
    return relaxations, states, events


def placed_with_reasons(candidates: DataFrame, entries: DataFrame, scale: str = "scale", functional: str = "run_type") -> DataFrame:
    """Adds e_above_hull and ``absent`` (the reason of a missing one) to every row of candidates(sys, x, e) of binary systems.

    A system is placed only if its entries are on one energy scale and one functional (blank ones aside), and both of its end
    members are among them; the hull is of the entries, candidates don't shape it. No row is lost."""
    blank = F.nullif(F.trim(functional), F.lit(""))
    checks = entries.groupBy("sys").agg(
        F.count_distinct(scale).alias("scales"), F.count_distinct(blank).alias("functionals"), F.coalesce(F.max(F.col("x") <= 0), F.lit(False)).alias("low"), F.coalesce(F.max(F.col("x") >= 1), F.lit(False)).alias("high"))
    why = F.when(F.col("scales") > 1, "several energy scales").when(F.col("functionals") > 1, "several functionals").when(~F.col("low") | ~F.col("high"), "an end member is missing")
    checks = checks.select("sys", why.alias("why"))
    sound = entries.join(checks.filter("why is null").select("sys"), "sys", "left_semi").select("sys", "x", "e")
    placed = hull.place_binary(candidates, hull.binary_vertices(sound))
    known = checks.select(F.col("sys").alias("_s"), "why", F.lit(True).alias("_known"))
    out = placed.join(known, placed.sys == F.col("_s"), "left")
    absent = F.when(F.col("_known").isNull(), "no reference entries").otherwise(F.coalesce("why", F.when(F.col("e").isNull(), "no energy").when(F.col("hull").isNull(), "outside the end members")))
    return out.withColumn("absent", absent).drop("_s", "why", "_known", "hull", "stable")


def merged_shards(shards: list[DataFrame], seq: str, key: str, least: str, most: str, group: list[str]) -> DataFrame:
    """The union of shards with the first row of each fingerprint, marked by whether it is on the front of all of them together."""
    pooled = None
    for i, shard in enumerate(shards):
        tagged = shard.withColumn("shard", F.lit(i))
        pooled = tagged if pooled is None else pooled.unionByName(tagged)
    kept = pooled.groupBy(key).agg(F.min_by(F.struct(*pooled.columns), F.struct("shard", seq)).alias("r")).select("r.*")
    front = ranking.pareto_front(kept, group, least, most, 8).select(F.col(key).alias("_k")).distinct().withColumn("on_front", F.lit(True))
    return kept.join(front, kept[key] == F.col("_k"), "left").drop("_k").withColumn("on_front", F.coalesce("on_front", F.lit(False)))


def spread_picks(front: DataFrame, order: list[str], k: int) -> DataFrame:
    """k rows spread along a front, both ends in; places that coincide give one. The front is what a pick may see, so it is small."""
    placed = front.withColumn("place", F.row_number().over(W.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(W.partitionBy()))
    n = F.least(F.lit(k), F.col("_n"))
    at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.bround(i * (F.col("_n") - 1) / F.greatest(n - 1, F.lit(1)), 0).cast("long"))
    return placed.filter(F.array_contains(at, F.col("place").cast("long"))).drop("_n")


def round_floors(rows: DataFrame, floors: list[tuple[str, Column]]) -> DataFrame:
    """Adds ``removed_by``: the first floor that a row doesn't meet, null if it meets all."""
    out = F.lit(None).cast("string")
    for name, holds in reversed(floors):
        out = F.when(~F.coalesce(holds, F.lit(False)), name).otherwise(out)
    return rows.withColumn("removed_by", out)


def hull_audit(entries: DataFrame, parents: DataFrame) -> DataFrame:
    """sys, entries, vertices, parent_above, and the gap of the parent's distance to the best other entry's: a line a system."""
    vertices = hull.binary_vertices(entries.select("sys", "x", "e")).groupBy("sys").agg(F.count("*").alias("vertices"))
    counts = entries.groupBy("sys").agg(F.count("*").alias("entries"))
    placed = hull.place_binary(parents.select("sys", "x", "e"), hull.binary_vertices(entries.select("sys", "x", "e"))).groupBy("sys").agg(F.min("e_above_hull").alias("parent_above"))
    return counts.join(vertices, "sys", "left").join(placed, "sys", "left")


def first_spellings(items: DataFrame, formula: str, z_key: str, pos: str, written: str) -> DataFrame:
    """Adds ``kept`` (the first item of a formula and z), ``first`` (its spelling) and ``variants`` (z values kept of the formula)."""
    w = W.partitionBy(formula, z_key).orderBy(pos)
    marked = items.withColumn("kept", F.row_number().over(w) == 1).withColumn("first", F.first(written).over(w))
    variants = items.groupBy(formula).agg(F.count_distinct(F.coalesce(F.col(z_key).cast("string"), F.lit(""))).alias("variants"))
    return marked.join(variants, formula)


def roll_up(rows: DataFrame, group: str, sums: list[str]) -> DataFrame:
    """Totals by group and of all (group null), with the number of rows."""
    return rows.rollup(group).agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in sums))


def stage_slice(order: list[str], through: str | None = None, since: str | None = None, only: list[str] | None = None) -> list[str]:
    """Stages to run, of a fixed order."""
    chosen = order[order.index(since) if since else 0 : order.index(through) + 1 if through else None]
    return [s for s in chosen if not only or s in only]


def source_resolved(picks: DataFrame, files: DataFrame, name: str, path: str, static: str, energy: str) -> DataFrame:
    """name, energy of each pick: of the files whose folder it names; a static step wins over others, then the last path, then the most energy."""
    keyed = files.withColumn("_n", F.regexp_extract(path, r"([^/]+)/[^/]+/[^/]+$", 1))
    best = keyed.groupBy("_n").agg(F.max_by(energy, F.struct(static, path, energy)).alias(energy))
    return picks.join(best, picks[name] == F.col("_n"), "left").drop("_n")


def adopted(phases: DataFrame, checks: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(adopted, refused with ``reason``) by an ordered ladder of checks that must hold."""
    judged = round_floors(phases, checks).withColumnRenamed("removed_by", "reason")
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def prescreened(rows: DataFrame, verdicts: DataFrame, key: str, verdict: str, stored: str) -> DataFrame:
    """Adds ``passed``: the verdict on file if there is one, else the stored column."""
    known = verdicts.select(F.col(key).alias("_k"), F.col(verdict).alias("_v"))
    return rows.join(known, rows[key] == F.col("_k"), "left").withColumn("passed", F.coalesce("_v", stored)).drop("_k", "_v")


def exported(phases: DataFrame, converged: str, present: str) -> DataFrame:
    """phases with ``status`` done, failed or skipped (nothing was run)."""
    return phases.withColumn("status", F.when(~F.coalesce(F.col(present), F.lit(False)), "skipped").when(F.col(converged), "done").otherwise("failed"))


def pooled_parity(points: DataFrame, system: str, label: str, elements: str, a: str, b: str) -> tuple[DataFrame, DataFrame]:
    """(by system, by element): n, mae and the largest error of points(system, label, elements, a, b).

    A point counts once for each of its elements, however many systems it is in: by element the points of one label are one."""
    error = F.abs(F.col(a) - F.col(b))
    known = points.filter(error.isNotNull())
    figures = [F.count("*").alias("n"), F.avg("_e").alias("mae"), F.max("_e").alias("worst")]
    whole = known.withColumn("_e", error).groupBy(system).agg(*figures)
    each = known.select(F.col(label).alias("_l"), F.explode(F.array_distinct(elements)).alias("element"), error.alias("_e"))
    return whole, each.groupBy("element", "_l").agg(F.min("_e").alias("_e")).groupBy("element").agg(*figures)


def parity_points(rows: DataFrame, a: str, b: str, n: str) -> DataFrame:
    """Rows with both energies, per atom, as points of a comparison."""
    return rows.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(n) > 0)).withColumns({"a_per_atom": F.col(a) / F.col(n), "b_per_atom": F.col(b) / F.col(n)})


def missing_phases(wanted: DataFrame, have: DataFrame, key: str, distance: str, near: float) -> DataFrame:
    """Wanted phases that a hull lacks, ``blocking`` where they lie near it or nobody knows how near, else ``waivable``.

    Of an id that several lists name the least distance counts."""
    least = wanted.groupBy(key).agg(F.min(distance).alias(distance))
    lacking = least.join(have.select(key).distinct(), key, "left_anti")
    return lacking.withColumn("kind", F.when(F.coalesce(F.col(distance) <= near, F.lit(True)), "blocking").otherwise("waivable"))


def detail(rows: DataFrame, key: str, sources: list[tuple[str, DataFrame]], column: str) -> DataFrame:
    """Adds a column from the first of several sources that has it, and ``source``, that one's name."""
    out = rows
    for i, (_, df) in enumerate(sources):
        out = out.join(df.select(F.col(key).alias(f"_k{i}"), F.col(column).alias(f"_v{i}")), out[key] == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    named = F.coalesce(*(F.when(F.col(f"_v{i}").isNotNull(), name) for i, (name, _) in enumerate(sources)))
    out = out.withColumns({column: F.coalesce(*(f"_v{i}" for i in range(len(sources)))), "source": named})
    return out.drop(*(f"_v{i}" for i in range(len(sources))))


def in_flight(jobs: DataFrame, stage: str, state: str, cores: str) -> DataFrame:
    """A line a stage of what runs and waits, with its text."""
    live = jobs.groupBy(stage).agg(F.count_if(F.col(state) == "running").alias("running"), F.count_if(F.col(state) == "pending").alias("pending"), F.sum(F.when(F.col(state) == "running", F.col(cores)).otherwise(0)).alias("cores"))
    text = F.concat(F.col(stage), F.lit(": "), F.col("running").cast("string"), F.lit(" running on "), F.col("cores").cast("string"), F.lit(" cores, "), F.col("pending").cast("string"), F.lit(" waiting"))
    return live.filter("running + pending > 0").withColumn("text", text)


def progress(results: DataFrame, total: int, started: str, finished: str, converged: str) -> DataFrame:
    """One row: done of total, how many an hour since the first start, converged and failed."""
    hours = (F.max(F.unix_timestamp(finished)) - F.min(F.unix_timestamp(started))) / 3600.0
    ok = F.count_if(F.coalesce(F.col(converged), F.lit(False)))
    return results.agg(F.count("*").alias("done"), F.lit(total).cast("long").alias("total"), F.try_divide(F.count("*"), F.nullif(hours, F.lit(0.0))).alias("rate"), ok.alias("converged"), (F.count("*") - ok).alias("failed"))


def last_block_force(lines: DataFrame, key: str, seq: str, block: str, forces: list[str]) -> DataFrame:
    """key, fmax: the largest force component of the last block of each log."""
    last = lines.groupBy(key).agg(F.max(block).alias("_b"))
    inside = lines.join(last, key).filter(F.col(block) == F.col("_b"))
    return inside.groupBy(key).agg(F.max(F.greatest(*(F.abs(c) for c in forces))).alias("fmax"))


def space_warnings(groups: DataFrame, name: str, elements: str) -> DataFrame:
    """name, warning of groups that leave nothing to choose: empty ones, and such as share an element with another."""
    each = groups.select(name, F.explode(elements).alias("el"))
    shared = each.groupBy("el").agg(F.collect_set(name).alias("of")).filter(F.size("of") > 1).select(F.explode("of").alias(name), F.lit("shares an element").alias("warning"))
    empty = groups.filter(F.size(elements) == 0).select(name, F.lit("is empty").alias("warning"))
    return empty.unionByName(shared.distinct())


def neighbours(vectors: DataFrame, label: str, key: str, values: str, cell: float, within: float) -> DataFrame:
    """key, n, others: points within a distance of each (in its first three components) and how many of them are of another label.

    Points meet only in the cells of a grid of that distance: each is sent to its own cell and the 26 around it."""
    at = F.transform(F.slice(values, 1, 3), lambda x: F.floor(x.cast("double") / cell))
    own = vectors.select(F.col(key).alias("k"), F.col(label).alias("l"), F.slice(values, 1, 3).cast("array<double>").alias("v"), at.alias("c"))
    steps = F.array(*(F.lit(i) for i in (-1, 0, 1)))
    around = own.select("k", "l", "v", F.explode(F.transform(F.flatten(F.transform(steps, lambda x: F.flatten(F.transform(steps, lambda y: F.transform(steps, lambda z: F.array(x, y, z)))))), lambda d: F.zip_with("c", d, lambda a, b: a + b))).alias("c"))
    other = around.select(F.col("k").alias("ok"), F.col("l").alias("ol"), F.col("v").alias("ov"), "c")
    squared = F.aggregate(F.zip_with("v", "ov", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x)
    met = own.join(other, "c").filter((F.col("k") != F.col("ok")) & (squared <= within * within))
    counts = met.groupBy("k").agg(F.count("*").alias("n"), F.count_if(F.col("l") != F.col("ol")).alias("others"))
    return own.select("k").join(counts, "k", "left").select(F.col("k").alias(key), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("others", F.lit(0)).alias("others"))


def tag_differences(tags: DataFrame, recipe: dict[str, str], tag: str, value: str) -> DataFrame:
    """Rows of tags(tag, value, ..) whose value, in one spelling, isn't the recipe's; tags the recipe doesn't name are ``unknown``."""
    from funnelspark.operators.guards import normal_tag

    known = F.create_map(*(F.lit(x) for pair in recipe.items() for x in pair))
    want = F.try_element_at(known, F.col(tag))
    return tags.withColumn("kind", F.when(want.isNull(), "unknown").when(~normal_tag(F.col(value)).eqNullSafe(normal_tag(want)), "differs")).filter("kind is not null")


def linked_scores(candidates: DataFrame, scores: DataFrame, key: str, file: str, pattern: str, score: str) -> DataFrame:
    """candidates with the score of the file that names them, and their ``rank`` by it within what they share (null without a score).

    Scores know candidates only by a file's name, from which the key is taken; of several files the best score counts."""
    named = scores.withColumn("_k", F.regexp_extract(file, pattern, 1)).filter("_k <> ''").groupBy("_k").agg(F.max(score).alias(score))
    joined = candidates.join(named, candidates[key].cast("string") == F.col("_k"), "left").drop("_k")
    placed = ranking.numbered(joined.filter(F.col(score).isNotNull()), [], [F.desc(score), F.col(key)], "rank").select(F.col(key).alias("_r"), "rank")
    return joined.join(placed, joined[key] == F.col("_r"), "left").drop("_r")


def energies_on_file(entries: DataFrame, preferred: str, other: str, system: str) -> DataFrame:
    """Adds ``e`` and ``note``: the preferred energy where all entries of a system have it, else the other for all of the system, as one hull is on one scale."""
    whole = entries.groupBy(system).agg(F.min(F.col(preferred).isNotNull()).alias("_all"))
    out = entries.join(whole, system)
    return out.withColumn("e", F.when(F.col("_all"), F.col(preferred)).otherwise(F.col(other))).withColumn("note", F.when(~F.col("_all"), F.lit("other energies, as some are missing"))).drop("_all")


def rebuilt(artifacts: DataFrame, key: str, written: str) -> DataFrame:
    """The newest artifact of every structure, as rows of a store anew."""
    columns = [c for c in artifacts.columns if c not in (key, written)]
    return ranking.latest(artifacts, [key], written, columns)
