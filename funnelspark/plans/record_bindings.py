"""Record rules, store operations and rounds bound to the test tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.functions import formula as fm
from funnelspark.functions import records as rec
from funnelspark.functions import values as fv
from funnelspark.operators import hull, ranking, stats, store, summaries
from funnelspark.plans.bindings import HULL_SQL, long, placed_parts, query, r


def _counts(**parts) -> F.Column:
    return F.create_map(*(x for k, v in parts.items() for x in (F.lit(k), long(v))))


# --- energies and moments --------------------------------------------------------------------------------------------


@query("SELECT p_partkey, round(-p_retailprice / 7, 6) AS per_atom, round(p_retailprice / 7, 4) AS volume_per_atom, CASE WHEN p_size > 5 THEN round(p_retailprice * 0.25, 6) END AS correction, "
       "round(-p_retailprice / 7 + (0.5 * (p_size % 5 + 1) - 0.25 * (p_partkey % 4 + 1)) / (p_size % 5 + p_partkey % 4 + 3), 6) AS corrected FROM part")
def energy_columns(t):
    counts = _counts(Fe=F.col("p_size") % 5 + 1, Co=F.col("p_partkey") % 4 + 1, B=F.lit(1))
    raw = -F.col("p_retailprice")
    corrected = F.when(F.col("p_size") > 5, raw * 0.75)
    epa = rec.per_atom(raw, F.lit(7))
    return t.part.select("p_partkey", r(epa, 6).alias("per_atom"), rec.volume_per_atom(F.col("p_retailprice"), F.lit(7)).alias("volume_per_atom"), r(rec.correction(corrected, raw), 6).alias("correction"),
                         r(rec.corrected_per_atom(epa, counts, {"Fe": 0.5, "Co": -0.25}), 6).alias("corrected"))


@query("SELECT p_brand AS sys, 0.0 AS shift, count(*) AS n FROM part GROUP BY p_brand")
def hull_correction_shift(t):
    """A shift by element moves no entry against its hull: the largest change over a system's entries."""
    entries = t.part.select("p_partkey", F.col("p_brand").alias("sys"), ((F.col("p_size") - 1) / F.lit(49.0)).alias("x"), (-F.col("p_retailprice") / 1000.0).alias("e"))
    ends = t.part.select(F.lit(None).cast("long").alias("p_partkey"), F.col("p_brand").alias("sys")).distinct().withColumn("x", F.explode(F.array(F.lit(0.0), F.lit(1.0)))).withColumn("e", F.lit(0.0))
    both = entries.unionByName(ends)
    moved = both.withColumn("e", F.col("e") + 0.3 * (1 - F.col("x")) - 0.7 * F.col("x"))


    a = hull.place_binary(both).filter("p_partkey is not null").select("sys", "p_partkey", F.col("e_above_hull").alias("a"))
    b = hull.place_binary(moved).filter("p_partkey is not null").select("p_partkey", F.col("e_above_hull").alias("b"))
    return a.join(b, "p_partkey").groupBy("sys").agg((r(F.max(F.abs(F.col("a") - F.col("b"))), 6) + 0.0).alias("shift"), F.count("*").alias("n"))


@query("SELECT p_partkey, round(p_retailprice / 100 + CASE WHEN p_partkey % 3 = 0 THEN 3.27 * (p_size % 3) - 10.0 * (p_size % 2) ELSE 0 END, 6) AS m_s, "
       "round(11.654064 * (p_retailprice / 100 + 2 * (2.47 * (p_size % 3) - 10.21 * (p_size % 2))) / (100 + p_size), 6) AS polarisation FROM part")
def hund_moments(t):
    counts = _counts(Nd=F.col("p_size") % 3, Dy=F.col("p_size") % 2)
    treatment = F.when(F.col("p_partkey") % 3 == 0, "frozen").when(F.col("p_partkey") % 3 == 1, "valence").otherwise("no_reconstruction")
    tm = F.col("p_retailprice") / 100
    cell = F.map_concat(counts, F.create_map(F.lit("Fe"), F.lit(14).cast("long")))
    return t.part.select("p_partkey", r(rec.hund_moment(tm, counts, treatment), 6).alias("m_s"), r(rec.corrected_polarisation(tm, cell, 2 * fm.n_atoms(cell), F.lit(100) + F.col("p_size")), 6).alias("polarisation"))


SITES_SQL = "s AS (SELECT l_orderkey AS id, CASE l_partkey % 4 WHEN 0 THEN 'Fe' WHEN 1 THEN 'Co' WHEN 2 THEN 'Sm' ELSE 'Nd' END AS el, l_discount * 10 - l_tax * 5 AS m FROM lineitem)"


def _sites(t) -> DataFrame:
    element = F.element_at(F.array(*map(F.lit, ("Fe", "Co", "Sm", "Nd"))), (F.col("l_partkey") % 4 + 1).cast("int"))
    return t.lineitem.select(F.col("l_orderkey").alias("id"), element.alias("el"), (F.col("l_discount") * 10 - F.col("l_tax") * 5).alias("m"))


@query(f"WITH {SITES_SQL} SELECT el, count(*) AS n, round(sum(m), 4) AS total, round(avg(m), 6) AS mean, round(min(m), 6) AS low, round(max(m), 6) AS high, round(max(m) - min(m), 6) AS spread, CAST(row_number() OVER (ORDER BY -abs(round(sum(m), 4)), el) AS BIGINT) AS place FROM s GROUP BY el")
def moment_by_element(t):
    by = summaries.spread(_sites(t), "el", F.col("m")).select("el", "n", r("total").alias("total"), *(r(c, 6).alias(c) for c in ("mean", "low", "high", "spread")))
    return by.withColumn("place", long(F.row_number().over(ranking.W.orderBy(-F.abs("total"), "el"))))


@query(f"WITH {SITES_SQL}, g AS (SELECT id, sum(CASE WHEN el IN ('Sm', 'Nd') THEN m ELSE 0 END) AS re, sum(CASE WHEN el IN ('Sm', 'Nd') THEN 0 ELSE m END) AS tm, sum(m) AS total, "
       "count(*) FILTER (el IN ('Sm', 'Nd')) AS n_re, count(*) FILTER (el IN ('Sm', 'Nd') AND round(abs(m), 9) < 0.5) AS n_small FROM s GROUP BY id) "
       "SELECT id, round(re, 6) + 0.0 AS rare_earth, round(tm, 6) + 0.0 AS transition, n_re > 0 AND n_re = n_small AS frozen, round(1.5 - total, 6) + 0.0 AS deficit, CASE WHEN id % 3 > 0 THEN 1.5 / (id % 3) END AS per_unit, 1.5 / 50 AS per_volume FROM g")
def moment_report(t):
    rare = F.col("el").isin(*fm.RARE_EARTHS)
    by = _sites(t).groupBy("id").agg(F.sum(F.when(rare, F.col("m")).otherwise(0.0)).alias("re"), F.sum(F.when(rare, 0.0).otherwise(F.col("m"))).alias("tm"), F.sum("m").alias("total"), F.collect_list(F.when(rare, r("m", 9))).alias("sites"))
    cell = F.lit(1.5)
    return by.select("id", (r("re", 6) + 0.0).alias("rare_earth"), (r("tm", 6) + 0.0).alias("transition"), rec.frozen_visible(F.col("sites")).alias("frozen"), (r(rec.sphere_deficit(cell, F.col("total")), 6) + 0.0).alias("deficit"),
                     rec.per_formula_unit(cell, F.col("id") % 3).alias("per_unit"), rec.per_volume(cell, F.lit(50.0)).alias("per_volume"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_discount ELSE 0.0 END AS s, 0.0 AS p, l_tax AS d, CASE WHEN l_linenumber % 3 = 0 THEN 1.0 ELSE 0.0 END AS f FROM lineitem")
def site_channels(t):
    some = F.map_filter(F.create_map(F.lit("s"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_discount")), F.lit("d"), F.col("l_tax"), F.lit("f"), F.when(F.col("l_linenumber") % 3 == 0, 1.0)), lambda _, v: v.isNotNull())
    return t.lineitem.select("l_orderkey", "l_linenumber", rec.channels(some).alias("c")).select("l_orderkey", "l_linenumber", "c.*")


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN CASE WHEN p_size % 2 = 0 THEN p_retailprice END WHEN 1 THEN p_retailprice * 2 ELSE CASE WHEN p_size % 7 > 0 THEN 1.5 * (p_size % 7) END END AS energy, "
       "CASE WHEN p_size % 6 = 0 AND p_size > 0 THEN CAST(p_size // 6 * 2 AS BIGINT) ELSE CAST(-1 AS BIGINT) END AS n_fe FROM part")
def energy_source(t):
    """Energies by the source each row asks for; counts scaled where the cell is a whole multiple of six atoms, else read."""
    source = F.element_at(F.array(*map(F.lit, ("dft", "mlip", "mp"))), (F.col("p_partkey") % 3 + 1).cast("int"))
    energy = rec.energy_of(source, F.col("p_size") % 2 == 0, F.col("p_retailprice"), F.col("p_retailprice") * 2, F.lit(1.5), F.col("p_size") % 7)
    counts = rec.cell_counts(F.col("p_size"), _counts(Fe=F.lit(2), Co=F.lit(4)), F.lit(6), _counts(Fe=F.lit(-1)))
    return t.part.select("p_partkey", energy.alias("energy"), F.element_at(counts, "Fe").alias("n_fe"))


@query("SELECT a.l_orderkey AS id, a.l_linenumber AS step_mlip, b.l_linenumber AS step_dft, round(a.l_tax - b.l_tax, 6) + 0.0 AS d FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_returnflag = 'A' AND b.l_returnflag = 'R'")
def hull_pairs(t):
    """Placements by one method with those by the other: several reference sets fan out."""
    side = lambda flag, name: t.lineitem.filter(F.col("l_returnflag") == flag).select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias(f"step_{name}"), F.col("l_tax").alias(name))
    both = summaries.paired(side("A", "mlip").withColumnRenamed("mlip", "value"), side("R", "dft").withColumnRenamed("dft", "value"), "id", "value")
    return both.select("id", "step_mlip", F.col("step_dft_b").alias("step_dft"), (r("difference", 6) + 0.0).alias("d"))


@query("SELECT p_brand, round(avg(d), 6) AS mean_drift, round(max(d) - min(d), 6) AS spread, count(*) AS n FROM (SELECT p_brand, (l_extendedprice / l_quantity - p_retailprice) / p_retailprice AS d FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY p_brand")
def surrogate_drift(t):
    picks = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    out = summaries.spread(picks, "p_brand", fv.drift(F.col("p_retailprice"), F.col("l_extendedprice") / F.col("l_quantity")))
    return out.select("p_brand", r("mean", 6).alias("mean_drift"), r("spread", 6).alias("spread"), "n")


# --- cells, geometry, batches ----------------------------------------------------------------------------------------


@query("SELECT p_partkey, round((p_size % 5) / 10.0 + (p_size % 3) / 20.0, 9) AS x, round((p_size % 3) / 10.0 * sqrt(3) / 2, 9) AS y FROM part")
def ternary_points(t):
    x, y = rec.ternary_xy(F.col("p_size") % 5 / 10.0, F.col("p_size") % 3 / 10.0)
    return t.part.select("p_partkey", r(x, 9).alias("x"), r(y, 9).alias("y"))


@query("SELECT p_partkey, target, CAST(CASE WHEN target = 'Nd' THEN p_size % 4 + 1 ELSE p_size % 4 + 1 END AS BIGINT) AS n_target, round((14 * 1.26 ** 3 + (p_size % 4 + 1) * rad ** 3) / (14 * 1.26 ** 3 + (p_size % 4 + 1) * 1.81 ** 3), 6) AS scale "
       "FROM part, (VALUES ('Nd', 1.81), ('Sm', 1.80), ('Dy', 1.77)) v(target, rad)")
def isostructural_swap(t):
    """The series of a prototype: its rare earth swapped for each target, and how far its volume grows."""
    radii = {"Fe": 1.26, "Nd": 1.81, "Sm": 1.80, "Dy": 1.77}
    rows = t.part.select("p_partkey", _counts(Fe=F.lit(14), Nd=F.col("p_size") % 4 + 1).alias("old"), F.explode(F.array(*map(F.lit, ("Nd", "Sm", "Dy")))).alias("target"))
    rows = rows.withColumn("new", rec.swapped(F.col("old"), ["Nd", "Sm", "Dy"], F.col("target")))
    return rows.select("p_partkey", "target", F.element_at("new", F.col("target")).alias("n_target"), r(rec.volume_scale(F.col("old"), F.col("new"), radii), 6).alias("scale"))


FAULT_SQL = """f AS (SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN 'rejected:no_atoms' WHEN p_partkey % 13 = 0 THEN 'rejected:lengths_unknown' WHEN p_size + 3 > 50 OR p_size % 7 < 1 THEN 'rejected:lengths'
  WHEN p_partkey % 200 < 10 OR p_partkey % 200 > 170 THEN 'rejected:angles' WHEN p_partkey % 17 = 0 THEN 'rejected:volume' WHEN p_size % 10 > 1 AND p_partkey % 5 = 0 THEN 'rejected:contact'
  ELSE '' END AS fault, p_partkey % 2 = 0 AS converged FROM part)"""


def _faults(t) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    lengths = F.array((size % 7).cast("double"), (size + 3).cast("double"), F.when(key % 13 == 0, F.lit(float("nan"))).otherwise(F.lit(5.0)))
    angles = F.array(F.lit(90.0), (key % 200).cast("double"), F.lit(120.0))
    volume, closest = F.when(key % 17 == 0, 0.0).otherwise(1.0), F.when(key % 5 == 0, 0.25).otherwise(2.5)
    return t.part.select("p_partkey", rec.geometry_fault(size % 10, lengths, angles, volume, closest).alias("fault"), (key % 2 == 0).alias("converged"))


@query(f"WITH {FAULT_SQL} SELECT p_partkey, fault FROM f")
def geometry_ladder(t):
    return _faults(t).select("p_partkey", "fault")


@query(f"WITH {FAULT_SQL} SELECT count(*) AS total, count(*) FILTER (fault = '' AND converged) AS converged, count(*) FILTER (fault = '' AND NOT converged) AS step_limited, count(*) FILTER (fault <> '') AS rejected, CAST(0 AS BIGINT) AS failed FROM f")
def batch_stats(t):
    return store.batch_stats(_faults(t), "fault", "converged")


@query(f"WITH {FAULT_SQL} SELECT fault, count(*) AS n FROM f WHERE fault <> '' GROUP BY fault ORDER BY n DESC, fault LIMIT 5")
def batch_reasons(t):
    return store.tally(_faults(t).filter("fault <> ''"), ["fault"], 5)


@query(f"WITH {FAULT_SQL} SELECT p_partkey, CASE WHEN fault = '' THEN 'screened' ELSE 'failed' END AS state, CASE WHEN fault <> '' THEN fault END AS fail_reason, fault = '' AS passed, fault = '' AS relaxed FROM f")
def absorbed_results(t):
    results = _faults(t).withColumn("epa", F.lit(-1.0))
    relaxations, states, events = store.absorbed(results, "p_partkey", "epa", "converged", "fault")
    relaxed = relaxations.select("p_partkey", F.lit(True).alias("relaxed"))
    return states.join(events.select("p_partkey", "passed"), "p_partkey").join(relaxed, "p_partkey", "left").withColumn("relaxed", F.coalesce("relaxed", F.lit(False)))


# --- logs and live runs ----------------------------------------------------------------------------------------------

OUTCOME_SQL = """o AS (SELECT l_orderkey AS id, l_linenumber AS step, l_quantity, l_linenumber % 7 > 0 AS present, l_returnflag <> 'A' AS finished, l_linestatus = 'O' AS reached, CAST(l_quantity AS INTEGER) % 4 * 10 AS nsw, 60 AS nelm, CAST(l_quantity AS INTEGER) % 5 * 15 AS n_elec, CAST(l_quantity AS INTEGER) % 3 * 15 AS n_ionic FROM lineitem),
c AS (SELECT *, NOT (nelm <> 0 AND n_elec <> 0 AND n_elec >= nelm) AS scf FROM o),
d AS (SELECT *, (reached OR (nsw <= 0 AND finished)) AND scf AS converged FROM c),
j AS (SELECT *, CASE WHEN NOT present THEN 'failed' WHEN NOT finished THEN 'timeout' ELSE 'done' END AS state,
  CASE WHEN NOT present THEN 'no_log' WHEN NOT finished THEN 'cut_off' WHEN converged THEN '' WHEN NOT scf THEN 'scf_not_converged' WHEN n_ionic >= nsw THEN 'ionic_step_limit' ELSE 'force_limit_not_met' END AS reason FROM d)"""


def _outcomes(t) -> DataFrame:
    """Runs with logs made of the lines that the classifiers look for."""
    q = F.col("l_quantity").cast("int")
    log = F.concat(F.when(F.col("l_linestatus") == "O", "reached required accuracy\n").otherwise("step\n"), F.when(F.col("l_returnflag") != "A", "General timing and accounting").otherwise(""))
    rows = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("step"), "l_quantity", log.alias("log"), (F.col("l_linenumber") % 7 > 0).alias("present"), (q % 4 * 10).alias("nsw"), (q % 5 * 15).alias("n_elec"), (q % 3 * 15).alias("n_ionic"))
    marks = rec.log_marks(F.col("log"))
    return rows.withColumn("o", rec.job_outcome(F.col("present"), marks["finished"], marks["reached"], F.col("nsw"), F.lit(None).cast("int"), F.lit(60), F.col("n_elec"), F.col("n_ionic")))


@query(f"WITH {OUTCOME_SQL} SELECT state, converged AND present AS usable, reason, count(*) AS n FROM j GROUP BY ALL")
def log_states(t):
    rows = _outcomes(t).select("o.state", (F.col("o.converged") & F.col("present")).alias("usable"), "o.reason")
    return rows.groupBy("state", "usable", "reason").agg(F.count("*").alias("n"))


@query(f"""WITH {OUTCOME_SQL}, b AS (SELECT CASE WHEN id % 11 = 0 THEN 'ignored' WHEN id % 7 = 0 AND id % 2 = 0 THEN 'setup_error' WHEN id % 7 = 0 THEN 'not_started' WHEN NOT present AND id % 3 > 0 THEN 'staged' WHEN NOT present AND id % 5 = 0 THEN 'avx512' WHEN NOT present THEN 'no_outcar'
  WHEN state = 'done' AND converged THEN 'ok' WHEN reason = 'ionic_step_limit' THEN 'max_steps' WHEN id % 13 = 0 THEN 'zbrent' WHEN id % 17 = 0 THEN 'crash' WHEN state = 'timeout' AND l_quantity * 60 < 1800 THEN 'running' WHEN state = 'timeout' THEN 'killed' ELSE 'not_conv' END AS bucket FROM j)
SELECT bucket, count(*) AS n FROM b GROUP BY bucket""")
def failure_buckets(t):
    i = F.col("id")
    bucket = rec.failure_bucket(i % 7 > 0, F.col("present"), i % 3 == 0, i % 5 == 0, F.col("o"), i % 13 == 0, i % 17 == 0, F.col("l_quantity") * 60, i % 11 == 0, F.when(i % 2 == 0, "KeyError: no moment"))
    return _outcomes(t).select(bucket.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


HEALTH_SQL = """h AS (SELECT l_orderkey AS id, l_quantity * 80 AS age, l_discount * 100 - 9 AS energy, l_tax * 13 AS de, CASE WHEN l_linenumber > 4 THEN l_partkey % 2 = 0 END AS relax_ok, CASE WHEN l_linenumber > 4 THEN 'static' ELSE 'relax' END AS stage, CAST(l_partkey % 40 AS BIGINT) AS steps,
  CAST(l_suppkey % 100 * 60 AS DOUBLE) AS elapsed, l_linenumber = 3 AS converged, CAST(l_partkey % 61 AS BIGINT) AS scf, 60 AS nelm, CAST(l_quantity AS INTEGER) % 3 * 30 AS nsw FROM lineitem),
p AS (SELECT *, CASE WHEN steps > 1 AND elapsed > 0 AND stage = 'relax' THEN steps + CAST(floor(7200.0 / (elapsed / steps)) AS BIGINT) END AS proj FROM h)"""


@query(f"""WITH {HEALTH_SQL} SELECT CASE WHEN age > 3600 THEN 'stalled' WHEN round(energy, 6) > 0 OR round(de, 6) > 1 THEN 'DIVERGED' WHEN NOT relax_ok THEN 'static-on-bad-relax' WHEN stage = 'relax' AND steps = 0 AND elapsed > 3600 THEN 'first-scf' WHEN converged THEN 'converged' WHEN scf >= nelm THEN 'scf-hard'
  WHEN nsw <> 0 AND steps >= nsw THEN 'nsw-limit' WHEN nsw <> 0 AND proj < nsw THEN 'slow' WHEN scf > 30 THEN 'scf-hard' WHEN nsw <> 0 AND proj IS NOT NULL AND steps > 0.9 * nsw THEN 'nsw-limit' ELSE 'ok' END AS verdict, count(*) AS n, CAST(coalesce(sum(proj), 0) AS BIGINT) AS projected FROM p GROUP BY 1""")
def health_verdicts(t):
    c = F.col
    rows = t.lineitem.select((c("l_quantity") * 80).alias("age"), r(c("l_discount") * 100 - 9, 6).alias("energy"), r(c("l_tax") * 13, 6).alias("de"), F.when(c("l_linenumber") > 4, c("l_partkey") % 2 == 0).alias("relax_ok"), F.when(c("l_linenumber") > 4, "static").otherwise("relax").alias("stage"),
                             (c("l_partkey") % 40).alias("steps"), (c("l_suppkey") % 100 * 60.0).alias("elapsed"), (c("l_linenumber") == 3).alias("converged"), (c("l_partkey") % 61).alias("scf"), (c("l_quantity").cast("int") % 3 * 30).alias("nsw"))
    rows = rows.withColumn("proj", F.when(c("stage") == "relax", rec.projected_steps(c("steps"), c("elapsed"), F.lit(7200.0))))
    verdict = rec.health(*(c(x) for x in ("age", "energy", "de", "relax_ok", "stage", "steps", "elapsed", "converged", "scf")), F.lit(60), c("nsw"), c("proj"))
    return rows.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"), F.coalesce(F.sum("proj"), F.lit(0)).alias("projected"))


@query("SELECT user_id, arg_max(fault, (ts, fault)) AS fault FROM (SELECT user_id, ts, CASE WHEN event_type = 'error' THEN 'E' || CAST(event_id % 5 AS VARCHAR) ELSE '' END AS fault FROM events) GROUP BY user_id HAVING arg_max(fault, (ts, fault)) <> ''")
def setup_errors(t):
    logs = t.events.select("user_id", "ts", F.when(F.col("event_type") == "error", F.concat(F.lit("E"), (F.col("event_id") % 5).cast("string"))).alias("fault"))
    return store.latest_faults(logs, "user_id", "ts", "fault")


@query("""WITH s AS (SELECT l_orderkey AS id, l_linenumber AS seq, 'step' || l_linenumber AS name, l_returnflag <> 'R' AS ok, CASE WHEN l_orderkey % 10 = 0 AND l_linenumber = 2 THEN 'step2' END AS mark FROM lineitem)
SELECT id, coalesce(max(CASE WHEN mark = name THEN name END), min_by(name, seq) FILTER (NOT ok)) AS step FROM s GROUP BY id""")
def combined_steps(t):
    n = F.col("l_linenumber")
    steps = t.lineitem.select(F.col("l_orderkey").alias("id"), n.alias("seq"), F.concat(F.lit("step"), n.cast("string")).alias("name"), (F.col("l_returnflag") != "R").alias("ok"), F.when((F.col("l_orderkey") % 10 == 0) & (n == 2), "step2").alias("mark"))
    return store.first_bad_step(steps, "id", "seq", "name", "ok", "mark")


# --- store operations ------------------------------------------------------------------------------------------------


@query("SELECT CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) THEN 'have' WHEN d > 0.5 THEN 'far' WHEN p_size % 9 = 0 THEN 'no_geometry' ELSE 'create' END AS action, count(*) AS n FROM (SELECT *, CASE WHEN p_size % 4 > 0 THEN p_size / 50.0 END AS d FROM part) GROUP BY 1")
def store_add(t):
    found = t.part.withColumn("d", F.when(F.col("p_size") % 4 > 0, F.col("p_size") / 50.0)).withColumn("geometry", F.when(F.col("p_size") % 9 > 0, "cell"))
    return store.additions(found, t.lineitem.filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "d", "geometry", 0.5).groupBy("action").agg(F.count("*").alias("n"))


@query("SELECT p_partkey FROM part WHERE NOT p_size > 25 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48) AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity < 2) AND p_brand LIKE 'Brand#1%' ORDER BY p_partkey LIMIT 100")
def store_submit(t):
    key = lambda rows: rows.select(F.col("l_partkey").alias("p_partkey"))
    return store.to_submit(t.part, "p_partkey", F.col("p_size") > 25, key(t.lineitem.filter("l_quantity > 48")), key(t.lineitem.filter("l_quantity < 2")), F.startswith("p_brand", F.lit("Brand#1")), "p_partkey", 100).select("p_partkey")


@query("SELECT standing, count(*) AS n FROM (SELECT CASE WHEN p_size > 25 THEN 'ready' WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48) THEN 'ignored' ELSE 'outstanding' END AS standing FROM part) GROUP BY standing")
def store_status(t):
    return store.outstanding(t.part, "p_partkey", F.col("p_size") > 25, t.lineitem.filter("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey"))).groupBy("standing").agg(F.count("*").alias("n"))


@query("SELECT p_type AS reason, count(*) AS n FROM part WHERE p_size <= 25 GROUP BY p_type ORDER BY n DESC, p_type LIMIT 12")
def fail_census(t):
    return store.tally(t.part.filter("p_size <= 25").withColumnRenamed("p_type", "reason"), ["reason"], 12)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'skip' WHEN contains(o_orderpriority, 'URGENT') THEN 'requeue' ELSE 'leave' END AS action FROM orders WHERE o_orderstatus = 'F'")
def requeue_selection(t):
    rows = t.orders.withColumn("state", F.when(F.col("o_orderstatus") == "F", "failed").otherwise("screened")).withColumn("fault", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")))
    return store.requeue(rows, "state", "fault", "URGENT").select("o_orderkey", "action")


@query("""SELECT o_orderkey, CASE WHEN c AND o_orderstatus <> 'F' THEN 'filtered_out' WHEN o_orderstatus = 'F' THEN 'dft_done' ELSE 'screened' END AS state, c AND o_orderstatus = 'F' AS refused, CASE WHEN c AND o_orderstatus <> 'F' THEN 'asked by hand' END AS exclusion
FROM (SELECT *, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AND o_orderkey % 2 = 0 AS c FROM orders)""")
def operator_exclusion(t):
    rows = t.orders.withColumn("state", F.when(F.col("o_orderstatus") == "F", "dft_done").otherwise("screened"))
    wanted = rows.join(t.customer.filter("c_acctbal < 0"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").filter("o_orderkey % 2 = 0").select("o_orderkey", F.lit("asked by hand").alias("why"))
    return store.excluded(rows, wanted, "o_orderkey", "state", "why").select("o_orderkey", "state", "refused", "exclusion")


@query("SELECT l_orderkey AS task, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey")
def handed_back(t):
    finished = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("task"))
    return store.handed_back(t.lineitem.withColumnRenamed("l_orderkey", "task"), "task", finished).groupBy("task").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, CASE WHEN q IS NOT NULL AND p_size % 3 > 0 THEN 'cell' || q ELSE 'old' END AS cell, q IS NOT NULL AND p_size % 3 > 0 AS recarried FROM part LEFT JOIN (SELECT l_partkey, CAST(max(CAST(l_quantity AS INTEGER)) AS VARCHAR) AS q FROM lineitem WHERE l_quantity > 40 GROUP BY l_partkey) ON p_partkey = l_partkey")
def recarried_geometry(t):
    outputs = t.lineitem.filter("l_quantity > 40").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.concat(F.lit("cell"), F.max(F.col("l_quantity").cast("int")).cast("string")).alias("cell"))
    rows = t.part.select("p_partkey", F.when(F.col("p_size") % 3 == 0, "dft_running").otherwise("screened").alias("state"), F.lit("old").alias("cell"))
    return store.recarried(rows, outputs, "p_partkey", "state", "cell", ["dft_running", "dft_done"]).select("p_partkey", "cell", "recarried")


@query("SELECT count(*) AS orphans FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P'")
def orphan_jobs(t):
    """Jobs written before their submission and never given a scheduler's number."""
    jobs = t.orders.select(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey").cast("string")).otherwise("").alias("slurm_id"), F.when(F.col("o_orderstatus") == "P", "pending").otherwise("done").alias("state"))
    return summaries.orphans(jobs, "slurm_id", "state").agg(F.count("*").alias("orphans"))


@query("SELECT DISTINCT p_brand AS chemsys FROM part")
def chem_systems(t):
    return t.part.select(F.col("p_brand").alias("chemsys")).distinct().orderBy("chemsys")


@query("SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS atoms, median(p_size) AS middle, CAST(max(p_size) AS BIGINT) AS largest, round(sum(p_retailprice), 2) AS cost, count(DISTINCT p_type) AS kinds FROM part GROUP BY p_brand")
def plan_totals(t):
    return summaries.plan_totals(t.part, "p_brand", "p_size", "p_retailprice", "p_type").withColumns({"largest": long("largest"), "cost": r("cost", 2)})


@query("SELECT s.reason, count(*) AS n, string_agg(c, ', ' ORDER BY c) FILTER (k <= 3) || CASE WHEN count(*) > 3 THEN ' and ' || (count(*) - 3) || ' more' ELSE '' END AS systems FROM (SELECT c_name AS c, 'no entries' || CASE WHEN c_custkey % 2 = 0 THEN ' on scale' ELSE '' END AS reason, row_number() OVER (PARTITION BY c_custkey % 2 ORDER BY c_name) AS k FROM customer) s GROUP BY s.reason")
def note_summary(t):
    notes = t.customer.select("c_name", F.when(F.col("c_custkey") % 2 == 0, "no entries on scale for [Fe, Co]. All the rest is its explanation.").otherwise("no entries among 12 of them. See there.").alias("reason"))
    return store.note_summary(notes, "c_name", "reason")


@query("SELECT p_brand, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS p_size, round(sum(p_retailprice), 2) AS cost FROM part GROUP BY ROLLUP (p_brand)")
def adopted_totals(t):
    return store.roll_up(t.part.select("p_brand", "p_size", "p_retailprice"), "p_brand", ["p_size", "p_retailprice"]).select("p_brand", "n", "p_size", r("p_retailprice", 2).alias("cost"))


@query("SELECT o_custkey, max(CASE WHEN o_orderkey % 3 = 0 THEN 32768.0 WHEN o_orderkey % 3 = 1 THEN 512.0 ELSE 16384.0 END) AS mem_mb, max(CASE WHEN o_orderkey % 2 = 0 THEN 93600.0 ELSE 5400.0 END) AS walltime_s FROM orders GROUP BY o_custkey")
def largest_resources(t):
    """Memory and time that serve all items of an array; what can't be read counts as the default."""
    k = F.col("o_orderkey")
    mem = F.when(k % 3 == 0, "32G").when(k % 3 == 1, "512M").otherwise("much")
    time = F.when(k % 2 == 0, "1-02:00:00").otherwise("01:30:00")
    return summaries.largest_needs(t.orders, "o_custkey", fv.megabytes(mem), 16384.0, fv.seconds(time)).select("o_custkey", F.col("memory").alias("mem_mb"), F.col("time").alias("walltime_s"))


@query("SELECT o_orderkey, regexp_extract(path, '[^/]+$') AS name, CASE WHEN o_orderstatus = 'F' THEN 'kind=parent; of=' || o_orderpriority ELSE 'kind=child; of=' || o_orderpriority || '; method=swapped' || CASE WHEN o_orderkey % 2 = 0 THEN '; route=hand' ELSE '' END END AS line "
       "FROM (SELECT *, '/seeds/' || o_custkey || '/' || o_orderkey || '.vasp' AS path FROM orders)")
def seed_provenance(t):
    path = F.concat_ws("/", F.lit("/seeds"), F.col("o_custkey").cast("string"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".vasp")))
    records = t.orders.select(F.concat(F.col("o_orderkey").cast("string"), F.lit(".vasp")).alias("seed"), F.col("o_orderpriority").alias("parent"))
    seeds = t.orders.select("o_orderkey", rec.base_name(path).alias("name"), (F.col("o_orderstatus") == "F").alias("is_parent"), F.when(F.col("o_orderkey") % 2 == 0, "hand").alias("tag"))
    joined = seeds.join(records, F.col("name") == F.col("seed"), "left")
    return joined.select("o_orderkey", "name", rec.provenance_line(F.col("is_parent"), F.col("parent"), F.lit("swapped"), F.lit(""), F.col("tag")).alias("line"))


@query("SELECT o_orderpriority AS tag, o_orderstatus AS method, count(*) AS n FROM orders GROUP BY ALL")
def seed_summary(t):
    return store.tally(t.orders.select(F.col("o_orderpriority").alias("tag"), F.col("o_orderstatus").alias("method")), ["tag", "method"])


@query("""WITH f AS (SELECT l_orderkey, l_linenumber, l_linenumber % 2 = 0 AS is_static, l_extendedprice FROM lineitem)
SELECT o_orderkey, arg_max(l_extendedprice, (CAST(is_static AS INTEGER), l_linenumber, l_extendedprice)) AS energy FROM orders LEFT JOIN f ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def collected_energies(t):
    files = t.lineitem.select(F.concat(F.lit("/run/"), F.col("l_orderkey").cast("string"), F.lit("/s"), F.col("l_linenumber").cast("string"), F.lit("/out")).alias("path"), (F.col("l_linenumber") % 2 == 0).alias("is_static"), F.col("l_extendedprice").alias("energy"))
    picks = t.orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("pick"))
    return store.source_resolved(picks, files, "pick", "path", "is_static", "energy").select("o_orderkey", "energy")


@query("SELECT CAST(e.k AS VARCHAR) AS key, CASE WHEN p_size % 5 = 0 THEN 'null' WHEN p_size % 5 = 1 THEN 'number-like' WHEN k = 'energy' THEN 'reserved' WHEN k IN ('Fe2O3', 'Og') THEN 'formula-like' END AS fault, count(*) AS n FROM part, (VALUES ('energy'), ('Fe2O3'), ('Og'), ('reduced_formula'), ('Xx2')) e(k) GROUP BY ALL")
def key_validation(t):
    value = F.when(F.col("p_size") % 5 == 0, F.lit(None).cast("string")).when(F.col("p_size") % 5 == 1, "12e3").otherwise("sha256:12e3")
    rows = t.part.select(F.explode(F.array(*map(F.lit, ("energy", "Fe2O3", "Og", "reduced_formula", "Xx2")))).alias("key"), value.alias("value"))
    return rows.select("key", rec.key_fault(F.col("key"), F.col("value"), ("energy", "id"), tuple(fm.ELEMENTS)).alias("fault")).groupBy("key", "fault").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, CASE WHEN g > 1 AND e IS NOT NULL THEN 'ambiguous' WHEN g > 1 THEN 'multiplied' ELSE 'reduced' END AS status, CAST(coalesce(CASE WHEN g > 1 AND e IS NULL THEN g WHEN g = 1 THEN e END, 0) AS BIGINT) AS z FROM (SELECT p_partkey, gcd(p_size % 6 + 1, p_size % 4 + 2) AS g, CASE WHEN p_partkey % 3 = 0 THEN 2 END AS e FROM part)")
def z_resolution(t):
    counts = _counts(Fe=F.col("p_size") % 6 + 1, Co=F.col("p_size") % 4 + 2)
    item = rec.resolved_item(counts, F.when(F.col("p_partkey") % 3 == 0, F.lit(2).cast("long")))
    return t.part.select("p_partkey", item.alias("i")).select("p_partkey", "i.status", F.coalesce("i.z", F.lit(0)).alias("z"))


@query("""SELECT p_partkey, row_number() OVER (PARTITION BY p_brand, z ORDER BY p_partkey) = 1 AS kept, first_value(p_name) OVER (PARTITION BY p_brand, z ORDER BY p_partkey) AS first, v AS variants
FROM (SELECT *, p_size % 3 AS z FROM part) JOIN (SELECT p_brand, count(DISTINCT p_size % 3) AS v FROM part GROUP BY p_brand) USING (p_brand)""")
def first_spellings(t):
    items = t.part.withColumn("z", F.col("p_size") % 3)
    return store.first_spellings(items, "p_brand", "z", "p_partkey", "p_name").select("p_partkey", "kept", "first", "variants")


@query("SELECT o_orderkey, o_orderstatus = 'O' AND (o_custkey % 5 = 0 OR o_orderdate < TIMESTAMP '1996-01-01') AS ready, CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderkey % 3 = 0 THEN 'pilot failed' WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN 'waiting for the pilot' ELSE '' END AS hold FROM orders")
def pilot_gate(t):
    """Ready work outside the pilot is held until the pilot has a verdict that isn't fail; here by the order's date and key."""
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp")
    verdict = F.when(early, "pass").when(F.col("o_orderkey") % 3 == 0, "fail")
    hold = rec.pilot_hold("block", verdict, F.lit(True))
    return t.orders.select("o_orderkey", ((F.col("o_orderstatus") == "O") & ((F.col("o_custkey") % 5 == 0) | (hold == ""))).alias("ready"), hold.alias("hold"))


@query("SELECT p_brand, CASE WHEN s < 0.5 THEN 'fail' WHEN s < 1 AND p = 'pass' THEN 'warn' ELSE p END AS verdict FROM (SELECT p_brand, CASE WHEN avg(p_size) < 25 THEN 'pass' ELSE 'warn' END AS p, CAST(count(*) FILTER (p_size % 2 = 0) AS DOUBLE) / count(*) AS s FROM part GROUP BY p_brand)")
def pilot_report(t):
    by = t.part.groupBy("p_brand").agg(F.when(F.avg("p_size") < 25, "pass").otherwise("warn").alias("parity"), F.count_if(F.col("p_size") % 2 == 0).alias("shared"), F.count("*").alias("n"))
    return by.select("p_brand", rec.pilot_verdict(F.col("parity"), F.col("shared"), F.col("n")).alias("verdict"))


# --- hulls with reasons, fronts, rounds ------------------------------------------------------------------------------

_WHY_SQL = f"""WITH {HULL_SQL},
w AS (SELECT sys, CASE WHEN right(sys, 1) = '1' THEN 'several energy scales' WHEN right(sys, 1) = '2' THEN 'several functionals' WHEN right(sys, 1) = '3' THEN 'an end member is missing' WHEN right(sys, 1) = '4' THEN 'no reference entries' END AS why FROM (SELECT DISTINCT sys FROM e))
"""


@query(_WHY_SQL + "SELECT p_partkey, CASE WHEN why IS NULL THEN round(above, 5) + 0.0 END AS e_above_hull, why AS absent FROM p JOIN w USING (sys)")
def placement_reasons(t):
    """Every candidate with its distance or the reason why it has none: scales, functionals, end members, no entries at all."""
    last = F.right("p_brand", F.lit(1))
    entries = t.part.select(F.col("p_brand").alias("sys"), ((F.col("p_size") - 1) / F.lit(49.0)).alias("x"), (-F.col("p_retailprice") / 1000.0).alias("e"), F.lit("raw").alias("scale"), F.lit("PBE").alias("run_type"))
    ends = t.part.select("p_brand").distinct().withColumn("x", F.explode(F.array(F.lit(0.0), F.lit(1.0))))
    ends = ends.select(F.col("p_brand").alias("sys"), "x", F.lit(0.0).alias("e"), F.when((last == "1") & (F.col("x") == 0), "corrected").otherwise("raw").alias("scale"), F.when((last == "2") & (F.col("x") == 1), "PBE+U").when(F.col("x") == 0, " ").otherwise("PBE").alias("run_type"))
    known = entries.unionByName(ends)
    known = known.filter(~((F.right("sys", F.lit(1)) == "3") & (F.col("x") >= 1)) & (F.right("sys", F.lit(1)) != "4"))
    candidates = t.part.select("p_partkey", F.col("p_brand").alias("sys"), ((F.col("p_size") - 1) / F.lit(49.0)).alias("x"), (-F.col("p_retailprice") / 1000.0).alias("e"))
    out = store.placed_with_reasons(candidates, known)
    return out.select("p_partkey", F.when(F.col("absent").isNull(), r("e_above_hull", 5) + 0.0).alias("e_above_hull"), "absent")


@query("WITH k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey % 3, p_partkey) AS i FROM part) WHERE i = 1) SELECT p_partkey, CAST(p_partkey % 3 AS INTEGER) AS shard, NOT EXISTS (SELECT 1 FROM k o WHERE o.p_brand = k.p_brand AND o.p_size <= k.p_size AND o.p_retailprice >= k.p_retailprice AND (o.p_size < k.p_size OR o.p_retailprice > k.p_retailprice)) AS on_front FROM k")
def merged_shards(t):
    """Three shards pooled, the first of each fingerprint kept, the front computed anew over what is left."""
    shards = [t.part.filter(F.col("p_partkey") % 3 == i).withColumn("fingerprint", F.concat_ws("|", "p_brand", F.col("p_size").cast("string"))) for i in range(3)]
    return store.merged_shards(shards, "p_partkey", "fingerprint", "p_size", "p_retailprice", ["p_brand"]).select("p_partkey", "shard", "on_front")


ROUND_SQL = f"""WITH {HULL_SQL}, g AS (SELECT p.*, p_retailprice, CASE WHEN NOT above <= 0.6 THEN 'hull' WHEN NOT p.p_size >= 5 THEN 'size' WHEN NOT p_retailprice > 902 THEN 'price' END AS removed_by FROM p JOIN (SELECT p_partkey, p_retailprice FROM part) USING (p_partkey)),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sys, p_size ORDER BY p_retailprice DESC, p_partkey) AS i FROM g WHERE removed_by IS NULL) WHERE i = 1),
fr AS (SELECT *, round(above, 9) AS d FROM u WHERE NOT EXISTS (SELECT 1 FROM u o WHERE round(o.above, 9) <= round(u.above, 9) AND o.p_retailprice >= u.p_retailprice AND (round(o.above, 9) < round(u.above, 9) OR o.p_retailprice > u.p_retailprice)))
"""


def _round(t) -> tuple[DataFrame, DataFrame]:
    """(judged rows, front) of a round: floors in order, one row of each fingerprint, then the front."""
    prices = t.part.select("p_partkey", F.col("p_retailprice").alias("price"))
    rows = placed_parts(t).join(prices, "p_partkey")
    judged = store.round_floors(rows, [("hull", F.col("e_above_hull") <= 0.6), ("size", F.col("p_size") >= 5), ("price", F.col("price") > 902)])
    best = judged.filter("removed_by is null").groupBy("sys", "p_size").agg(F.max_by(F.struct("p_partkey", "price", r("e_above_hull", 9).alias("d")), F.struct("price", -F.col("p_partkey"))).alias("b")).select("sys", "p_size", "b.*")
    return judged, ranking.pareto_front(best, [], "d", "price", 8)


@query(ROUND_SQL + "SELECT coalesce(removed_by, 'kept') AS step, count(*) AS n FROM g GROUP BY 1 UNION ALL SELECT 'distinct', count(*) FROM u UNION ALL SELECT 'front', count(*) FROM fr")
def loop_round(t):
    judged, front = _round(t)
    kept = judged.filter("removed_by is null").select("sys", "p_size").distinct()
    steps = judged.groupBy(F.coalesce("removed_by", F.lit("kept")).alias("step")).agg(F.count("*").alias("n"))
    return steps.unionByName(kept.agg(F.lit("distinct").alias("step"), F.count("*").alias("n"))).unionByName(front.agg(F.lit("front").alias("step"), F.count("*").alias("n")))


@query(ROUND_SQL + ", o AS (SELECT *, row_number() OVER (ORDER BY d, p_retailprice, p_partkey) - 1 AS place, count(*) OVER () AS n FROM fr) SELECT p_partkey, CAST(place AS BIGINT) AS place FROM o WHERE place IN (SELECT CAST(round_even(i * (n - 1) / greatest(least(5, n) - 1, 1)::DOUBLE, 0) AS BIGINT) FROM (SELECT unnest(range(0, least(5, n))) AS i, n FROM (SELECT DISTINCT n FROM o)))")
def spread_picks(t):
    return store.spread_picks(_round(t)[1], ["d", "price", "p_partkey"], 5).select("p_partkey", long("place").alias("place"))


@query("SELECT p_brand, CAST(row_number() OVER (ORDER BY m DESC, p_brand) AS BIGINT) AS place, CAST(round(40 * m / max(m) OVER ()) AS BIGINT) AS bar FROM (SELECT p_brand, max(p_retailprice) AS m FROM part GROUP BY p_brand) ORDER BY place LIMIT 20")
def ranked_list(t):
    """The best of each formula, by merit, the first twenty with the width of their bar."""
    return summaries.ranked(t.part, "p_brand", "p_retailprice", 20).select("p_brand", "place", "bar")


@query(f"WITH {HULL_SQL} SELECT p_partkey, sys, round(above, 5) + 0.0 AS e_above_hull FROM p ORDER BY round(above, 9), p_partkey LIMIT 10")
def nearest_to_hull(t):
    return placed_parts(t).orderBy(r("e_above_hull", 9), "p_partkey").limit(10).select("p_partkey", "sys", (r("e_above_hull", 5) + 0.0).alias("e_above_hull"))


_PAIRS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("WITH r AS (SELECT " + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r{i}" for i, c in enumerate(_PAIRS)) + " FROM lineitem) "
       + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr(r{i}, r{j}), 6) + 0.0 AS rho, abs(corr(r{i}, r{j})) > 0.9 AS collinear FROM r" for i, a in enumerate(_PAIRS) for j, b in enumerate(_PAIRS) if i < j))
def collinearity(t):
    """Rank correlation of every pair of descriptors; a pair above 0.9 says the same twice."""
    rho = stats.rank_correlations(t.lineitem, list(_PAIRS))
    return rho.select("a", "b", (r("rho", 6) + 0.0).alias("rho"), (F.abs("rho") > 0.9).alias("collinear"))


@query(f"WITH {HULL_SQL}, v AS (SELECT sys, count(*) AS entries FROM a GROUP BY sys) SELECT sys, round(min(above), 5) + 0.0 AS parent_above, max(entries) AS entries FROM p JOIN v USING (sys) WHERE p_partkey % 5 = 0 GROUP BY sys")
def hull_audit(t):
    """Entries of every system and how far its own compounds lie above the hull of all."""
    both = placed_parts(t).select("sys", "x", "e", "p_partkey")
    ends = both.select("sys").distinct().withColumn("x", F.explode(F.array(F.lit(0.0), F.lit(1.0)))).withColumn("e", F.lit(0.0))
    entries = both.select("sys", "x", "e").unionByName(ends).groupBy("sys", "x").agg(F.min("e").alias("e"))
    out = store.hull_audit(entries, both.filter("p_partkey % 5 = 0"))
    return out.filter("parent_above is not null").select("sys", (r("parent_above", 5) + 0.0).alias("parent_above"), "entries")


# --- settings, texts, progress ---------------------------------------------------------------------------------------


@query("SELECT p_partkey, 'A=' || CASE WHEN p_size % 2 = 0 THEN 'child' ELSE 'parent' END || ',B=parent,C=child' AS recipe, 'A=' || CASE WHEN p_size % 2 = 0 THEN 'parent' ELSE 'parent' END || ',B=parent,C=child' AS exclusions FROM part")
def recipe_inheritance(t):
    """A child's settings over its parent's, and exclusions whose reasons on file stay."""
    parent = F.create_map(F.lit("A"), F.lit("parent"), F.lit("B"), F.lit("parent"))
    child = F.map_filter(F.create_map(F.lit("A"), F.when(F.col("p_size") % 2 == 0, "child"), F.lit("C"), F.lit("child")), lambda _, v: v.isNotNull())
    shown = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return t.part.select("p_partkey", shown(rec.inherited(parent, child)).alias("recipe"), shown(rec.merged_exclusions(parent, child)).alias("exclusions"))


@query("SELECT event_id, least(5.0 * 2 ** (event_id % 9), 480.0) AS wait_s, event_type IN ('error', 'view') AS retried, CASE WHEN value * 1000 < 60 THEN CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR) || 's' WHEN value * 1000 < 3600 THEN CAST(CAST(floor(value * 1000 / 60) AS BIGINT) AS VARCHAR) || 'm' WHEN value * 1000 < 86400 THEN CAST(CAST(floor(value * 1000 / 3600) AS BIGINT) AS VARCHAR) || 'h' ELSE CAST(CAST(floor(value * 1000 / 86400) AS BIGINT) AS VARCHAR) || 'd' END AS age, "
       "date_sub('minute', ts, TIMESTAMP '2024-03-01') AS stale, ceil(event_id % 100 * 1.5) / 60 AS gpu_minutes FROM events")
def waits_and_ages(t):
    message = F.when(F.col("event_type") == "error", "database is locked").when(F.col("event_type") == "view", "Stale file handle").otherwise("no such table")
    return t.events.select("event_id", rec.backoff_seconds(F.col("event_id") % 9).alias("wait_s"), rec.transient(message).alias("retried"), rec.age_text(F.col("value") * 1000).alias("age"), rec.stale_minutes(F.col("ts"), F.lit("2024-03-01").cast("timestamp")).alias("stale"), rec.gpu_minutes(F.col("event_id") % 100).alias("gpu_minutes"))


@query("SELECT o_orderkey, o_orderstatus IN ('F', 'P') OR o_orderkey % 7 = 0 AS selected, coalesce(CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END, o_orderstatus) AS verdict FROM orders")
def history_flags(t):
    """Whether a structure was ever selected, and the verdict of a gate: the record's if known, else the table's."""
    state = F.when(F.col("o_orderstatus") == "F", "dft_done").when(F.col("o_orderstatus") == "P", "selected").otherwise("screened")
    known = t.orders.filter("o_orderkey % 4 > 0").select("o_orderkey", F.col("o_orderpriority").alias("recorded"))
    return t.orders.join(known, "o_orderkey", "left").select("o_orderkey", rec.selected_flag(F.col("o_orderkey") % 7 == 0, state).alias("selected"), F.coalesce("recorded", "o_orderstatus").alias("verdict"))


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 9) AS norm2 FROM embeddings WHERE embedding IS NOT NULL")
def float64_arrays(t):
    """Result arrays of single precision taken as doubles before anything is summed."""
    return t.embeddings.filter("embedding is not null").select("vec_id", r(F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x), 9).alias("norm2"))


@query("SELECT p_partkey, 'Fe' || (p_size % 5 + 1) <> 'Fe' || (p_size % 4 + 1) AS mismatch FROM part")
def composition_match(t):
    made, asked = (fm.canonical(_counts(Fe=F.col("p_size") % n + 1)) for n in (5, 4))
    return t.part.select("p_partkey", rec.composition_mismatch(asked, made).alias("mismatch"))
