"""Every operator bound to the test tables: a query and, where SQL can say it, the SQL that DuckDB runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.functions import formula as fm
from funnelspark.functions import values as fv
from funnelspark.operators import coverage, dedup, enumerate as en, facets, gates, guards, hull, jobs, ranges, ranking, stats, summaries
from funnelspark.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def long(c) -> F.Column:
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


def r(c, digits: int = 4) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# --- hulls -----------------------------------------------------------------------------------------------------------


def _part_entries(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", F.col("p_brand").alias("sys"), ((F.col("p_size") - 1) / F.lit(49.0)).alias("x"), (-F.col("p_retailprice") / 1000.0).alias("e"), "p_size", "p_type", "p_retailprice")
    ends = t.part.select(F.col("p_brand").alias("sys")).distinct().select(F.lit(None).cast("long").alias("p_partkey"), "sys", F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("x"), F.lit(0.0).alias("e"), F.lit(None).cast("int").alias("p_size"), F.lit(None).cast("string").alias("p_type"), F.lit(None).cast("double").alias("p_retailprice"))
    return parts.unionByName(ends)


def placed_parts(t: Tables) -> DataFrame:
    return hull.place_binary(_part_entries(t)).filter("p_partkey is not null")


HULL_SQL = """
e AS (SELECT p_partkey, p_brand AS sys, CAST(p_size - 1 AS DOUBLE) / 49 AS x, -p_retailprice / 1000 AS e, p_size, p_type FROM part),
a AS (SELECT sys, x, min(e) AS e FROM (SELECT sys, x, e FROM e UNION ALL SELECT DISTINCT sys, 0.0, 0.0 FROM e UNION ALL SELECT DISTINCT sys, 1.0, 0.0 FROM e) GROUP BY sys, x),
s AS (SELECT DISTINCT sys, x FROM e),
h AS (SELECT s.sys, s.x, min(CASE WHEN l.x = u.x THEN l.e ELSE l.e + (u.e - l.e) * (s.x - l.x) / (u.x - l.x) END) AS hull
      FROM s JOIN a l ON l.sys = s.sys AND l.x <= s.x JOIN a u ON u.sys = s.sys AND u.x >= s.x WHERE l.x < u.x OR l.x = s.x GROUP BY s.sys, s.x),
p AS (SELECT e.*, hull, e.e - hull AS above FROM e JOIN h USING (sys, x))
"""


@query(f"WITH {HULL_SQL} SELECT p_partkey, round(above, 5) + 0.0 AS e_above_hull, above <= 1e-9 AS stable FROM p")
def hull_binary_part(t):
    return placed_parts(t).select("p_partkey", (r("e_above_hull", 5) + 0.0).alias("e_above_hull"), "stable")


# Columns need a session, so gates are made when a query is.
def cascade_gates() -> list[gates.Gate]:
    return [gates.at_most("hull_distance", "e_above_hull", 0.5), gates.at_least("size_floor", "p_size", 5)]


CASCADE_SQL = f"""WITH {HULL_SQL},
j AS (SELECT *, CASE WHEN NOT above <= 0.5 THEN 'hull_distance' WHEN NOT p_size >= 5 THEN 'size_floor' END AS reason FROM p),
k AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY round(above, 9), p_partkey) AS rk FROM j WHERE reason IS NULL),
ev AS (SELECT 'hull_distance' AS gate, above <= 0.5 AS passed FROM p UNION ALL SELECT 'size_floor', p_size >= 5 FROM p WHERE above <= 0.5 UNION ALL SELECT 'cap', rk <= 10 FROM k)
"""


def cascade(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(ranked survivors with kept, events) of the filter cascade: cuts first, the cap after them."""
    judged = gates.judge(placed_parts(t), cascade_gates())
    capped = gates.cap_per_group(judged.filter("reason is null"), "p_type", [r("e_above_hull", 9), F.col("p_partkey")], 10)
    cap_events = capped.select(F.col("p_partkey").alias("id"), F.lit("cap").alias("gate"), F.col("kept").alias("passed"), F.col("rank").cast("double").alias("value"), F.lit(10.0).alias("threshold"))
    return capped, gates.events(judged, cascade_gates(), "p_partkey").unionByName(cap_events)


@query(CASCADE_SQL + "SELECT gate, count(*) AS seen, CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS passed, CAST(sum(CASE WHEN passed THEN 0 ELSE 1 END) AS BIGINT) AS rejected FROM ev GROUP BY gate")
def filter_cascade_part(t):
    return gates.funnel(cascade(t)[1], ["hull_distance", "size_floor", "cap"]).select("gate", "seen", "passed", "rejected")


@query(CASCADE_SQL + "SELECT p_partkey, p_type, CAST(rk AS INTEGER) AS rank, round(above, 5) + 0.0 AS e_above_hull FROM k WHERE rk <= 10")
def filter_selected_part(t):
    return cascade(t)[0].filter("kept").select("p_partkey", "p_type", "rank", (r("e_above_hull", 5) + 0.0).alias("e_above_hull"))


TERNARY = """
b AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey % 20 AS sys, CAST(l_linenumber % 4 AS INTEGER) AS a, CAST(l_partkey % 4 AS INTEGER) AS b, CAST(l_orderkey % 3 AS INTEGER) AS c, -l_extendedprice / 100000 AS e0 FROM lineitem),
f AS (SELECT id, sys, CAST(a AS DOUBLE) / (a + b + c) AS x, CAST(b AS DOUBLE) / (a + b + c) AS y, e0 AS e FROM b WHERE a + b + c > 0 AND (CASE WHEN a > 0 THEN 1 ELSE 0 END + CASE WHEN b > 0 THEN 1 ELSE 0 END + CASE WHEN c > 0 THEN 1 ELSE 0 END) > 1),
v AS (SELECT sys, x, y, min(e) AS e FROM (SELECT sys, x, y, e FROM f UNION ALL SELECT DISTINCT sys, 1.0, 0.0, 0.0 FROM f UNION ALL SELECT DISTINCT sys, 0.0, 1.0, 0.0 FROM f UNION ALL SELECT DISTINCT sys, 0.0, 0.0, 0.0 FROM f) GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY sys ORDER BY x, y) AS i FROM v),
t AS (SELECT p.sys, p.x AS px, p.y AS py, p.e AS pe, q.x AS qx, q.y AS qy, q.e AS qe, s.x AS sx, s.y AS sy, s.e AS se,
        (q.y - s.y) * (p.x - s.x) + (s.x - q.x) * (p.y - s.y) AS det FROM n p JOIN n q ON p.sys = q.sys AND p.i < q.i JOIN n s ON s.sys = q.sys AND q.i < s.i),
d AS (SELECT DISTINCT sys, x, y FROM f),
w AS (SELECT d.sys, d.x, d.y, pe, qe, se, ((qy - sy) * (d.x - sx) + (sx - qx) * (d.y - sy)) / det AS l1, ((sy - py) * (d.x - sx) + (px - sx) * (d.y - sy)) / det AS l2
      FROM d JOIN t ON t.sys = d.sys AND abs(det) > 1e-9),
h AS (SELECT sys, x, y, min(l1 * pe + l2 * qe + (1 - l1 - l2) * se) AS hull FROM w WHERE l1 >= -1e-12 AND l2 >= -1e-12 AND l1 + l2 <= 1 + 1e-12 GROUP BY sys, x, y)
"""


def ternary_entries(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(id, sys, fractions, e) of compounds of three components, and the end members of their systems (ids -1 to -3)."""
    counts = F.array(F.col("l_linenumber") % 4, F.col("l_partkey") % 4, F.col("l_orderkey") % 3)
    rows = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_suppkey") % 20).alias("sys"), counts.alias("c"), (-F.col("l_extendedprice") / 100000.0).alias("e"))
    total = F.aggregate("c", F.lit(0).cast("long"), lambda a, v: a + v)
    rows = rows.withColumn("s", total).filter((F.col("s") > 0) & (F.size(F.filter("c", lambda v: v > 0)) > 1))
    rows = rows.select("id", "sys", F.transform("c", lambda v: v.cast("double") / F.col("s")).alias("fractions"), "e")
    corners = F.posexplode(F.array(*(F.array(*(F.lit(float(i == j)) for j in range(3))) for i in range(3)))).alias("i", "fractions")
    ends = rows.select("sys").distinct().select("sys", corners).select((-1 - F.col("i")).cast("long").alias("id"), "sys", "fractions", F.lit(0.0).alias("e"))
    return rows, ends


@query(f"WITH {TERNARY} SELECT sys, count(*) AS n, CAST(sum(CASE WHEN e - hull <= 1e-9 THEN 1 ELSE 0 END) AS BIGINT) AS n_stable, round(avg(e - hull), 6) AS mean_above FROM f JOIN h USING (sys, x, y) GROUP BY sys")
def hull_ternary_lineitem(t):
    rows, ends = ternary_entries(t)
    placed = facets.place(rows.unionByName(ends), 3).filter("id >= 0")
    return placed.groupBy("sys").agg(F.count("*").alias("n"), F.sum(F.col("stable").cast("long")).alias("n_stable"), r(F.avg("e_above_hull"), 6).alias("mean_above"))


@query("SELECT o_custkey, count(DISTINCT o_orderstatus) AS n FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1")
def hull_guards(t):
    return guards.one_value(t.orders, ["o_custkey"], "o_orderstatus", blank_exempt=True).select("o_custkey", "n")


@query("SELECT p_brand, array_to_string(list_sort(list(DISTINCT el) FILTER (el NOT IN (SELECT el FROM (SELECT p_brand AS b2, 'S' || p_size % 5 AS el FROM part WHERE p_partkey % 7 = 0) z WHERE z.b2 = p_brand))), ',') AS missing FROM (SELECT p_brand, 'S' || p_size % 5 AS el FROM part UNION ALL SELECT p_brand, 'T' || p_size % 3 FROM part) GROUP BY p_brand")
def hull_end_members(t):
    pair = F.create_map(F.concat(F.lit("S"), (F.col("p_size") % 5).cast("string")), F.lit(1), F.concat(F.lit("T"), (F.col("p_size") % 3).cast("string")), F.lit(1))
    alone = F.create_map(F.concat(F.lit("S"), (F.col("p_size") % 5).cast("string")), F.lit(1))
    rows = t.part.select("p_brand", pair.alias("counts")).unionByName(t.part.filter("p_partkey % 7 = 0").select("p_brand", alone.alias("counts")))
    return guards.end_members(rows, "p_brand").select("p_brand", F.array_join("missing", ",").alias("missing"))


# --- gates and events ------------------------------------------------------------------------------------------------


@query("SELECT event_type AS gate, count(*) AS seen, CAST(sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS BIGINT) AS passed, CAST(sum(CASE WHEN value > 100 THEN 0 ELSE 1 END) AS BIGINT) AS rejected, CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS BIGINT) AS place FROM events GROUP BY event_type")
def funnel_events(t):
    rows = t.events.select(F.col("event_type").alias("gate"), F.coalesce(F.col("value") > 100, F.lit(False)).alias("passed"))
    return gates.funnel(rows, ["view", "click", "signup"]).withColumn("place", long("place"))


def line_gates() -> list[gates.Gate]:
    return [gates.at_most("quantity", "l_quantity", 40), gates.at_most("discount", "l_discount", 0.08), gates.at_least("price", "l_extendedprice", 1000), gates.at_least("tax", "l_tax", 0)]


@query("""WITH j AS (SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN NOT coalesce(l_quantity <= 40, false) THEN 'quantity' WHEN NOT coalesce(l_discount <= 0.08, false) THEN 'discount' WHEN NOT coalesce(l_extendedprice >= 1000, false) THEN 'price' WHEN NOT coalesce(l_tax >= 0, false) THEN 'tax' END AS reason FROM lineitem),
e AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY id) AS rn FROM j WHERE reason IS NOT NULL),
k AS (SELECT unnest(['quantity', 'discount', 'price', 'tax']) AS reason)
SELECT k.reason, count(e.id) AS n, coalesce(string_agg(CAST(e.id AS VARCHAR), ',' ORDER BY e.id) FILTER (rn <= 5), '') AS examples FROM k LEFT JOIN e USING (reason) GROUP BY k.reason""")
def rejection_log(t):
    rows = t.lineitem.withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    out = gates.rejection_log(gates.judge(rows, line_gates()), "id", [g.name for g in line_gates()])
    return out.select("reason", "n", F.coalesce(F.array_join("examples", ","), F.lit("")).alias("examples"))


@query("""WITH s AS (SELECT l_orderkey, sum(l_extendedprice) AS x FROM lineitem GROUP BY 1), p AS (SELECT o_totalprice AS y, x FROM orders JOIN s ON l_orderkey = o_orderkey),
f AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM p), c AS (SELECT (100000 - b) / a AS cut FROM f)
SELECT round(cut, 2) AS threshold, 'calibrated by pilot' AS how, (SELECT count(*) FROM p WHERE x <= cut) AS n FROM c""")
def threshold_convert(t):
    sums = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("x"))
    points = t.orders.join(sums, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_totalprice").alias("y"), "x")
    fits = stats.fit_line(points, [], "x", "y").select(F.lit(1).alias("id"), F.lit("pilot").alias("kind"), "alpha", "beta")
    cut = gates.calibrated_threshold(fits, 100000.0)
    passed = points.join(F.broadcast(cut), F.col("x") <= F.col("threshold"))
    return passed.groupBy("threshold", "how").agg(F.count("*").alias("n")).select(r("threshold", 2).alias("threshold"), "how", "n")


@query("WITH f AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events WHERE value > 100 AND event_type IN ('error', 'click')) SELECT user_id, event_type AS gate, round(value, 4) AS value FROM f WHERE rn = 1")
def stopped_at(t):
    rows = t.events.select("user_id", "event_id", F.col("event_type").alias("gate"), (~F.coalesce(F.col("value") > 100, F.lit(False))).alias("passed"), "value")
    return gates.last_stop(rows, "user_id", "event_id", ("error", "click")).select("user_id", "gate", r("value").alias("value"))


# --- jobs, states, accounting ----------------------------------------------------------------------------------------


@query("""WITH e AS (SELECT l_returnflag AS engine, l_orderkey, max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS ok, min(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS all_ok FROM lineitem GROUP BY 1, 2),
c AS (SELECT engine, sum(ok) AS converged, sum(1 - ok) AS not_converged, sum(CASE WHEN ok > all_ok THEN 1 ELSE 0 END) AS retried FROM e GROUP BY 1)
SELECT engine, 'converged' AS outcome, CAST(converged AS BIGINT) AS n FROM c WHERE converged > 0 UNION ALL SELECT engine, 'not_converged', CAST(not_converged AS BIGINT) FROM c WHERE not_converged > 0 UNION ALL SELECT engine, 'retried', CAST(retried AS BIGINT) FROM c WHERE retried > 0""")
def relaxation_outcomes(t):
    rows = t.lineitem.select(F.col("l_returnflag").alias("engine"), "l_orderkey", (F.col("l_linestatus") == "F").alias("converged"))
    return jobs.outcomes(rows, "engine", "l_orderkey", "converged").withColumn("n", long("n"))


@query("WITH y AS (SELECT l_orderkey, max(l_linenumber) AS t, count(*) AS p FROM lineitem WHERE l_quantity > 5 GROUP BY 1) SELECT count(*) AS n, CAST(coalesce(sum(t), 0) AS BIGINT) AS target, CAST(coalesce(sum(p), 0) AS BIGINT) AS produced, CAST(coalesce(sum(CASE WHEN p < t THEN 1 ELSE 0 END), 0) AS BIGINT) AS short FROM y JOIN orders ON l_orderkey = o_orderkey")
def generation_yield(t):
    rows = t.lineitem.filter("l_quantity > 5").groupBy("l_orderkey").agg(F.max("l_linenumber").alias("t"), F.count("*").alias("p"))
    out = jobs.yield_of(rows.join(t.orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")), "t", "p")
    return out.select(*(long(c).alias(c) for c in out.columns))


@query("SELECT o_orderstatus AS state, count(*) AS n FROM orders GROUP BY 1")
def state_counts(t):
    return summaries.counts_by(t.orders.withColumnRenamed("o_orderstatus", "state"), "state")


@query("SELECT o_orderpriority AS stage, coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN 1 END), 0)::BIGINT AS f, coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN 1 END), 0)::BIGINT AS o, coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN 1 END), 0)::BIGINT AS p FROM orders GROUP BY 1")
def job_counts(t):
    table = summaries.state_table(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])
    return table.select(F.col("o_orderpriority").alias("stage"), *(F.col(c).alias(c.lower()) for c in "FOP"))


@query("""WITH a AS (SELECT o_orderpriority AS stage, count(*) AS n, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 1000 ELSE 0 END) AS spent, sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) AS fl, avg(CASE WHEN o_orderstatus = 'F' AND o_totalprice > 0 THEN o_totalprice / 1000 END) AS m FROM orders GROUP BY 1)
SELECT stage, n, round(spent, 3) AS spent, CAST(fl AS BIGINT) AS in_flight, round(m, 4) AS mean_done, round(spent + fl * coalesce(m, 0), 3) AS projected FROM a""")
def accounting(t):
    rows = t.orders.select(F.col("o_orderpriority").alias("stage"), "o_orderstatus", (F.col("o_totalprice") / 1000.0).alias("hours"))
    out = jobs.accounting(rows, ["stage"], "o_orderstatus", "hours", ["F"], ["O", "P"])
    return out.select("stage", "n", r("spent", 3).alias("spent"), long("in_flight").alias("in_flight"), r("mean_done").alias("mean_done"), r("projected", 3).alias("projected"))


@query("""WITH w AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN l_extendedprice END AS h FROM lineitem),
n AS (SELECT *, count(*) FILTER (h IS NULL) OVER (PARTITION BY l_orderkey) AS k FROM w)
SELECT l_orderkey, l_linenumber, round(coalesce(h, o_totalprice / k), 4) AS hours FROM n LEFT JOIN orders ON o_orderkey = l_orderkey""")
def accounting_shares(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") == 1, F.col("l_extendedprice")).alias("hours"))
    whole = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("hours"))
    return jobs.share_out(rows, whole, "l_orderkey", "hours").select("l_orderkey", "l_linenumber", r("hours").alias("hours"))


@query("""WITH g AS (SELECT l_orderkey, min(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 2 END) AS live, min(CASE l_returnflag WHEN 'A' THEN 1 END) AS done, max(l_quantity) AS elapsed, sum(l_linenumber) AS cpus FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE live WHEN 1 THEN 'R' WHEN 2 THEN 'N' ELSE CASE done WHEN 1 THEN 'A' END END AS state, elapsed, CAST(cpus AS BIGINT) AS cpus FROM g""")
def array_aggregate(t):
    rows = t.lineitem.select("l_orderkey", F.col("l_returnflag").alias("state"), F.col("l_quantity").alias("elapsed"), F.col("l_linenumber").alias("cpus"))
    return jobs.aggregate_tasks(rows, "l_orderkey", "state", ["R", "N"], ["A"], "elapsed", "cpus").withColumn("cpus", long("cpus"))


@query("""WITH f AS (SELECT l_orderkey AS k, CASE WHEN bool_and(l_linestatus = 'F') THEN 'F' ELSE 'O' END AS s FROM lineitem WHERE l_quantity > 10 GROUP BY 1), l AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 5 <> 0),
j AS (SELECT coalesce(l.k, f.k) AS k, l.s AS l, f.s AS f, f.s IS NOT NULL AND (l.s IS NULL OR l.s = 'unknown' OR (l.s NOT IN ('F') AND f.s IN ('F'))) AS o FROM l FULL JOIN f ON l.k = f.k)
SELECT CASE WHEN o THEN f ELSE l END AS state, CASE WHEN o THEN 'finished' ELSE 'live' END AS source, count(*) AS n FROM j GROUP BY 1, 2""")
def status_merge(t):
    done = t.lineitem.filter("l_quantity > 10").groupBy(F.col("l_orderkey").alias("k")).agg(F.when(F.bool_and(F.col("l_linestatus") == "F"), "F").otherwise("O").alias("state"))
    live = t.orders.filter("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("state"))
    return jobs.merge_status(live, done, "k", "state", ["F"]).groupBy("state", "source").agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority AS stage, in_flight, greatest(least(m, 3000 - in_flight * 0, 2800) - in_flight, 0) AS room, CASE WHEN m <= 3000 AND m <= 2800 THEN 'queue' WHEN 3000 <= 2800 THEN 'array' ELSE 'user' END AS binding FROM (SELECT o_orderpriority, CAST(count(*) FILTER (o_orderstatus <> 'F') AS BIGINT) AS in_flight, CAST(count(*) AS BIGINT) AS m FROM orders GROUP BY 1)")
def throttle(t):
    loads = t.orders.groupBy(F.col("o_orderpriority").alias("stage")).agg(F.sum(F.when(F.col("o_orderstatus") != "F", 1).otherwise(0)).alias("in_flight"), F.count("*").alias("m"))
    limits = [("queue", F.col("m")), ("array", F.lit(3000).cast("long")), ("user", F.lit(2800).cast("long"))]
    return jobs.throttle(loads, "in_flight", limits).select("stage", "in_flight", long("room").alias("room"), "binding")


@query("""SELECT event_id, CASE event_type WHEN 'error' THEN CASE WHEN event_id % 4 < 2 THEN 'resubmit' ELSE 'give_up' END WHEN 'click' THEN CASE WHEN event_id % 4 < 3 THEN 'more_time' ELSE 'give_up' END END AS action, CASE event_type WHEN 'error' THEN 'retry' WHEN 'purchase' THEN 'more_time' END AS remedy FROM events""")
def retry_rules(t):
    rows = t.events.withColumn("attempts", F.col("event_id") % 4)
    out = jobs.retry(rows, F.array("event_type"), [("error", "resubmit", 2), ("click", "more_time", 3)], "attempts")
    state = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "timeout").otherwise("done")
    return out.select("event_id", "action", fv.remedy(state, F.lit(0)).alias("remedy"))


@query("SELECT o_custkey, count(*) AS n, bool_and(a IS NOT DISTINCT FROM b) AS agrees FROM (SELECT o_custkey, o_orderstatus AS a, (SELECT max(l_linestatus) FROM lineitem WHERE l_orderkey = o_orderkey) AS b FROM orders) GROUP BY 1")
def three_way_audit(t):
    disk = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_linestatus").alias("s"))
    db = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    audit = jobs.reconcile({"db": db, "disk": disk}, "k", "s")
    owners = t.orders.select(F.col("o_orderkey").alias("k"), "o_custkey")
    return audit.join(owners, "k").groupBy("o_custkey").agg(F.count("*").alias("n"), F.bool_and("agrees").alias("agrees"))


@query("SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(ceil(n / 20.0)) AS BIGINT) AS tasks FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)")
def task_estimate(t):
    return jobs.task_estimate(t.customer, "c_mktsegment", 20)


@query("SELECT user_id, event_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, isl ORDER BY event_id) AS BIGINT) AS idle FROM (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS isl FROM events)")
def idle_cycles(t):
    rows = t.events.withColumn("active", F.col("event_type") == "purchase")
    return ranking.idle_runs(rows, "event_id", "active", ["user_id"]).select("user_id", "event_id", long("idle").alias("idle"))


@query("SELECT user_id, CAST(seg AS BIGINT) AS segment, count(*) AS n FROM (SELECT user_id, coalesce(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM events) GROUP BY 1, 2")
def step_segments(t):
    return ranking.segments(t.events, "user_id", "event_id", F.col("event_type") == "signup").withColumn("segment", long("segment"))


# --- joins, coverage, set operations ---------------------------------------------------------------------------------


@query("SELECT count(*) AS n FROM customer c WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def unplaced_candidates(t):
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return coverage.pending(t.customer, [(o, "c_custkey")], [(o.filter("o_orderstatus = 'P'"), "c_custkey"), (o.filter("o_totalprice > 450000"), "c_custkey")]).agg(F.count("*").alias("n"))


@query("SELECT p_brand, CASE WHEN h THEN 'have' WHEN p_partkey % 11 = 0 OR p_retailprice > 1800 THEN 'ignored' ELSE 'missing' END AS status, count(*) AS n FROM (SELECT p_brand, p_partkey, p_retailprice, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49) AS h FROM part) GROUP BY 1, 2")
def coverage_report(t):
    have = t.lineitem.filter("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey"))
    out = coverage.classify(t.part, have, t.part.filter("p_partkey % 11 = 0"), "p_partkey", "p_retailprice", 1800.0)
    return out.groupBy("p_brand", "status").agg(F.count("*").alias("n"))


ORDER_SYSTEMS = "SELECT l_orderkey, string_agg(DISTINCT p_brand, '-' ORDER BY p_brand) AS sys, list_sort(list(DISTINCT p_brand)) AS el FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1"


def _order_systems(t: Tables) -> DataFrame:
    """Of every order with a line whose part has a brand, the brands; as in SQL, one without any has no system."""
    brands = t.lineitem.join(t.part.filter("p_brand is not null"), F.col("p_partkey") == F.col("l_partkey"))
    return brands.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("p_brand")), "-").alias("chemsys"))


@query("""WITH b AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS i FROM (SELECT DISTINCT p_brand FROM part)),
s AS (SELECT l_orderkey, bit_or(CAST(1 AS BIGINT) << i) AS mask, string_agg(DISTINCT p_brand, '-' ORDER BY p_brand) AS sys FROM lineitem JOIN part ON p_partkey = l_partkey JOIN b USING (p_brand) GROUP BY 1),
c AS (SELECT mask, min(sys) AS sys, count(*) AS n FROM s GROUP BY 1) SELECT t.sys AS target, CAST(sum(o.n) AS BIGINT) AS n FROM c t JOIN c o ON (o.mask & ~t.mask) = 0 GROUP BY 1""")
def subsystem_containment(t):
    systems = _order_systems(t)
    return coverage.containment_counts(systems, systems)


@query(f"""WITH s AS (SELECT DISTINCT sys FROM ({ORDER_SYSTEMS})), m AS (SELECT DISTINCT array_to_string(list_filter(string_split(sys, '-'), lambda x, i: (k >> (i - 1)) & 1 = 1), '-') AS sub FROM s, range(1, 64) g(k) WHERE len(string_split(sys, '-')) <= 6 AND k < (1 << len(string_split(sys, '-'))))
SELECT sub AS chemsys FROM m WHERE sub NOT IN (SELECT sys FROM s)""")
def missing_subsystems(t):
    """The subsystems of all orders' systems of up to six elements that no order has by itself."""
    systems = _order_systems(t)
    return coverage.missing_subsystems(systems.filter(F.size(F.split("chemsys", "-")) <= 6).select("chemsys").distinct(), systems).select("chemsys").distinct()


@query("""WITH q AS (SELECT l_suppkey AS k, year(l_shipdate) AS y, round(avg(l_extendedprice), 2) AS v FROM lineitem GROUP BY 1, 2), a AS (SELECT * FROM q WHERE y = 1995), b AS (SELECT * FROM q WHERE y = 1996)
SELECT * FROM (SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN '+' WHEN b.k IS NULL THEN '-' WHEN abs(a.v - b.v) > 100 THEN '~' END AS change FROM a FULL JOIN b ON a.k = b.k) WHERE change IS NOT NULL""")
def snapshot_diff(t):
    by_year = t.lineitem.groupBy(F.col("l_suppkey").alias("k"), F.year("l_shipdate").alias("y")).agg(F.round(F.avg("l_extendedprice"), 2).alias("v"))
    return coverage.snapshot_diff(by_year.filter("y = 1995"), by_year.filter("y = 1996"), "k", ["v"], 100.0)


@query("SELECT o_custkey, left(sha256(string_agg(o_orderkey || ':' || CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY o_orderkey || ':' || CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR))), 16) AS set_hash FROM orders GROUP BY 1")
def snapshot_hash(t):
    rows = t.orders.select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return coverage.set_hash(rows, ["o_custkey"], ["o_orderkey", "cents"])


@query("SELECT d.doc_id, 'sha256:' || left(sha256(d.text), 16) AS content_hash FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE sha256(b.text) = sha256(d.text)) AND NOT EXISTS (SELECT 1 FROM documents e WHERE e.text = d.text AND e.doc_id < d.doc_id)")
def content_hash(t):
    hashed = lambda df: df.withColumn("content_hash", fv.content_hash(F.col("text")))
    fresh = dedup.new_arrivals(hashed(t.documents), hashed(t.benchmark), "content_hash")
    return dedup.first_wins(fresh.select("doc_id", "content_hash"), ["content_hash"], [F.col("doc_id")])


@query("SELECT p_type, CASE WHEN EXISTS (SELECT 1 FROM part k WHERE k.p_partkey % 3 = 0 AND k.p_type = c.p_type AND k.p_size = c.p_size AND k.p_brand = c.p_brand) THEN 'KNOWN' WHEN EXISTS (SELECT 1 FROM part k WHERE k.p_partkey % 3 = 0 AND k.p_type = c.p_type AND k.p_size = c.p_size) THEN 'new polymorph' ELSE 'NEW composition' END AS novelty, count(*) AS n FROM part c WHERE c.p_partkey % 3 <> 0 GROUP BY 1, 2")
def novelty(t):
    keyed = t.part.withColumns({"composition": F.concat_ws(":", "p_type", "p_size"), "exact": F.concat_ws(":", "p_type", "p_size", "p_brand")})
    out = coverage.novelty(keyed.filter("p_partkey % 3 <> 0"), keyed.filter("p_partkey % 3 = 0"), "composition", "exact")
    return out.groupBy("p_type", "novelty").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, coalesce(n, 0) AS siblings, round(best, 4) AS best_energy, n IS NOT NULL AS droppable FROM part LEFT JOIN (SELECT p_size AS s, p_brand AS b, count(*) AS n, min(p_retailprice) AS best FROM part WHERE p_partkey % 10 <> 0 GROUP BY 1, 2) ON s = p_size AND b = p_brand WHERE p_partkey % 10 = 0")
def exclusion_proposals(t):
    keyed = t.part.withColumn("c", F.concat_ws(":", "p_size", "p_brand"))
    out = coverage.exclusion_proposals(keyed.filter("p_partkey % 10 = 0").select("p_partkey", "c"), keyed.filter("p_partkey % 10 <> 0"), "c", "p_retailprice")
    return out.select("p_partkey", "siblings", r("best_energy").alias("best_energy"), "droppable")


@query("SELECT c_mktsegment, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS sources FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1 HAVING count(DISTINCT n_name) > 1")
def source_collisions(t):
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return coverage.collisions(rows, "c_mktsegment", "n_name").select("c_mktsegment", F.array_join("sources", ",").alias("sources"))


# --- statistics ------------------------------------------------------------------------------------------------------

ORDER_PAIRS = "SELECT o_orderkey, o_orderpriority AS g, o_totalprice AS a, b FROM orders JOIN (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS b FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"


def _order_pairs(t: Tables) -> DataFrame:
    sums = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("b"))
    return t.orders.join(sums, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", F.col("o_orderpriority").alias("g"), F.col("o_totalprice").alias("a"), "b")


@query(f"WITH p AS ({ORDER_PAIRS}), s AS (SELECT g, count(*) AS n, avg(abs(a - b)) AS mae, sqrt(avg((a - b) * (a - b))) AS rmse, avg(a - b) AS bias, max(abs(a - b)) AS worst FROM p GROUP BY 1) SELECT g, n, round(mae, 2) AS mae, round(rmse, 2) AS rmse, round(bias, 2) AS bias, round(worst, 2) AS worst, CASE WHEN mae > 200000 THEN 'fail' WHEN abs(bias) > 10000 OR worst > 400000 THEN 'warn' ELSE 'pass' END AS verdict, CAST((mae > 200000)::INT + (abs(bias) > 10000)::INT + (worst > 400000)::INT AS INTEGER) AS n_reasons FROM s")
def parity_report(t):
    out = stats.parity(_order_pairs(t), ["g"], "a", "b")
    verdict, reasons = stats.verdict([(F.col("mae") > 200000, "large error")], [(F.abs("bias") > 10000, "bias"), (F.col("worst") > 400000, "outlier")])
    return out.select("g", "n", *(r(c, 2).alias(c) for c in ("mae", "rmse", "bias", "worst")), verdict.alias("verdict"), F.size(reasons).alias("n_reasons"))


@query("""WITH k AS (SELECT l_returnflag AS g, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS x, rank() OVER (PARTITION BY l_returnflag ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_returnflag, l_discount) - 1) / 2.0 AS y FROM lineitem) SELECT g, count(*) AS n, round(corr(x, y), 6) AS rho FROM k GROUP BY 1""")
def spearman_ties(t):
    out = stats.spearman(t.lineitem.withColumnRenamed("l_returnflag", "g"), ["g"], "l_quantity", "l_discount")
    return out.select("g", long("n").alias("n"), r("rho", 6).alias("rho"))


@query(f"WITH p AS ({ORDER_PAIRS}), f AS (SELECT g, count(*) AS n, regr_slope(b, a) AS s, regr_intercept(b, a) AS i, regr_r2(b, a) AS r FROM p GROUP BY 1) SELECT g, n, round(s, 6) AS alpha, round(i, 2) AS beta, round(r, 6) AS r2 FROM f")
def threshold_fit(t):
    out = stats.fit_line(_order_pairs(t), ["g"], "a", "b")
    return out.select("g", "n", r("alpha", 6).alias("alpha"), r("beta", 2).alias("beta"), r("r2", 6).alias("r2"))


@query(f"WITH p AS ({ORDER_PAIRS}), l AS (SELECT l_orderkey, p_type, sum(l_quantity) AS q FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2), s AS (SELECT *, q / sum(q) OVER (PARTITION BY l_orderkey) AS share FROM l) SELECT p_type, count(*) AS n, round(avg(abs(a - b) * share), 2) AS mae FROM s JOIN p ON o_orderkey = l_orderkey GROUP BY 1")
def per_element_mae(t):
    from pyspark.sql import Window as W

    parts = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).groupBy("l_orderkey", "p_type").agg(F.sum("l_quantity").alias("q"))
    shares = parts.withColumn("share", F.col("q") / F.sum("q").over(W.partitionBy("l_orderkey")))
    points = shares.join(_order_pairs(t), F.col("o_orderkey") == F.col("l_orderkey")).withColumn("err", F.col("a") - F.col("b"))
    return stats.share_weighted_mae(points, "p_type", "err", "share").select("p_type", "n", r("mae", 2).alias("mae"))


SUPPLIER_RANKS = "SELECT s_suppkey AS k, s_acctbal AS a, coalesce(b, 0) AS b FROM supplier LEFT JOIN (SELECT l_suppkey, round(sum(l_quantity), 2) AS b FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey"


@query(f"WITH s AS ({SUPPLIER_RANKS}), a AS (SELECT k FROM s ORDER BY a, k LIMIT 30), b AS (SELECT k FROM s ORDER BY b, k LIMIT 30) SELECT (SELECT count(*) FROM b) AS n, (SELECT count(*) FROM b WHERE k IN (SELECT k FROM a)) AS shared, coalesce((SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM b WHERE k NOT IN (SELECT k FROM a)), '') AS missed, round((SELECT count(*) FROM b WHERE k IN (SELECT k FROM a)) / (SELECT count(*) FROM b)::DOUBLE, 6) AS agreement")
def topn_agreement(t):
    sold = t.lineitem.groupBy("l_suppkey").agg(F.round(F.sum("l_quantity"), 2).alias("b"))
    rows = t.supplier.join(sold, F.col("l_suppkey") == F.col("s_suppkey"), "left").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("a"), F.coalesce("b", F.lit(0.0)).alias("b"))
    return stats.top_n_agreement(rows, "k", "a", "b", 30).select(long("n").alias("n"), long("shared").alias("shared"), F.array_join("missed", ",").alias("missed"), r("agreement", 6).alias("agreement"))


@query("""WITH q AS (SELECT l_orderkey, sum(l_quantity) AS w, sum(CASE WHEN p_size <= 17 THEN l_quantity ELSE 0 END) AS a, sum(CASE WHEN p_size > 17 AND p_size <= 34 THEN l_quantity ELSE 0 END) AS b, sum(CASE WHEN p_size > 34 THEN l_quantity ELSE 0 END) AS c FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
x AS (SELECT a / w AS a, b / w AS b, c / w AS c, o_totalprice / 1000 AS y FROM q JOIN orders ON o_orderkey = l_orderkey),
m AS (SELECT count(*) AS n, sum(a * a) AS aa, sum(a * b) AS ab, sum(a * c) AS ac, sum(b * b) AS bb, sum(b * c) AS bc, sum(c * c) AS cc, sum(a * y) AS ay, sum(b * y) AS yb, sum(c * y) AS yc, sum(y) AS sy, sum(y * y) AS yy FROM x),
d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM m),
w AS (SELECT *, (ay * (bb * cc - bc * bc) - ab * (yb * cc - bc * yc) + ac * (yb * bc - bb * yc)) / det AS wa, (aa * (yb * cc - bc * yc) - ay * (ab * cc - bc * ac) + ac * (ab * yc - yb * ac)) / det AS wb, (aa * (bb * yc - yb * bc) - ab * (ab * yc - yb * ac) + ay * (ab * bc - bb * ac)) / det AS wc FROM d)
SELECT n, CAST(3 AS BIGINT) AS parts, round(1 - (yy - wa * ay - wb * yb - wc * yc) / (yy - sy * sy / n), 6) AS r2 FROM w""")
def composition_r2(t):
    """How much of a price the shares of three classes of parts explain."""
    from pyspark.sql import Window as W

    kind = F.when(F.col("p_size") <= 17, "a").when(F.col("p_size") <= 34, "b").otherwise("c").alias("class")
    parts = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).groupBy("l_orderkey", kind).agg(F.sum("l_quantity").alias("q"))
    shares = parts.withColumn("share", F.col("q") / F.sum("q").over(W.partitionBy("l_orderkey")))
    points = shares.join(t.orders.withColumn("y", F.col("o_totalprice") / 1000), F.col("o_orderkey") == F.col("l_orderkey"))
    return stats.share_r2(points, "l_orderkey", "class", "share", "y").select("n", "parts", r("r2", 6).alias("r2"))


@query("""WITH o AS (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS i, count(*) OVER () AS n FROM customer), p AS (SELECT DISTINCT CAST(round_even(k * (n - 1) / 39.0, 0) AS BIGINT) AS i FROM (SELECT DISTINCT n FROM o), range(0, 40) g(k)),
c AS (SELECT c_custkey, i AS place FROM o WHERE i IN (SELECT i FROM p)), f AS (SELECT c_custkey, i AS place FROM o WHERE i NOT IN (SELECT i FROM p) ORDER BY i LIMIT (SELECT 40 - count(*) FROM p)) SELECT * FROM c UNION ALL SELECT * FROM f""")
def stratified_sample(t):
    return stats.stratified_sample(t.customer, "c_acctbal", "c_custkey", 40).select("c_custkey", long("place").alias("place"))


@query("SELECT p_type AS formula, count(*) AS n, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS sources, round(max(p_retailprice) - min(p_retailprice), 4) AS spread FROM part GROUP BY 1 HAVING count(*) > 1 AND count(DISTINCT p_brand) > 1")
def duplicates_report(t):
    return stats.duplicates_report(t.part.withColumnRenamed("p_type", "formula"), "formula", "p_brand", "p_retailprice").select("formula", "n", F.array_join("sources", ",").alias("sources"), r("spread").alias("spread"))


# --- duplicates and orders -------------------------------------------------------------------------------------------


@query("SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1 AS survivor, count(*) OVER (PARTITION BY sha256(text)) AS group_size FROM documents")
def survivor_per_group(t):
    rows = t.documents.select("doc_id", F.sha2("text", 256).alias("h"))
    return dedup.survivors(rows, ["h"], [F.col("doc_id")]).select("doc_id", "survivor", "group_size")


def _doc_tokens(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", "n_chars", F.array_remove(F.split(F.lower("text"), r"[^a-z]+"), "").alias("t"))


def _doc_pairs(rows: DataFrame) -> DataFrame:
    return dedup.hashed_pairs(rows, "doc_id", "t", 0.8)  # firsts of dedup.collapsed()


PAIRS_SQL = """s AS (SELECT doc_id, lang, list_distinct(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda x: x <> '')) AS t FROM documents),
k AS (SELECT doc_id, lang, len(t) AS n, unnest(t) AS w FROM s),
j AS (SELECT a.doc_id AS id_a, b.doc_id AS id_b, a.n + b.n - count(*) AS u, count(*) AS c FROM k a JOIN k b ON a.lang = b.lang AND a.w = b.w AND a.doc_id < b.doc_id AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) GROUP BY a.doc_id, b.doc_id, a.n, b.n),
p AS (SELECT id_a, id_b, CAST(c AS BIGINT) AS n_common, round(c / CAST(u AS DOUBLE), 6) AS jaccard FROM j WHERE c >= 0.8 * u)"""


@query(f"""WITH {PAIRS_SQL}, o AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY lang, list_sort(t)) AS first, len(t) AS n FROM s)
SELECT p.* FROM p JOIN o a ON a.doc_id = id_a AND a.first = id_a JOIN o b ON b.doc_id = id_b AND b.first = id_b
UNION ALL SELECT first, doc_id, CAST(n AS BIGINT), 1.0 FROM o WHERE n > 0 AND doc_id <> first""")
def near_dup_pairs(t):
    """Of all documents: the pairs of different sets of tokens, by the least row of each, and the other rows of a set with that one."""
    firsts, copies = dedup.collapsed(_doc_tokens(t), ["lang"], "doc_id", "t")
    return dedup.star_pairs(_doc_pairs(firsts), copies).select("id_a", "id_b", "n_common", r("jaccard", 6).alias("jaccard"))


# the fold itself, row by row in id order, over the rows that have a smaller match
GREEDY_SQL = f"""WITH RECURSIVE {PAIRS_SQL}, m AS (SELECT id_b, list(id_a) AS others FROM p GROUP BY id_b), o AS (SELECT id_b, others, row_number() OVER (ORDER BY id_b) AS i FROM m),
g(i, dropped) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL SELECT o.i, CASE WHEN len(list_filter(o.others, lambda x: NOT list_contains(g.dropped, x))) > 0 THEN list_append(g.dropped, o.id_b) ELSE g.dropped END FROM g JOIN o ON o.i = g.i + 1),
d AS (SELECT unnest(dropped) AS id FROM (SELECT dropped FROM g ORDER BY i DESC LIMIT 1))
SELECT doc_id AS id, doc_id NOT IN (SELECT id FROM d) AS kept, CASE WHEN doc_id IN (SELECT id FROM d) THEN (SELECT min(id_a) FROM p WHERE id_b = doc_id AND id_a NOT IN (SELECT id FROM d)) END AS duplicate_of FROM documents"""


@query(GREEDY_SQL)
def greedy_dedup(t):
    firsts, copies = dedup.collapsed(_doc_tokens(t), ["lang"], "doc_id", "t")
    return dedup.spread_groups(dedup.greedy_groups(_doc_pairs(firsts), firsts.select(F.col("doc_id").alias("id"))), copies)


@query("SELECT p_partkey, p_brand FROM part p WHERE NOT EXISTS (SELECT 1 FROM part q WHERE q.p_brand = p.p_brand AND q.p_retailprice <= p.p_retailprice AND q.p_size >= p.p_size AND (q.p_retailprice < p.p_retailprice OR q.p_size > p.p_size))")
def pareto_parts(t):
    return ranking.pareto_front(t.part, ["p_brand"], "p_retailprice", "p_size", parts=8).select("p_partkey", "p_brand")


@query("""WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus = 'P' DESC, o_totalprice NULLS LAST, o_orderkey) AS place, count(*) FILTER (o_orderstatus = 'P') OVER () AS st FROM orders) SELECT o_orderkey, CAST(place AS INTEGER) AS place FROM o WHERE place <= greatest(st, 500)""")
def rank_and_cap(t):
    return ranking.queue(t.orders, F.col("o_orderstatus") == "P", "o_totalprice", "o_orderkey", 500).select("o_orderkey", "place")


@query("""SELECT event_id, CASE WHEN event_type = 'purchase' THEN round(value, 4) END AS dft, CASE WHEN event_type = 'click' THEN round(value, 4) END AS mlip, CAST(row_number() OVER (ORDER BY CASE event_type WHEN 'purchase' THEN CASE WHEN value IS NULL THEN 2 ELSE 0 END WHEN 'click' THEN CASE WHEN value IS NULL THEN 2 ELSE 1 END ELSE 2 END, CASE WHEN event_type IN ('purchase', 'click') THEN value END NULLS LAST, event_id) AS INTEGER) AS place,
round(value / 50 * 11.654064, 4) AS tesla FROM events QUALIFY place <= 200""")
def candidate_report(t):
    from pyspark.sql import Window as W

    rows = t.events.withColumns({"dft": F.when(F.col("event_type") == "purchase", F.col("value")), "mlip": F.when(F.col("event_type") == "click", F.col("value"))})
    first = rows.orderBy(*ranking.candidate_order("dft", "mlip", "event_id")).limit(200)  # a report of the first 200
    first = first.withColumn("place", F.row_number().over(W.orderBy(*ranking.candidate_order("dft", "mlip", "event_id"))))
    m = fv.magnetisation(F.col("value"), F.lit(50.0))
    return first.select("event_id", r("dft").alias("dft"), r("mlip").alias("mlip"), "place", r(m["mu0_m_tesla"]).alias("tesla"))


@query("""WITH l AS (SELECT event_id, abs(value - lag(value) OVER w) AS de, abs(length(props) - lag(length(props)) OVER w) AS dm FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT event_id, round(de, 4) AS d_energy, CASE WHEN de IS NULL OR de <= 50 THEN 'ok' WHEN dm > 0 THEN 'moment_changed' ELSE 'energy_only' END AS verdict FROM l""")
def step_consistency(t):
    out = ranking.step_consistency(t.events.withColumn("m", F.length("props")), "user_id", "event_id", "value", "m", 50.0, 0.0)
    return out.select("event_id", r("d_energy").alias("d_energy"), "verdict")


@query("SELECT user_id, count(*) AS n, round(max(value) - min(value), 4) AS swing FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn <= 10 GROUP BY 1")
def tail_swing(t):
    return ranking.tail_swing(t.events, "user_id", "event_id", "value").select("user_id", "n", r("swing").alias("swing"))


@query("SELECT o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) - 1) / 500) AS BIGINT) AS chunk FROM orders")
def claim_chunks(t):
    return ranking.claims(t.orders, [F.desc("o_totalprice"), F.col("o_orderkey")], 500, ["o_orderstatus"]).select("o_orderkey", long("chunk").alias("chunk"))


# --- enumeration, splits, scalar rules -------------------------------------------------------------------------------


@query("""WITH s AS (SELECT s_suppkey, 2 + s_suppkey % 2 AS k, 6 + s_suppkey % 5 AS most FROM supplier)
SELECT s_suppkey, a AS n1, b AS n2, CASE WHEN k = 3 THEN c END AS n3 FROM s, range(1, 11) t(a), range(1, 11) u(b), range(1, 11) v(c) WHERE (k = 3 OR c = 1) AND a + b + CASE WHEN k = 3 THEN c ELSE 0 END <= most AND gcd(gcd(a, b), CASE WHEN k = 3 THEN c ELSE 0 END) = 1""")
def stoichiometry_enum(t):
    """Every supplier's number of elements and atoms."""
    rows = t.supplier.select("s_suppkey", (2 + F.col("s_suppkey") % 2).alias("k"), (6 + F.col("s_suppkey") % 5).alias("most"))
    return en.stoichiometries_of(rows, "k", "most", 3).select("s_suppkey", *(F.get("v", F.lit(i - 1)).cast("long").alias(f"n{i}") for i in (1, 2, 3)))


@query("""WITH x AS (SELECT a.p_partkey AS k, 1 + a.p_size % 4 AS zmax, 2 + a.p_size % 9 AS n FROM part a) SELECT k, CAST(z AS INTEGER) AS z, CAST(z * n AS BIGINT) AS cell_atoms FROM x, range(1, 5) g(z) WHERE z <= zmax AND z * n <= 24""")
def expand_z(t):
    rows = t.part.select(F.col("p_partkey").alias("k"), F.lit(1).alias("lo"), (1 + F.col("p_size") % 4).alias("hi"), (2 + F.col("p_size") % 9).alias("n_atoms"))
    return en.expand_z(rows, "lo", "hi", 24)[0].select("k", "z", long("cell_atoms").alias("cell_atoms"))


#: Elements that suppliers deal in.
_DEALT = ["Fe", "Co", "Ni", "Mn", "Ti", "B", "Si", "Al", "Sm", "Nd", "Y", "Ce"]


@query(f"""WITH s AS (SELECT s_suppkey AS k, 4 + s_suppkey % 3 AS most, {_DEALT} AS e FROM supplier WHERE s_suppkey % 7 <> 0),
g AS (SELECT k, most, e[k % 4 + 1] AS t1, e[(k + 1) % 4 + 1] AS t2, e[k % 4 + 5] AS x1, e[(k + 2) % 4 + 5] AS x2, e[k % 3 + 9] AS r1, e[(k + 1) % 3 + 9] AS r2 FROM s),
f AS (SELECT g.*, a.a, b.b, c.c, d.d, p.p, q.q, a + b + c + d + p + q AS n FROM g, range(0, 7) a(a), range(0, 7) b(b), range(0, 7) c(c), range(0, 7) d(d), range(0, 7) p(p), range(0, 7) q(q)
      WHERE a + b > 0 AND NOT (c > 0 AND d > 0) AND p + q > 0 AND a + b + c + d + p + q <= most AND NOT (p > 0 AND q > 0) AND gcd(gcd(gcd(a, b), gcd(c, d)), gcd(p, q)) = 1),
w AS (SELECT *, list_sort(list_filter([CASE WHEN a > 0 THEN t1 || a END, CASE WHEN b > 0 THEN t2 || b END, CASE WHEN c > 0 THEN x1 || c END, CASE WHEN d > 0 THEN x2 || d END, CASE WHEN p > 0 THEN r1 || p END, CASE WHEN q > 0 THEN r2 || q END], lambda z: z IS NOT NULL)) AS parts FROM f)
SELECT k AS space, array_to_string(parts, '') AS formula, CASE WHEN reason IS NULL THEN array_to_string(list_transform(parts, lambda z: regexp_replace(z, '[0-9]+', '')), '-') END AS chemsys, CASE WHEN reason IS NULL THEN CAST(n AS BIGINT) END AS n_atoms, reason
FROM (SELECT *, CASE WHEN CAST(p + q AS DOUBLE) / n > 0.5 + 1e-12 THEN 're above its share' WHEN CAST(a + b AS DOUBLE) / n < 0.5 - 1e-12 THEN 'tm below its share' WHEN CAST(a + b AS DOUBLE) / n > 0.75 + 1e-12 THEN 'tm above its share' END AS reason FROM w)
UNION ALL SELECT s_suppkey, 'refused', NULL, NULL, {_DEALT}[s_suppkey % 4 + 1] FROM supplier WHERE s_suppkey % 7 = 0""")
def chemical_space(t):
    """A space of three groups for every supplier; those of which two groups claim one element are refused."""
    k, e = F.col("s_suppkey"), F.array(*map(F.lit, _DEALT))
    at = lambda i: F.get(e, i.cast("int"))
    pair = lambda base, step, n: F.array(at(base + k % n), at(base + (k + step) % n))
    rows = t.supplier.select(k.alias("space"), (4 + k % 3).alias("most"), pair(F.lit(0), 1, 4).alias("tm"), pair(F.lit(8), 1, 3).alias("re"), F.when(k % 7 == 0, F.array(at(k % 4))).otherwise(pair(F.lit(4), 2, 4)).alias("x"))
    bounds = {"re": (1, 1, None, 0.5), "tm": (1, 2, 0.5, 0.75), "x": (0, 1, None, None)}
    one = lambda g, b: F.struct(F.lit(g).alias("grp"), F.col(g).alias("elements"), F.lit(b[0]).alias("least"), F.lit(b[1]).alias("most_of"), F.lit(b[2]).cast("double").alias("low"), F.lit(b[3]).cast("double").alias("high"))
    groups = rows.select("space", "most", F.explode(F.array(*(one(g, b) for g, b in bounds.items()))).alias("g")).select("space", "most", "g.*")
    kept, rejected, refused = en.chemical_spaces(groups, 4, 1)
    blank = lambda df, **more: df.select("space", more.get("formula", F.col("formula")).alias("formula"), F.lit(None).cast("string").alias("chemsys"), F.lit(None).cast("long").alias("n_atoms"), more.get("reason", F.col("reason") if "reason" in df.columns else None).alias("reason"))
    out = kept.select("space", "formula", "chemsys", "n_atoms", F.lit(None).cast("string").alias("reason"))
    return out.unionByName(blank(rejected)).unionByName(blank(refused.withColumn("reason", F.col("elements")), formula=F.lit("refused")))


@query("""WITH g AS (SELECT c_custkey, c_mktsegment, 1 + c_custkey % 17 AS w FROM customer), x AS (SELECT *, 2000 * CAST(w AS DOUBLE) / sum(w) OVER (PARTITION BY c_mktsegment) AS x FROM g), f AS (SELECT *, greatest(floor(x), 1) AS f FROM x),
d AS (SELECT *, 2000 - sum(f) OVER (PARTITION BY c_mktsegment) AS lft, row_number() OVER (PARTITION BY c_mktsegment ORDER BY x - floor(x) DESC, c_custkey) AS rn FROM f) SELECT c_custkey, CAST(f + CASE WHEN rn <= lft THEN 1 ELSE 0 END AS BIGINT) AS share FROM d""")
def split_total(t):
    rows = t.customer.select("c_custkey", "c_mktsegment", (1 + F.col("c_custkey") % 17).cast("double").alias("w"), F.lit(2000).cast("long").alias("total"))
    return en.split_total(rows, ["c_mktsegment"], "total", "w", "c_custkey").select("c_custkey", long("share").alias("share"))


@query("""WITH n AS (SELECT c_nationkey AS k, count(*) AS c FROM customer GROUP BY 1), b AS (SELECT k, c, CAST(ceil(c / 7.0) AS BIGINT) AS m FROM n) SELECT k, array_to_string(list_transform(range(0, m), lambda i: CAST(c // m + CASE WHEN i < c % m THEN 1 ELSE 0 END AS VARCHAR)), ',') AS parts FROM b""")
def split_batches(t):
    n = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("c"))
    return n.select("k", F.array_join(F.transform(fv.split_batches(F.col("c"), 7), lambda x: x.cast("string")), ",").alias("parts"))


@query("""WITH n AS (SELECT c_nationkey AS k, count(*) AS c FROM customer GROUP BY 1) SELECT k, array_to_string(list_transform(range(0, c, 25), lambda i: i || '-' || least(i + 24, c - 1)), ',') AS ranges FROM n""")
def chunk_array(t):
    n = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("c"))
    return n.select("k", F.array_join(F.transform(fv.chunks(F.col("c"), 25), lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("ranges"))


@query("""WITH s AS (SELECT p_partkey, 2 * (1 + p_size % 6) AS fe, 2 * (1 + p_partkey % 3) AS sm, 2 * (p_size % 2) AS ti FROM part), g AS (SELECT *, CASE WHEN ti = 0 THEN gcd(fe, sm) ELSE gcd(gcd(fe, sm), ti) END AS z FROM s)
SELECT p_partkey, 'Fe' || CAST(fe / z AS BIGINT) || 'Sm' || CAST(sm / z AS BIGINT) || CASE WHEN ti > 0 THEN 'Ti' || CAST(ti / z AS BIGINT) ELSE '' END AS formula, CAST(z AS BIGINT) AS z, CASE WHEN ti > 0 THEN 'Fe-Sm-Ti' ELSE 'Fe-Sm' END AS chemsys, CAST(fe + sm + ti AS BIGINT) AS n_atoms FROM g""")
def formula_canonical(t):
    n = lambda c: c.cast("string")
    text = F.concat(F.lit("Sm"), n(2 * (1 + F.col("p_partkey") % 3)), F.lit(" Fe-"), F.lit("Fe"), n(2 * (1 + F.col("p_size") % 6) - 1), F.when(F.col("p_size") % 2 == 1, F.lit("_Ti2")).otherwise(""))
    parsed = t.part.select("p_partkey", fm.parse_flat(text).alias("counts"))
    return parsed.select("p_partkey", fm.identity(F.col("counts")).alias("i")).select("p_partkey", "i.formula", "i.z", "i.chemsys", "i.n_atoms")


@query("""WITH s AS (SELECT p_partkey, p_size, (1 + p_size % 3) * (1 + p_partkey % 4) AS fe, 1 + p_partkey % 4 AS co FROM part), g AS (SELECT *, gcd(gcd(fe, co), 1) AS z, '(Fe' || (1 + p_size % 3) || 'Co)' || co || 'Sm(' AS bad FROM s)
SELECT p_partkey, CASE WHEN p_size % 10 > 0 THEN 'Co' || CAST(co / z AS BIGINT) || 'Fe' || CAST(fe / z AS BIGINT) || 'Sm1' END AS formula, CASE WHEN p_size % 10 = 0 THEN 'unclosed ' || chr(39) || '(' || chr(39) || ' in ' || chr(39) || bad || chr(39) END AS error FROM g""")
def formula_nested(t):
    text = F.concat(F.lit("(Fe"), (1 + F.col("p_size") % 3).cast("string"), F.lit("Co)"), (1 + F.col("p_partkey") % 4).cast("string"), F.lit("Sm"), F.when(F.col("p_size") % 10 == 0, "(").otherwise(""))
    parsed = t.part.select("p_partkey", fm.parse_nested(text).alias("p")).select("p_partkey", "p.counts", "p.error")
    return parsed.select("p_partkey", F.when(F.col("error").isNull(), fm.canonical(fm.reduced(F.col("counts")))).alias("formula"), "error")


#: Core-hours at sizes, a made-up curve of 14 points.
COST = [(2, 1.0), (5, 1.5), (8, 2.1), (11, 2.7), (14, 3.3), (18, 4.2), (22, 5.0), (26, 6.1), (30, 7.0), (34, 8.2), (38, 9.1), (42, 10.4), (46, 11.9), (48, 12.6)]


@query(f"WITH c(n, v) AS (VALUES {', '.join(f'({n}, {v}::DOUBLE)' for n, v in COST)}), s AS (SELECT n, v, lead(n) OVER (ORDER BY n) AS n1, lead(v) OVER (ORDER BY n) AS v1 FROM c) SELECT p_partkey, round(CASE WHEN p_size < 2 THEN 1.0 * p_size / 2 WHEN p_size >= 48 THEN 12.6 * p_size / 48 ELSE (SELECT v + (v1 - v) * (p_size - n) / (n1 - n) FROM s WHERE p_size >= n AND p_size < n1) END, 6) AS cost FROM part")
def cost_interp(t):
    curve = t.spark.createDataFrame(COST, "p_size int, cost double")
    return ranges.interpolated(t.part.select("p_partkey", "p_size"), curve, [], "p_size", "cost").select("p_partkey", r("cost", 6).alias("cost"))


@query("SELECT p_partkey, CAST(greatest(ceil((4.0 + 0.25 * p_size * (1 + p_partkey % 2) + 1.5 * p_size * (1 + p_partkey % 2) * (p_partkey % 300) / 1000.0) / 8) * 8, 16) AS BIGINT) AS gb FROM part")
def memory_model(t):
    return t.part.select("p_partkey", fv.memory_gb(F.col("p_size"), 1 + F.col("p_partkey") % 2, F.col("p_partkey") % 300, 4.0, 0.25, 1.5).alias("gb"))


@query("SELECT o_orderkey, CAST((o_orderkey % 3) * 86400 + (o_custkey % 24) * 3600 + (o_orderkey % 60) * 60 + o_custkey % 60 AS DOUBLE) AS seconds, CAST((o_orderkey % 60) * 60 + o_custkey % 60 AS DOUBLE) AS short, CAST((1 + o_orderkey % 64) * 1024 AS DOUBLE) AS mb FROM orders")
def duration_parse(t):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    full = F.concat((o % 3).cast("string"), F.lit("-"), two(c % 24), F.lit(":"), two(o % 60), F.lit(":"), two(c % 60))
    short = F.concat(two(o % 60), F.lit(":"), two(c % 60))
    return t.orders.select("o_orderkey", fv.seconds(full).alias("seconds"), fv.seconds(short).alias("short"), fv.megabytes(F.concat((1 + o % 64).cast("string"), F.lit("G"))).alias("mb"))


@query("SELECT s_suppkey, array_to_string(list_concat(range(s_suppkey % 5, s_suppkey % 5 + 4), [20, 30, 32, 34]), ',') AS tasks FROM supplier")
def array_ranges(t):
    a = F.col("s_suppkey") % 5
    text = F.concat(F.lit("["), a.cast("string"), F.lit("-"), (a + 3).cast("string"), F.lit(",20,30-34:2%4]"))
    return t.supplier.select("s_suppkey", F.array_join(F.transform(fv.array_range(text), lambda x: x.cast("string")), ",").alias("tasks"))


@query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, nullif(regexp_extract(url, 'utm_source=([a-z]+)', 1), '') AS utm, list_extract(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), -1) AS last_link, right(html, 20) AS tail FROM pages")
def page_fields(t):
    return t.pages.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.nullif(F.regexp_extract("url", "utm_source=([a-z]+)", 1), F.lit("")).alias("utm"), fv.last_match(F.col("html"), 'href="([^"]*)"').alias("last_link"), fv.tail_bytes(F.col("html"), 20).alias("tail"))


@query("SELECT event_id, TRY_CAST(json_extract_string(CASE WHEN json_valid(props) THEN props END, '$.k') AS BIGINT) AS k FROM events")
def props_json(t):
    return t.events.select("event_id", fv.json_field(F.col("props"), "$.k", "long").alias("k"))


@query("SELECT o_custkey AS k, max(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS f, max(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END) AS o, max(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS p FROM (SELECT o_custkey, o_orderstatus, o_orderpriority, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1 GROUP BY 1")
def property_pivot(t):
    rows = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("name"), F.col("o_orderpriority").alias("value"), "o_orderkey")
    empty = rows.limit(0)
    kept = sinks.upsert_last(empty, rows, ["k", "name"], "o_orderkey")
    return sinks.pivot_properties(kept, "k", ["F", "O", "P"]).select("k", F.col("F").alias("f"), F.col("O").alias("o"), F.col("P").alias("p"))


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS v FROM orders WHERE o_orderkey % 3 <> 0), n AS (SELECT o_orderkey AS k, 'N' AS s, o_totalprice + 1 AS v FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN n.s ELSE o.s END AS s, round(coalesce(n.v, o.v), 2) AS v, coalesce(n.s, o.s) AS last, coalesce(o.s, n.s) AS first FROM o FULL JOIN n ON o.k = n.k""")
def upsert_partial(t):
    old = t.orders.filter("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("v"))
    new = t.orders.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.lit("N").alias("s"), (F.col("o_totalprice") + 1).alias("v"))
    part = sinks.upsert_columns(old, new, ["k"], ["v"])
    last = sinks.upsert_last(old, new, ["k"]).select("k", F.col("s").alias("last"))
    first = sinks.insert_or_ignore(old, new, ["k"]).select("k", F.col("s").alias("first"))
    return part.join(last, "k").join(first, "k").select("k", "s", r("v", 2).alias("v"), "last", "first")


@query("SELECT l_orderkey, l_linenumber, floor((l_extendedprice - l_quantity) / nullif(l_quantity, 0) * 1000 + 0.5) / 1000 AS drift, CAST(CASE WHEN l_discount <= 0 + 1e-12 THEN 0 WHEN l_discount <= 0.06 + 1e-12 THEN 1 WHEN l_discount <= 0.2 + 1e-12 THEN 2 ELSE 3 END AS INTEGER) AS band, CASE WHEN l_linestatus = 'F' THEN '' ELSE 'step_limit' END AS exit_reason, round(l_quantity * 36 * 4 / 3600, 6) AS core_hours FROM lineitem")
def scalar_rules(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", (F.floor(fv.drift(F.col("l_quantity"), F.col("l_extendedprice")) * 1000 + 0.5) / 1000.0).alias("drift"), fv.band(F.col("l_discount")).alias("band"), fv.exit_reason(F.lit(None).cast("string"), F.col("l_linestatus") == "F").alias("exit_reason"), r(fv.core_hours(F.col("l_quantity") * 36, F.lit(4)), 6).alias("core_hours"))


@query("""WITH p AS (SELECT a.vec_id, a.label, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) * (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE))))) AS d FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id // 100 = b.vec_id // 100 AND a.vec_id <> b.vec_id)
SELECT vec_id, round(min(d), 5) AS nearest, min(d) >= 0.5 AS passed FROM p GROUP BY 1""")
def sites_min_distance(t):
    sites = t.embeddings.select("vec_id", "label", F.floor(F.col("vec_id") / 100).alias("cell"), F.col("embedding").cast("array<double>").alias("v"))
    other = sites.select(F.col("vec_id").alias("o"), "label", "cell", F.col("v").alias("w"))
    square = F.aggregate(F.zip_with("v", "w", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    # sites of one structure only: a cell of at most a hundred ids
    near = sites.join(other, ["label", "cell"]).filter("vec_id <> o").groupBy("vec_id").agg(F.sqrt(F.min(square)).alias("nearest"))
    return near.select("vec_id", r("nearest", 5).alias("nearest"), (F.col("nearest") >= 0.5).alias("passed"))


@query("SELECT conv_id, count(*) AS turns, arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY 1")
def conversation_history(t):
    return t.conversations.groupBy("conv_id").agg(F.count("*").alias("turns"), F.min_by("role", "turn").alias("first_role"), F.max_by("role", "turn").alias("last_role"), F.sum(F.length("text")).cast("long").alias("chars"))


# --- streams and reports ---------------------------------------------------------------------------------------------


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, round(arg_max(value, event_id), 4) AS value FROM events GROUP BY 1")
def events_cycle_stream(t):
    """The feed folded cycle by cycle; the SQL is its batch twin."""
    import uuid

    from funnelspark.sources.folders import shared_dir
    from funnelspark.streaming import cycle

    base = f"{shared_dir(t.spark)}/cycle-{uuid.uuid4().hex}"
    feed = cycle.feed_of(t.spark, f"{t.folder}/events.parquet")
    cycle.run_cycles(feed, f"{base}/state", f"{base}/checkpoint", "user_id", "event_id", ["event_type", "value"]).awaitTermination()
    return cycle.state_of(t.spark, f"{base}/state").select("user_id", "event_id", "event_type", r("value").alias("value"))


LADDER_SQL = "SELECT CAST(user_id AS VARCHAR) AS key, event_id AS seq, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'done' ELSE 'running' END AS state FROM events"


@query(f"""WITH e AS ({LADDER_SQL}), u AS (SELECT *, sum(CASE WHEN state = 'done' THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY seq) AS run FROM e),
a AS (SELECT *, CASE WHEN state = 'done' THEN 0 ELSE sum(CASE WHEN state = 'failed' THEN 1 ELSE 0 END) OVER (PARTITION BY key, run ORDER BY seq) END AS attempt FROM u)
SELECT key, seq, state, CAST(attempt AS INTEGER) AS attempt, CASE WHEN state = 'failed' THEN CASE WHEN attempt < 3 THEN 'retry' ELSE 'give_up' END WHEN state = 'done' THEN 'finish' END AS action FROM a""")
def retry_ladder(t):
    """The keyed state of the stream over all of the feed; the SQL is its batch twin."""
    import uuid

    from funnelspark.sources.folders import shared_dir
    from funnelspark.streaming import cycle

    base = f"{shared_dir(t.spark)}/ladder-{uuid.uuid4().hex}"
    state = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "done").otherwise("running")
    feed = cycle.feed_of(t.spark, f"{t.folder}/events.parquet").select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("seq"), state.alias("state"))
    out = cycle.retry_ladder(feed).writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").outputMode("append")
    out.trigger(availableNow=True).start(f"{base}/out").awaitTermination()
    return t.spark.read.parquet(f"{base}/out")


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS seen, CAST(sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS BIGINT) AS passed FROM events GROUP BY 1, 2")
def windowed_funnel(t):
    from funnelspark.streaming import cycle

    out = cycle.windowed_funnel(t.events.withColumn("ok", F.coalesce(F.col("value") > 100, F.lit(False))), "ts", "event_type", "ok")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "seen", "passed")


@query("SELECT 'structures:' || o_orderstatus AS name, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT 'jobs:' || l_linestatus, count(*) FROM lineitem GROUP BY 1 UNION ALL SELECT 'structures', count(*) FROM orders UNION ALL SELECT 'jobs', count(*) FROM lineitem")
def campaign_summary(t):
    from funnelspark.plans import report

    return report.summary(t.orders.withColumnRenamed("o_orderstatus", "state"), t.lineitem.withColumnRenamed("l_linestatus", "state"))


@query("SELECT source, seq FROM (SELECT 'orders' AS source, o_orderkey AS seq FROM orders WHERE o_custkey = 1 UNION ALL SELECT 'customer', c_custkey FROM customer WHERE c_custkey = 1)")
def life_history(t):
    from funnelspark.plans import report

    tables = {"orders": t.orders.withColumnsRenamed({"o_custkey": "id", "o_orderkey": "seq"}), "customer": t.customer.withColumn("id", F.col("c_custkey")).withColumnRenamed("c_custkey", "seq")}
    return report.history(tables, "id", 1, "seq").select("source", "seq")


# --- further scalar, conversion and guard rules ----------------------------------------------------------------------


@query("SELECT p_partkey, round(a, 5) AS a, round(b, 5) AS b, round(c, 5) AS c, round(degrees(acos(1 / b)), 4) AS gamma FROM (SELECT p_partkey, CAST(1 + p_size AS DOUBLE) AS a, sqrt(1 + CAST(p_size * p_size AS DOUBLE)) AS b, 2.0 AS c FROM part)")
def lattice_parameters(t):
    z = F.lit(0.0)
    size = F.col("p_size").cast("double")
    cell = F.array(F.array(1 + size, z, z), F.array(F.lit(1.0), size, z), F.array(z, z, F.lit(2.0)))
    out = t.part.select("p_partkey", fv.lattice_parameters(cell).alias("l"))
    return out.select("p_partkey", *(r(f"l.{c}", 5).alias(c) for c in "abc"), r("l.gamma", 4).alias("gamma"))


@query("SELECT p_partkey, CAST(ceil(p_size / 4.0) AS INTEGER) AS nx, CAST(list_min(list_transform(list_filter([1, 2, 4, 8, 16], lambda d: d <= 16), lambda d: ceil(p_size / CAST(d AS DOUBLE)) * 100 + d)) % 100 AS INTEGER) AS kpar FROM part")
def k_points(t):
    return t.part.select("p_partkey", F.element_at(fv.k_grid(F.array(F.col("p_size").cast("double")), 4.0), 1).alias("nx"), fv.k_parallel(F.col("p_size"), F.lit(16)).alias("kpar"))


@query("SELECT p_partkey, left(sha1(p_brand || '|' || p_size), 12) AS fingerprint, CAST(greatest(1, round_even(p_size * 0.25, 0)) AS BIGINT) AS target FROM part")
def fingerprints(t):
    return t.part.select("p_partkey", fv.fingerprint(F.col("p_brand"), F.col("p_size")).alias("fingerprint"), fm.target_count(F.col("p_size"), per_atom=F.lit(0.25)).alias("target"))


@query("SELECT p_size, p_type AS tag, min(p_brand) AS value FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_brand) = 1")
def expected_tags(t):
    return guards.expected_tags(t.part.select("p_size", F.col("p_type").alias("tag"), F.col("p_brand").alias("value")), "p_size", "tag", "value")


@query("SELECT l_orderkey AS k, count(DISTINCT l_suppkey) AS owners FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def id_collisions(t):
    return guards.id_elsewhere(t.lineitem.withColumnRenamed("l_orderkey", "k"), "k", ["l_suppkey"])


@query("SELECT p_brand, round(x0, 6) AS x0, round(e0, 6) AS e0 FROM (SELECT p_brand, x AS x0, e AS e0 FROM (WITH " + HULL_SQL.strip() + " SELECT a.sys AS p_brand, a.x, a.e FROM a LEFT JOIN h ON h.sys = a.sys AND h.x = a.x WHERE a.x IN (0, 1) OR (a.e - h.hull <= 1e-9 AND NOT EXISTS (SELECT 1 FROM a l JOIN a u ON u.sys = l.sys WHERE l.sys = a.sys AND l.x < a.x AND u.x > a.x AND l.e + (u.e - l.e) * (a.x - l.x) / (u.x - l.x) <= a.e + 1e-12))))")
def hull_vertices(t):
    return hull.binary_vertices(_part_entries(t).select("sys", "x", "e")).select(F.col("sys").alias("p_brand"), r("x", 6).alias("x0"), r("e", 6).alias("e0"))


@query("SELECT DISTINCT p_brand AS sys FROM part WHERE p_partkey % 13 = 0 AND p_size > 40")
def dirty_systems(t):
    rows = t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("sys"), F.lit("h").alias("ref_hash"))
    placed = t.part.filter("not (p_partkey % 13 = 0 and p_size > 40)").select(F.col("p_partkey").alias("id"), F.lit("h").alias("ref_hash"))
    return hull.dirty_systems(rows, placed)


@query("SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def grouped_names(t):
    return summaries.members(t.nation, "n_regionkey", "n_name")
