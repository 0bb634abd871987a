"""Trees of past work, claims, lives of entities, amended rows, written reports, on the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from funnelspark.functions import formula as fm, values as fv
from funnelspark.operators import claims, periodic, store
from funnelspark.plans import report
from funnelspark.plans.bindings import long, query, r
from funnelspark.plans.feed_bindings import _CELLS, _cells, _folder
from funnelspark.sources import campaign, sinks, trees
from funnelspark.sources.snapshots import Snapshots
from funnelspark.streaming import cycle, lifecycle

# --- trees of past work ----------------------------------------------------------------------------------------------


def _tree(t, name: str) -> str:
    """A folder a nation, supplier and step, with the log of that step: suppliers have one to three steps."""
    steps = F.explode(F.sequence(F.lit(1).cast("long"), 1 + F.col("s_suppkey") % 3)).alias("step")
    rows = t.supplier.select(F.col("s_nationkey").alias("formula"), F.col("s_suppkey").alias("structure"), "s_acctbal", steps)
    energy = F.concat(F.lit("energy = "), F.round(F.col("s_acctbal") - F.col("step") * 10, 2).cast("string"))
    ended = F.when(F.col("structure") % 5 > 0, "all done").otherwise("")
    met = F.when(F.col("structure") % 4 > 0, "accuracy reached").otherwise("")
    log = F.concat_ws("\n", F.lit("energy = 0.5"), energy, met, ended)
    folder = _folder(t, name)
    trees.write_tree(rows.select("formula", "structure", "step", log.alias("log")), folder, ["formula", "structure", "step"], "log")
    return folder


_PATTERN, _NAMES = r"formula=(\d+)/structure=(\d+)/step=(\d+)/[^/]+\.txt$", ["formula", "structure", "step"]
_RUNS = "u AS (SELECT s_suppkey AS structure, s_nationkey AS formula, 1 + s_suppkey % 3 AS steps, round(s_acctbal - (1 + s_suppkey % 3) * 10, 2) AS energy, s_suppkey % 5 > 0 AS ended, s_suppkey % 4 > 0 AS met FROM supplier)"


@query(f"WITH {_RUNS} SELECT structure, steps, energy, ended AND met AS converged, CASE WHEN NOT ended THEN 'cut_off' WHEN NOT met THEN 'last_step_only' END AS warning, structure % 2 = 0 AS attached, CASE WHEN structure % 2 = 0 THEN energy + 1 END AS model FROM u WHERE formula % 3 <> 1")
def campaign_runs(t):
    """The newest step of every run of the chosen formulas, what its log says, and another model's energy by id."""
    files = campaign.runs(t.spark, _tree(t, "runs"), _PATTERN, _NAMES, ["formula", "structure"], "step", F.col("formula").cast("int") % 3 != 1)
    rows = campaign.properties(files, {"energy": r"(?s).*energy = (-?[0-9.]+)"}, "all done", "accuracy reached").withColumn("structure", F.col("structure").cast("long"))
    model = t.supplier.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("structure"), r(F.col("s_acctbal") - (1 + F.col("s_suppkey") % 3) * 10 + 1, 2).alias("model"))
    out = campaign.attached(rows, model.unionByName(model.withColumn("model", F.col("model") + 5)), "structure", ["model"])
    return out.select("structure", long("steps").alias("steps"), r("energy", 2).alias("energy"), "converged", "warning", "attached", r("model", 2).alias("model"))


@query(f"WITH {_RUNS}, f AS (SELECT DISTINCT CAST(formula AS VARCHAR) AS formula FROM u ORDER BY 1 LIMIT 4) SELECT formula, count(*) AS n, CAST(sum(steps) AS BIGINT) AS steps FROM u WHERE CAST(formula AS VARCHAR) IN (SELECT formula FROM f) GROUP BY formula")
def first_formulas(t):
    """The first formulas of a tree only, by a limit on the listing."""
    files = campaign.runs(t.spark, _tree(t, "first"), _PATTERN, _NAMES, ["formula", "structure"], "step", limit=4)
    return files.groupBy(F.col("formula").cast("int").alias("formula")).agg(F.count("*").alias("n"), F.sum("steps").alias("steps"))


# --- claims, states, amendments --------------------------------------------------------------------------------------


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 4 <> 0 THEN 'a' WHEN o_orderkey % 2 <> 0 AND o_orderkey % 3 = 0 THEN 'b' ELSE 'c' END AS owner, NOT (o_orderkey % 2 = 0 AND o_orderkey % 4 <> 0) AND NOT (o_orderkey % 2 <> 0 AND o_orderkey % 3 = 0) AS granted FROM orders""")
def claimed_orders(t):
    """a takes the even ones, b of every third what is left; a gives some back; c asks for all and gets the rest."""
    own, ids = Snapshots(t.spark, _folder(t, "claims")), t.orders.select(F.col("o_orderkey").alias("id"))
    claims.claim(own, ids.filter("id % 2 = 0"), "a", "2024-01-01 00:00:00")
    claims.claim(own, ids.filter("id % 3 = 0"), "b", "2024-01-01 00:01:00")
    claims.release(own, ids.filter("id % 4 = 0"), "2024-01-01 00:02:00")
    got = claims.claim(own, ids, "c", "2024-01-01 00:03:00").withColumn("granted", F.lit(True))
    return claims.live(own).select("id", "owner").join(got, "id", "left").select("id", "owner", F.coalesce("granted", F.lit(False)).alias("granted"))


@query("SELECT o_orderkey, CASE WHEN ok THEN after ELSE before END AS state, CASE WHEN ok THEN CAST(o_custkey AS BIGINT) END AS produced, NOT ok AS refused FROM (SELECT *, (before = 'new' AND after = 'screening') OR (before = 'screening' AND after IN ('screened', 'failed')) OR (before = 'queued' AND after IN ('running', 'failed')) AS ok FROM "
       "(SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'O' THEN 'new' WHEN 'F' THEN 'screening' ELSE 'queued' END AS before, CASE o_orderkey % 3 WHEN 0 THEN 'screening' WHEN 1 THEN 'screened' ELSE 'failed' END AS after FROM orders))")
def moved_orders(t):
    """Changes of state with what was produced; those that the table of transitions doesn't have are refused."""
    status, third = F.col("o_orderstatus"), F.col("o_orderkey") % 3
    rows = t.orders.select("o_orderkey", F.when(status == "O", "new").when(status == "F", "screening").otherwise("queued").alias("state"), F.lit(None).cast("long").alias("produced"))
    changes = t.orders.select("o_orderkey", F.when(third == 0, "screening").when(third == 1, "screened").otherwise("failed").alias("state"), long("o_custkey").alias("produced"))
    now, refused = sinks.moved(rows, changes, "o_orderkey", "state", cycle.allowed, ["produced"])
    return now.join(refused.select("o_orderkey", F.lit(True).alias("refused")), "o_orderkey", "left").withColumn("refused", F.coalesce("refused", F.lit(False)))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'done' ELSE o_orderstatus END AS state, round(CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END, 2) AS hours FROM orders UNION ALL SELECT o_orderkey + 100000000, 'new', 0.0 FROM orders WHERE o_orderkey % 7 = 0")
def amended_jobs(t):
    """Jobs appended, and some changed in the columns that may change."""
    jobs = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("state"), F.col("o_totalprice").alias("hours"))
    changes = jobs.filter("o_orderkey % 5 = 0").select("o_orderkey", F.lit("done").alias("state"), F.when(F.col("o_orderkey") % 2 == 0, F.col("hours") + 1).alias("hours"))
    more = jobs.filter("o_orderkey % 7 = 0").select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), F.lit("new").alias("state"), F.lit(0.0).alias("hours"))
    return sinks.appended(sinks.amended(jobs, changes, "o_orderkey", ["state", "hours"]), more).select("o_orderkey", "state", r("hours", 2).alias("hours"))


# --- lives -----------------------------------------------------------------------------------------------------------

_LIFE = lifecycle.Rules({"new": {"view", "signup"}, "signup": {"view"}, "view": {"click", "error", "purchase"}, "click": {"purchase", "view", "error"}, "purchase": {"view"}, "error": {"view", "error"}}, {"error"}, {"purchase"})
_ALLOWED = ", ".join(f"'{a}>{b}'" for a, bs in _LIFE.transitions.items() for b in sorted(bs))


@query(f"""WITH RECURSIVE e AS (SELECT user_id, event_id, event_type AS after, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
l(user_id, i, event_id, before, after, ok, state, attempt, wait) AS (SELECT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN), 'new', 0, CAST(NULL AS DOUBLE) FROM (SELECT DISTINCT user_id FROM events)
  UNION ALL SELECT l.user_id, e.i, e.event_id, l.state, e.after, l.state || '>' || e.after IN ({_ALLOWED}), CASE WHEN l.state || '>' || e.after IN ({_ALLOWED}) THEN e.after ELSE l.state END,
    CASE WHEN l.state || '>' || e.after NOT IN ({_ALLOWED}) THEN l.attempt WHEN e.after = 'error' THEN l.attempt + 1 WHEN e.after = 'purchase' THEN 0 ELSE l.attempt END,
    CASE WHEN e.after = 'error' AND l.state || '>' || e.after IN ({_ALLOWED}) THEN least(5.0 * 2 ** l.attempt, 480.0) END FROM l JOIN e ON e.user_id = l.user_id AND e.i = l.i + 1)
SELECT CAST(user_id AS VARCHAR) AS key, event_id AS seq, before, after, CASE WHEN NOT ok THEN 'refused' WHEN after = 'error' THEN 'fault' ELSE 'changed' END AS kind, CAST(attempt AS INTEGER) AS attempt, wait AS wait_s FROM l WHERE i > 0""")
def user_lives(t):
    """Events as a stream in three batches, a state held for each user: changes taken or refused, faults counted, their waits."""
    rows = t.events.select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("seq"), F.col("event_type").alias("state"), F.col("ts").cast("timestamp").alias("ts"))
    feed, out, third = _folder(t, "events"), _folder(t, "lives"), ((t.events.agg(F.max("event_id")).first()[0] or 0) + 3) // 3
    for i in range(3):
        rows.filter((F.col("seq") >= i * third) & (F.col("seq") < (i + 1) * third)).coalesce(1).write.mode("append").parquet(feed)
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    done = lifecycle.lives(stream, _LIFE).writeStream.format("parquet").option("path", out).option("checkpointLocation", _folder(t, "checkpoint")).trigger(availableNow=True).start()
    done.awaitTermination()
    return t.spark.read.schema(lifecycle.OUT).parquet(out)


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS seen, CAST(count(*) FILTER (value > 20) AS BIGINT) AS passed FROM events GROUP BY 1, 2")
def streamed_funnel(t):
    """The windowed funnel as a stream of two batches, with the watermark as wide as the feed, so that every window is told at the end."""
    rows = t.events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", (F.col("value") > 20).alias("passed"), "event_id")
    feed, name = _folder(t, "funnel"), f"funnel_{uuid.uuid4().hex}"
    for i in range(2):
        rows.filter(F.col("event_id") % 2 == i).drop("event_id").coalesce(1).write.mode("append").parquet(feed)
    stream = t.spark.readStream.schema(rows.drop("event_id").schema).option("maxFilesPerTrigger", 1).parquet(feed)
    funnel = cycle.windowed_funnel(stream, "ts", "event_type", "passed", late="4000 days")
    funnel.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    return t.spark.table(name).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "seen", "passed")


# --- cells, pools, small rules ---------------------------------------------------------------------------------------


@query(f"WITH {_CELLS}, m AS (SELECT cell, a, min(dist) FILTER (kb <> 'K1') AS near FROM n WHERE ka = 'K1' GROUP BY cell, a) SELECT s.cell, count(*) FILTER (kind = 'K1') AS n, round(CASE WHEN count(*) FILTER (kind = 'K1') = 0 THEN 0 ELSE CAST(count(*) FILTER (kind = 'K1' AND coalesce(near, 99) > 1.2) AS DOUBLE) / count(*) FILTER (kind = 'K1') END, 6) AS share FROM s LEFT JOIN m ON m.cell = s.cell AND m.a = s.site GROUP BY s.cell")
def lonely_sites(t):
    """What part of a kind's sites has no other kind near, across the walls of the cells."""
    sites, cells = _cells(t)
    return periodic.region_share(sites, cells, "K1", 1.2).select("cell", "n", r("share", 6).alias("share"))


_POINTS = "p AS (SELECT DISTINCT l_suppkey % 10 AS sys, l_partkey AS label, p_brand AS e1, 'S' || p_size % 5 AS e2, CAST(p_size AS DOUBLE) / 7 AS err FROM lineitem JOIN part ON p_partkey = l_partkey)"


@query(f"WITH {_POINTS} SELECT 'system' AS kind, CAST(sys AS VARCHAR) AS name, count(*) AS n, round(avg(err), 6) AS mae, round(max(err), 6) AS worst FROM p GROUP BY sys UNION ALL SELECT 'element', e, count(*), round(avg(err), 6), round(max(err), 6) FROM (SELECT DISTINCT label, unnest([e1, e2]) AS e, err FROM p) GROUP BY e")
def pooled_parity(t):
    """Errors by system, and by element with a phase of several systems counted once."""
    points = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select((F.col("l_suppkey") % 10).alias("sys"), F.col("l_partkey").alias("label"), F.array("p_brand", F.concat(F.lit("S"), (F.col("p_size") % 5).cast("string"))).alias("elements"), F.col("p_retailprice").alias("a"), (F.col("p_retailprice") + F.col("p_size") / 7.0).alias("b")).distinct()
    whole, each = store.pooled_parity(points, "sys", "label", "elements", "a", "b")
    named = lambda df, kind, c: df.select(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("name"), "n", r("mae", 6).alias("mae"), r("worst", 6).alias("worst"))
    return named(whole, "system", "sys").unionByName(named(each, "element", "element"))


@query("""SELECT p_partkey, CASE WHEN p_size % 9 > 0 THEN CAST(ceil(greatest(floor(p_size * 7 / 2.0) + greatest(floor(p_partkey % 60 / 2.0), 10), floor(p_size * 7 * 0.6)) / 4.0) * 4 AS BIGINT) END AS bands,
CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS BIGINT) END AS submit, CAST(p_partkey AS BIGINT) AS jobs, CASE WHEN p_size % 3 > 0 THEN CAST(p_size * 8 AS BIGINT) END AS cpus, CASE WHEN p_size % 3 = 2 THEN CAST(p_size AS BIGINT) END AS gpus FROM part""")
def bands_and_limits(t):
    size, key = F.col("p_size"), F.col("p_partkey")
    tres = F.concat_ws(",", F.when(size % 3 > 0, F.concat(F.lit("cpu="), (size * 8).cast("string"))), F.when(size % 3 == 2, F.concat(F.lit("gres/gpu="), size.cast("string"))))
    line = F.concat(F.when(size % 2 == 0, size.cast("string")).otherwise(""), F.lit("|"), key.cast("string"), F.lit("|"), tres)
    return t.part.select("p_partkey", fv.n_bands(F.when(size % 9 > 0, size * 7).otherwise(0), key % 60).alias("bands"), fv.queue_limits(line).alias("l")).select("p_partkey", "bands", "l.*")


@query("""WITH s AS (SELECT p_partkey, list_sort(list_distinct(['Fe', ['O', 'F', 'N', 'B'][p_size % 4 + 1], ['Co', 'Mn', 'Al'][p_partkey % 3 + 1]])) AS e FROM part)
SELECT p_partkey, array_to_string(list_filter(e, lambda x: x IN ('O', 'N', 'F')), ',') AS anions, CASE WHEN list_contains(e, 'O') OR list_contains(e, 'F') THEN array_to_string(list_filter(e, lambda x: x IN ('Co', 'Fe', 'Mn')), ',') ELSE '' END AS u FROM s""")
def correction_risks(t):
    """Which elements of a system are corrected, and which only beside oxygen or fluorine."""
    pick = lambda names, n: F.get(F.array(*map(F.lit, names)), n.cast("int"))
    system = F.array_join(F.array_sort(F.array_distinct(F.array(F.lit("Fe"), pick(["O", "F", "N", "B"], F.col("p_size") % 4), pick(["Co", "Mn", "Al"], F.col("p_partkey") % 3)))), "-")
    risk = fm.correction_risk(system, ("O", "N", "F"), ("Co", "Fe", "Mn"))
    return t.part.select("p_partkey", F.array_join(risk["anions"], ",").alias("anions"), F.array_join(risk["u"], ",").alias("u"))


_STAGES = ["P", "O", "F"]


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'F') UNION ALL SELECT o_orderkey + 100000000, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def stages_since(t):
    """The rows of the stages from one on, and of one stage alone."""
    since, alone = store.stage_slice(_STAGES, since="O"), store.stage_slice(_STAGES, through="O", only=["P", "F"])
    out = t.orders.filter(F.col("o_orderstatus").isin(*since)).select("o_orderkey", "o_orderstatus")
    return out.unionByName(t.orders.filter(F.col("o_orderstatus").isin(*alone)).select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), "o_orderstatus"))


# --- written reports -------------------------------------------------------------------------------------------------


@query("""SELECT '# nation: where the customers are' AS line UNION ALL SELECT '# n: how many' UNION ALL SELECT 'nation,n' UNION ALL SELECT n_name || ',' || count(*) FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def written_csv(t):
    """A CSV with the meanings of its columns, written and read back line by line."""
    counts = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).groupBy(F.col("n_name").alias("nation")).agg(F.count("*").alias("n"))
    path = _folder(t, "csv")
    sinks.write_csv(counts, path, {"nation": "where the customers are", "n": "how many"})
    return t.spark.read.text(path).select(F.col("value").alias("line"))


@query("SELECT o_orderstatus AS name, count(*) AS n, 'orders' AS extra FROM orders GROUP BY o_orderstatus")
def written_status(t):
    """The status file, written and read back."""
    path = _folder(t, "status")
    sinks.status_json(t.orders.groupBy(F.col("o_orderstatus").alias("name")).agg(F.count("*").alias("n")), path, {"of": "orders"})
    rows = t.spark.read.schema("extra struct<of:string>, counts map<string,long>").json(path)
    return rows.select(F.explode("counts").alias("name", "n"), F.col("extra.of").alias("extra"))


@query("""SELECT 'Orders by state' AS heading, count(DISTINCT o_orderstatus) + 1 AS n_rows, CAST(0 AS BIGINT) AS n_cut FROM orders UNION ALL SELECT 'Nations', least(count(*), 10) + 1, CAST(1 AS BIGINT) FROM nation UNION ALL SELECT 'Regions & more', count(*) + 1, CAST(0 AS BIGINT) FROM region""")
def written_page(t):
    """A page of three tables, written as a file and read back: its headings and how many rows each shows."""
    page = report.Page("Round <1>").table("Orders by state", t.orders.groupBy("o_orderstatus").count()).table("Nations", t.nation.select("n_name"), 10).table("Regions & more", t.region.select("r_name"))
    path = _folder(t, "page")
    t.spark.createDataFrame([(page.render(),)], "value string").coalesce(1).write.text(path)
    text = t.spark.read.text(path, wholetext=True).select(F.explode(F.slice(F.split("value", "<h2>"), 2, 100)).alias("s"))
    heading = F.replace(F.split_part("s", F.lit("</h2>"), F.lit(1)), F.lit("&amp;"), F.lit("&"))
    return text.select(heading.alias("heading"), F.size(F.regexp_extract_all("s", F.lit("(<tr>)"))).cast("long").alias("n_rows"), F.size(F.regexp_extract_all("s", F.lit("(<p>First)"))).cast("long").alias("n_cut"))
