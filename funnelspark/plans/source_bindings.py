"""Readers, writers and guards bound to the test tables: what is written to the shared folder is read back, and SQL says what must come out."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.functions import formula as fm
from funnelspark.functions import records as rec
from funnelspark.functions import values as fv
from funnelspark.operators import coverage, gates, guards, jobs, ranking, stats, store, summaries
from funnelspark.plans.bindings import HULL_SQL, long, placed_parts, query, r
from funnelspark.sources import readers, sinks, trees
from funnelspark.sources.folders import shared_dir


def _folder(t, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


# --- tables and upserts ----------------------------------------------------------------------------------------------


@query("SELECT p_partkey, p_brand AS sys, p_size FROM part WHERE p_size = 7")
def store_scan(t):
    """A table made with a schema, written, opened with a checked schema, and read by a predicate and a projection."""
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("sys", T.StringType()), T.StructField("p_size", T.IntegerType())])
    path = _folder(t, "store")
    sinks.create(t.spark, path, schema)
    t.part.select("p_partkey", F.col("p_brand").alias("sys"), F.col("p_size").cast("int")).write.mode("append").parquet(path)
    return readers.open_table(t.spark, path, schema).filter("p_size = 7").orderBy("p_partkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 7")
def point_lookup(t):
    return readers.by_id(t.customer.select("c_custkey", "c_name"), "c_custkey", 7)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'b' WHEN o_orderkey % 2 = 0 THEN 'c' ELSE 'a' END AS tag, CASE WHEN o_orderkey % 3 = 0 THEN 'dropped' ELSE 'x' END AS other FROM orders")
def map_updates(t):
    """Key-values of structures merged with changes, one key deleted where the row says so."""
    old = t.orders.select("o_orderkey", F.create_map(F.lit("tag"), F.lit("a"), F.lit("x"), F.lit("x")).alias("kv"))
    changes = t.orders.filter("o_orderkey % 2 = 0 or o_orderkey % 5 = 0").select("o_orderkey", F.create_map(F.lit("tag"), F.when(F.col("o_orderkey") % 5 == 0, "b").otherwise("c")).alias("kv"))
    some, rest = old.filter("o_orderkey % 3 = 0"), old.filter("o_orderkey % 3 <> 0")
    out = sinks.update_map(some, "kv", changes, "o_orderkey", ["x"]).unionByName(sinks.update_map(rest, "kv", changes, "o_orderkey"))
    return out.select("o_orderkey", F.element_at("kv", "tag").alias("tag"), F.coalesce(F.try_element_at("kv", F.lit("x")), F.lit("dropped")).alias("other"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30)")
def deleted_rows(t):
    return sinks.delete(t.orders.select("o_orderkey"), t.lineitem.filter("l_quantity > 30").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("SELECT o_custkey AS k, max(o_orderkey) AS seq, arg_max(o_orderstatus, o_orderkey) AS state FROM orders GROUP BY o_custkey")
def replaced_table(t):
    """A table of newest rows swapped in twice: the second write replaces the first whole."""
    path = _folder(t, "swap")
    sinks.replace_table(t.orders.select(F.lit(-1).cast("long").alias("k"), F.lit(0).cast("long").alias("seq"), F.lit("").alias("state")).limit(1), path)
    sinks.replace_table(ranking.latest(t.orders.withColumn("k", F.col("o_custkey")), ["k"], "o_orderkey", ["o_orderkey", "o_orderstatus"]).select("k", F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("state")), path)
    return t.spark.read.parquet(path)


@query("SELECT p_partkey, 'p_size' AS name, CAST(p_size AS VARCHAR) AS value FROM part UNION ALL SELECT p_partkey, 'p_type', p_type FROM part WHERE p_size % 2 = 0")
def unpivoted_properties(t):
    rows = t.part.select("p_partkey", "p_size", F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("p_type"))
    return sinks.unpivot_properties(rows, "p_partkey", ["p_size", "p_type"], "candidates").select("p_partkey", "name", "value")


# --- files -----------------------------------------------------------------------------------------------------------


@query("SELECT 'Fe' || (1 + c_custkey % 9) || 'Co' AS formula, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END AS z_min, CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE 2 END AS z_max, CASE WHEN c_custkey % 2 = 0 THEN 80 ELSE 25 END AS n_structures, count(*) AS n FROM customer GROUP BY ALL")
def composition_list(t):
    path = _folder(t, "list")
    k = F.col("c_custkey")
    line = F.concat(F.lit(" Fe"), (1 + k % 9).cast("string"), F.lit("Co ,"), F.when(k % 3 == 0, "").otherwise("2"), F.lit(","), F.when(k % 3 == 0, "").otherwise(" 2"), F.lit(","), F.when(k % 2 == 0, "80").otherwise(""))
    head = t.customer.limit(1).select(F.explode(F.array(F.lit("# what is asked for"), F.lit("formula,z_min,z_max,n_structures"))).alias("value"))
    t.customer.select(line.alias("value")).unionByName(head).write.text(path)
    return readers.composition_list(t.spark, path, (1, 4), 25).groupBy("formula", "z_min", "z_max", "n_structures").agg(F.count("*").alias("n"))


@query("SELECT p_partkey AS mp_id, p_size % 3 > 0 AND p_size % 2 = 0 AS usable FROM part")
def store_index(t):
    path = _folder(t, "index")
    columns = [c.split()[0] for c in readers.INDEX.split(", ")]
    own = {"mp_id": F.col("p_partkey").cast("string"), "e_static_eV": F.when(F.col("p_size") % 3 > 0, F.lit("-1.5")), "relax_converged": F.when(F.col("p_size") % 2 == 0, "True").otherwise("False"), "static_state": F.lit("done"), "n_atoms": F.lit("4")}
    t.part.select(*(own.get(c, F.lit("")).alias(c) for c in columns)).write.option("header", True).csv(path)
    return readers.store_index(t.spark, path).select(long("mp_id").alias("mp_id"), "usable")


@query("SELECT p_brand AS chemsys, count(*) AS n, round(sum(-p_retailprice), 2) AS e FROM part GROUP BY p_brand")
def entry_cache(t):
    """Cached entries, one file a system, read twice: of an id in several files one row stays."""
    path = _folder(t, "cache")
    entry = F.struct(F.col("p_partkey").cast("string").alias("mp_id"), F.col("p_brand").alias("chemsys"), F.lit(2).cast("long").alias("n_atoms"), (-F.col("p_retailprice")).alias("e_raw_per_atom"), F.lit("GGA").alias("run_type"))
    files = t.part.groupBy(F.col("p_brand").alias("chemsys")).agg(F.collect_list(entry).alias("entries"))
    for name in ("one", "two"):
        files.withColumn("system", F.col("chemsys")).write.partitionBy("system").json(f"{path}/{name}")
    return readers.entry_cache(t.spark, f"{path}/*/*").groupBy("chemsys").agg(F.count("*").alias("n"), r(F.sum("e_raw_per_atom"), 2).alias("e"))


@query("SELECT n_name AS id, CASE WHEN n_nationkey % 2 = 0 THEN 'too far' ELSE 'excluded' END AS why FROM nation")
def ignore_list(t):
    path = _folder(t, "ignored")
    pairs = t.nation.select(F.struct("n_name", F.when(F.col("n_nationkey") % 2 == 0, F.create_map(F.lit("why"), F.lit("too far"))).otherwise(F.create_map(F.lit("at"), F.lit("x")))).alias("p"))
    pairs.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list("p")).alias("ignored"))).alias("value")).coalesce(1).write.text(path)
    return readers.id_list(t.spark, f"{path}/*.txt", "ignored")


@query("SELECT DISTINCT p_size, CASE WHEN p_size % 5 = 0 THEN 'no species line' WHEN p_size % 7 = 0 THEN 'partial or unknown species' END AS reason, CASE WHEN p_size % 5 > 0 AND p_size % 7 > 0 THEN CAST(2 + p_size % 3 AS BIGINT) ELSE 0 END AS n_atoms FROM part")
def structure_files(t):
    """A structure file of each size of part, read back with the reasons of those that are refused."""
    path = _folder(t, "poscar")
    n = 1 + F.col("p_size") % 3
    species = F.when(F.col("p_size") % 5 == 0, "1 2").when(F.col("p_size") % 7 == 0, "Fe0.5 Sm").otherwise("Fe Sm")
    atoms = F.array_join(F.array_repeat(F.lit("0.0 0.5 0.25"), (n + 1).cast("int")), "\n")
    text = F.concat_ws("\n", F.concat(F.lit("part "), F.col("p_size").cast("string")), F.lit("1.0"), F.lit("4 0 0"), F.lit("0 4 0"), F.lit("0 0 4"), species, F.concat(n.cast("string"), F.lit(" 1")), F.lit("Direct"), atoms)
    t.part.select("p_size").distinct().select("p_size", text.alias("value")).write.partitionBy("p_size").text(path)
    got = readers.structure_files(t.spark, path, "*.txt")
    return got.select(F.regexp_extract("path", r"p_size=(\d+)", 1).cast("int").alias("p_size"), "reason", F.greatest(F.coalesce(F.size("symbols"), F.lit(0)), F.lit(0)).cast("long").alias("n_atoms"))


@query("SELECT replace(lower(o_orderpriority[3:]), ' ', '_') AS state, count(*) AS n FROM orders GROUP BY 1")
def scheduler_text(t):
    path = _folder(t, "sacct")
    t.orders.select(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.concat(F.regexp_replace(F.substring("o_orderpriority", 3, 99), "[^A-Za-z]", "_"), F.lit(" by 7"))).alias("value")).write.text(path)
    got = readers.scheduler_text(t.spark, path, ["job", "state"])
    return got.groupBy("state").agg(F.count("*").alias("n"))


@query("SELECT o_custkey AS k, arg_max(o_orderkey, o_orderkey) AS v FROM orders WHERE o_custkey % 4 > 0 GROUP BY 1")
def keyed_csv(t):
    path = _folder(t, "seeds")
    rows = t.orders.select(F.when(F.col("o_custkey") % 4 > 0, F.col("o_custkey").cast("string")).otherwise(" ").alias("k"), F.col("o_orderkey").alias("v"))
    rows.orderBy("v").write.option("header", True).csv(path)  # parts in the order of their names
    return readers.keyed_csv(t.spark, path, "k").select(long("k").alias("k"), long("v").alias("v"))


@query("SELECT s_suppkey, CAST(1 + s_suppkey % 4 AS BIGINT) AS n_atoms, round(s_suppkey / 4.0, 6) AS x FROM supplier")
def extxyz_frames(t):
    path = _folder(t, "xyz")
    n = (1 + F.col("s_suppkey") % 4).cast("int")
    text = trees.extxyz_text(F.array_repeat(F.lit("Fe"), n), F.array_repeat(F.array(F.col("s_suppkey") / 4.0, F.lit(0.5), F.lit(0.0)), n), F.array(F.col("s_suppkey").cast("double"), F.lit(0.0)))
    t.supplier.select(text.alias("value")).write.option("lineSep", "\n").text(path)
    # Spark names its parts .txt; the reader takes .extxyz
    jvm, conf = t.spark._jvm, t.spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    for f in fs.listStatus(at):
        if f.getPath().getName().endswith(".txt"):
            fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(f.getPath().toString()[:-4] + ".extxyz"))
    got = trees.extxyz(t.spark, path)
    return got.select(long(F.element_at("cell", 1)).alias("s_suppkey"), long(F.size("symbols")).alias("n_atoms"), r(F.element_at(F.element_at("positions", 1), 1), 6).alias("x"))


@query("SELECT DISTINCT o_orderstatus AS owner, o_orderpriority[1:1] AS run FROM orders")
def run_tree(t):
    path = _folder(t, "tree")
    t.orders.select("o_orderkey", F.col("o_orderstatus").alias("owner"), F.left("o_orderpriority", F.lit(1)).alias("run")).write.partitionBy("owner", "run").parquet(path)
    tree = trees.run_tree(t.spark, path, r"owner=([^/]+)/run=([^/]+)/[^/]+\.parquet$", ["owner", "run"])
    return trees.discovered(tree, "owner", "run").filter("files > 0 and bytes > 0").select("owner", "run")


@query("SELECT s_suppkey AS id, s_acctbal AS energy, s_suppkey % 2 = 0 AS converged FROM supplier UNION ALL SELECT s_suppkey, s_acctbal, s_suppkey % 2 = 0 FROM supplier WHERE s_suppkey <= 10")
def results_and_archive(t):
    """Task results as JSON lines, appended twice to an archive of CSV parts."""
    results, kept = _folder(t, "results"), _folder(t, "archive")
    schema = "id long, energy double, converged boolean"
    trees.write_records(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("energy"), (F.col("s_suppkey") % 2 == 0).alias("converged")), results, ["id"])
    rows = trees.task_results(t.spark, results, schema)
    trees.append_archive(rows, kept)
    trees.append_archive(rows.filter("id <= 10"), kept)
    return trees.archive(t.spark, kept, schema)


@query("SELECT count(*) AS n, CAST(sum(p_size) AS BIGINT) AS atoms, CAST(count(DISTINCT p_brand) AS INTEGER) AS systems, CAST((SELECT sum(p_size) FROM part WHERE p_brand = (SELECT min(p_brand) FROM part)) AS BIGINT) AS first_atoms FROM part")
def family_index(t):
    out = trees.index_summary(t.part, "p_brand", {"atoms": F.col("p_size")})
    return out.select("n", "atoms", F.size("systems").alias("systems"), F.element_at(F.map_values("systems"), 1)["atoms"].alias("first_atoms"))


@query("SELECT p_brand AS chemsys FROM part WHERE p_size < 3 UNION SELECT p_brand FROM part WHERE p_size > 49")
def system_list(t):
    rows = t.part.withColumnRenamed("p_brand", "chemsys")
    return trees.system_list(rows.filter("p_size < 3"), rows.filter("p_size > 49"), rows)


@query("SELECT 'composition' AS kind, state, count(*) AS n FROM (SELECT p_brand, 'planned' AS state FROM part WHERE p_size % 5 > 0 AND p_size < 5 UNION ALL SELECT DISTINCT p_brand, 'generated' FROM part WHERE p_size % 5 = 0 AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_size % 5 > 0 AND p_size < 5)) GROUP BY state "
       "UNION ALL SELECT 'structure', CASE WHEN p_partkey % 2 = 0 THEN 'new' ELSE 'screened' END, count(*) FROM part WHERE p_size % 5 = 0 GROUP BY 2")
def plan_commit(t):
    plan = t.part.filter("p_size % 5 = 0 or p_size < 5").select(F.col("p_brand").alias("formula"), long("p_size").alias("n_target"), F.when(F.col("p_size") % 5 == 0, F.col("p_partkey")).alias("seed"))
    compositions, structures = trees.plan_rows(plan, F.col("seed") % 2 == 0)
    count = lambda df, kind: df.groupBy("state").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "state", "n")
    return count(compositions, "composition").unionByName(count(structures, "structure"))


@query("SELECT p_partkey FROM part WHERE p_size % 6 = 0")
def parsers_agree(t):
    """Formulas read by two parsers; those where the second was fed another count are named."""
    text = lambda n: F.concat(F.lit("Fe"), n.cast("string"), F.lit(" Co2"))
    size = F.col("p_size") + 1
    a = t.part.select("p_partkey", fm.parse_flat(text(size)).alias("counts"))
    b = t.part.select("p_partkey", fm.parse_nested(text(F.when(F.col("p_size") % 6 == 0, size + 1).otherwise(size)))["counts"].alias("counts"))
    return trees.parsers_agree(a, b, "p_partkey", "counts")


# --- guards ----------------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, CASE WHEN p_brand LIKE '%1' AND p_size > 25 THEN 'pair' WHEN p_size < 2 THEN 'band' WHEN p_size % 4 = 0 THEN 'counts' END AS fault FROM part WHERE (p_brand LIKE '%1' AND p_size > 25) OR p_size < 2 OR p_size % 4 = 0")
def record_guards(t):
    """Forbidden pairs of scale and type, energies outside their band, and sizes that aren't the sum of their counts."""
    scale, kind = F.when(F.col("p_brand").endswith("1"), "corrected").otherwise("raw"), F.when(F.col("p_size") > 25, "R2SCAN").otherwise("GGA")
    rows = t.part.select("p_partkey", scale.alias("scale"), kind.alias("thermo"), (-F.col("p_size") / 2.0).alias("epa"), long("p_size").alias("n_atoms"), F.create_map(F.lit("Fe"), long(F.col("p_size") - F.when(F.col("p_size") % 4 == 0, 1).otherwise(0))).alias("counts"))
    found = [guards.forbidden_pair(rows, "scale", "thermo", [("corrected", "R2SCAN")]).select("p_partkey", F.lit("1pair").alias("fault")), guards.outside(rows, "epa", -25.5, -1.0).select("p_partkey", F.lit("2band").alias("fault")), guards.count_mismatch(rows, "n_atoms", "counts").select("p_partkey", F.lit("3counts").alias("fault"))]
    every = found[0].unionByName(found[1]).unionByName(found[2])
    return every.groupBy("p_partkey").agg(F.min("fault").alias("f")).select("p_partkey", F.substring("f", 2, 99).alias("fault"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(t):
    return guards.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT p_type AS tag, CASE WHEN p_type NOT IN (SELECT min(p_type) FROM part) THEN 'unknown' ELSE 'differs' END AS kind, count(*) AS n FROM part WHERE p_type NOT IN (SELECT min(p_type) FROM part) OR p_size <> 7 GROUP BY ALL")
def recipe_differences(t):
    """Settings against a recipe that names one tag with the value 7.0: numbers are compared as numbers."""
    name = t.part.agg(F.min("p_type")).first()[0]
    rows = t.part.select(F.col("p_type").alias("tag"), F.col("p_size").cast("string").alias("value"))
    return store.tag_differences(rows, {name: "7.0"}, "tag", "value").groupBy("tag", "kind").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'missing' WHEN o_orderstatus = 'F' THEN 'done' ELSE 'failed' END AS status FROM orders WHERE o_orderkey % 7 > 0")
def record_status(t):
    rows = t.orders.select("o_orderkey")
    records = t.orders.filter("o_custkey % 3 > 0").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("converged"))
    return coverage.record_status(rows, records, t.orders.filter("o_orderkey % 7 = 0").select("o_orderkey"), "o_orderkey").select("o_orderkey", "status")


@query("SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49) THEN 'out_of_memory' ELSE o_orderstatus END AS state FROM orders")
def promoted_causes(t):
    steps = t.lineitem.select(F.concat_ws(".", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("step"), F.when(F.col("l_quantity") > 49, "out_of_memory").otherwise("completed").alias("state"))
    own = t.orders.select(F.col("o_orderkey").cast("string").alias("job"), F.col("o_orderstatus").alias("state"))
    return jobs.promote_causes(own, steps, "job", "state", "out_of_memory").select(long("job").alias("o_orderkey"), "state")


@query("SELECT l_orderkey, l_linestatus AS engine, arg_max(l_extendedprice, (l_linenumber, l_extendedprice)) AS energy FROM lineitem GROUP BY ALL")
def newest_relaxations(t):
    """The newest relaxation of each structure and engine; of the same number the one of most energy."""
    seq = t.lineitem.withColumn("seq", F.struct("l_linenumber", "l_extendedprice"))
    return ranking.latest(seq, ["l_orderkey", "l_linestatus"], "seq", ["l_extendedprice"]).select("l_orderkey", F.col("l_linestatus").alias("engine"), F.col("l_extendedprice").alias("energy"))


@query("SELECT l_orderkey, CAST(count(*) FILTER (l_partkey % 3 = 0) AS BIGINT) AS fe, count(*) AS n FROM lineitem GROUP BY 1")
def symbol_counts(t):
    element = F.element_at(F.array(*map(F.lit, ("Fe", "Co", "Sm"))), (F.col("l_partkey") % 3 + 1).cast("int"))
    by = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(element).alias("symbols"), F.count("*").alias("n"))
    return by.select("l_orderkey", F.coalesce(F.try_element_at(fm.counts_of(F.col("symbols")), F.lit("Fe")), F.lit(0).cast("long")).alias("fe"), "n")


@query("SELECT o_orderkey, CAST(o_orderkey % 200 AS INTEGER) AS code, CAST(o_custkey % 20 AS INTEGER) AS signal, 'run-' || o_orderkey AS slug FROM orders")
def exit_codes(t):
    text = F.concat((F.col("o_orderkey") % 200).cast("string"), F.lit(":"), (F.col("o_custkey") % 20).cast("string"))
    return t.orders.select("o_orderkey", fv.exit_code(text).alias("e"), fm.slug(F.concat(F.lit("/run  "), F.col("o_orderkey").cast("string"), F.lit("!"))).alias("slug")).select("o_orderkey", "e.code", "e.signal", "slug")


#: What an event says of its user's state.
_STATES = {"view": "screening", "click": "screened", "purchase": "selected", "error": "failed"}
_STATE_SQL = "CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _STATES.items()) + " ELSE 'running' END"


@query(f"SELECT event_id, a, b, (a = 'new' AND b = 'screening') OR (a = 'screening' AND b IN ('screened', 'failed')) OR (a = 'screened' AND b IN ('deduped', 'filtered_out', 'selected')) OR (a = 'selected' AND b = 'queued') OR (a = 'queued' AND b IN ('running', 'failed')) OR (a = 'running' AND b IN ('done', 'failed', 'queued')) AS ok "
       f"FROM (SELECT event_id, coalesce(lag({_STATE_SQL}) OVER (PARTITION BY user_id ORDER BY event_id), 'new') AS a, {_STATE_SQL} AS b FROM events)")
def state_changes(t):
    """Each event as a change of its user's state, and whether that change is allowed."""
    from pyspark.sql import Window as W

    from funnelspark.streaming import cycle

    state = F.lit("running")
    for kind, name in _STATES.items():
        state = F.when(F.col("event_type") == kind, name).otherwise(state)
    rows = t.events.select("event_id", "user_id", state.alias("b"))
    rows = rows.withColumn("a", F.coalesce(F.lag("b").over(W.partitionBy("user_id").orderBy("event_id")), F.lit("new")))
    return rows.select("event_id", "a", "b", cycle.allowed(F.col("a"), F.col("b")).alias("ok"))


# --- more of the store -----------------------------------------------------------------------------------------------


@query("SELECT coalesce(CASE WHEN p_size % 2 > 0 THEN 'not finished' WHEN p_retailprice < 940 THEN 'energy out of band' WHEN p_partkey % 10 = 0 THEN 'policy' END, 'adopted') AS outcome, count(*) AS n FROM part GROUP BY 1")
def adopted_phases(t):
    yes, no = store.adopted(t.part, [("not finished", F.col("p_size") % 2 == 0), ("energy out of band", F.col("p_retailprice") >= 940), ("policy", F.col("p_partkey") % 10 > 0)])
    return yes.select(F.lit("adopted").alias("outcome")).unionByName(no.select(F.col("reason").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 2 = 0 ELSE o_orderstatus = 'F' END AS passed FROM orders")
def prescreened(t):
    verdicts = t.orders.filter("o_orderkey % 3 = 0").select("o_orderkey", (F.col("o_custkey") % 2 == 0).alias("v"))
    return store.prescreened(t.orders.withColumn("stored", F.col("o_orderstatus") == "F"), verdicts, "o_orderkey", "v", "stored").select("o_orderkey", "passed")


@query("SELECT CASE WHEN p_size % 3 = 0 THEN 'skipped' WHEN p_size % 2 = 0 THEN 'done' ELSE 'failed' END AS status, count(*) AS n FROM part GROUP BY 1")
def exported_records(t):
    rows = t.part.withColumns({"present": F.col("p_size") % 3 > 0, "converged": F.col("p_size") % 2 == 0})
    return store.exported(rows, "converged", "present").groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT p_brand, count(*) AS n, round(avg(abs(p_retailprice / p_size - p_partkey / CAST(p_size AS DOUBLE))), 6) AS mae FROM part WHERE p_partkey % 4 > 0 GROUP BY 1")
def store_parity(t):
    """Parity of stored energies with another method's by system, per atom on both sides."""
    rows = t.part.withColumn("b", F.when(F.col("p_partkey") % 4 > 0, F.col("p_partkey").cast("double")))
    points = store.parity_points(rows, "p_retailprice", "b", "p_size")
    return stats.parity(points, ["p_brand"], "a_per_atom", "b_per_atom").select("p_brand", "n", r("mae", 6).alias("mae"))


@query("SELECT l_partkey, round(min(l_discount), 6) AS d, CASE WHEN min(l_discount) <= 0.03 THEN 'blocking' ELSE 'waivable' END AS kind FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size % 2 = 0) GROUP BY 1")
def missing_phases(t):
    have = t.part.filter("p_size % 2 = 0").select(F.col("p_partkey").alias("l_partkey"))
    return store.missing_phases(t.lineitem, have, "l_partkey", "l_discount", 0.03).select("l_partkey", r("l_discount", 6).alias("d"), "kind")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS shown, CASE WHEN o_orderkey % 2 = 0 THEN 'file' WHEN o_orderkey % 3 = 0 THEN 'store' END AS source FROM orders")
def structure_detail(t):
    first, second = (t.orders.filter(f"o_orderkey % {n} = 0").select("o_orderkey", F.col(c).alias("shown")) for n, c in ((2, "o_orderstatus"), (3, "o_orderpriority")))
    return store.detail(t.orders.select("o_orderkey"), "o_orderkey", [("file", first), ("store", second)], "shown")


@query("SELECT p_type, 'p_type: ' AS x, count(*) FILTER (p_size < 20) AS running, count(*) FILTER (p_size > 40) AS pending, CAST(coalesce(sum(CASE WHEN p_size < 20 THEN p_size END), 0) AS BIGINT) AS cores FROM part GROUP BY p_type HAVING count(*) FILTER (p_size < 20 OR p_size > 40) > 0")
def in_flight(t):
    rows = t.part.withColumn("state", F.when(F.col("p_size") < 20, "running").when(F.col("p_size") > 40, "pending").otherwise("done"))
    out = store.in_flight(rows, "p_type", "state", "p_size")
    return out.filter(F.startswith("text", F.col("p_type"))).select("p_type", F.lit("p_type: ").alias("x"), "running", "pending", "cores")


@query("SELECT count(*) AS done, CAST(20000 AS BIGINT) AS total, round(count(*) / ((max(epoch(date_trunc('second', o_orderdate))) - min(epoch(date_trunc('second', o_orderdate)))) / 3600), 6) AS rate, count(*) FILTER (o_orderstatus = 'F') AS converged, count(*) FILTER (o_orderstatus <> 'F') AS failed FROM orders")
def run_progress(t):
    rows = t.orders.withColumn("ok", F.col("o_orderstatus") == "F")
    return store.progress(rows, 20000, "o_orderdate", "o_orderdate", "ok").withColumn("rate", r("rate", 6))


@query("SELECT l_orderkey, round(max(greatest(abs(l_tax - 0.04), abs(l_discount - 0.05))), 6) AS fmax FROM lineitem l WHERE l_linenumber // 3 = (SELECT max(l_linenumber // 3) FROM lineitem m WHERE m.l_orderkey = l.l_orderkey) GROUP BY 1")
def last_forces(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.floor(F.col("l_linenumber") / 3).alias("block"), (F.col("l_tax") - 0.04).alias("fx"), (F.col("l_discount") - 0.05).alias("fy"))
    return store.last_block_force(lines, "l_orderkey", "l_linenumber", "block", ["fx", "fy"]).select("l_orderkey", r("fmax", 6).alias("fmax"))


@query("SELECT p_brand, 'shares an element' AS warning FROM part GROUP BY p_brand UNION ALL SELECT 'none', 'is empty'")
def space_warnings(t):
    groups = t.part.groupBy("p_brand").agg(F.collect_set("p_type").alias("el"))
    none = t.part.limit(1).select(F.lit("none").alias("p_brand"), F.array().cast("array<string>").alias("el"))
    return store.space_warnings(groups.unionByName(none), "p_brand", "el")


@query("""WITH e AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings)
SELECT a.vec_id, count(b.vec_id) AS n, count(*) FILTER (b.label <> a.label) AS others FROM e a LEFT JOIN e b ON a.vec_id <> b.vec_id AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= 0.05 * 0.05 GROUP BY 1""")
def neighbour_share(t):
    """Neighbours of every point within a distance and how many of them are of another kind: the purity of its surroundings."""
    return store.neighbours(t.embeddings, "label", "vec_id", "embedding", 0.05, 0.05)


@query(f"WITH {HULL_SQL}, b AS (SELECT sys, min(above) AS best FROM p WHERE p_size > 25 GROUP BY sys) SELECT p_partkey, round(above - best, 5) + 0.0 AS relative FROM p LEFT JOIN b USING (sys)")
def parent_relative(t):
    """How far an entry lies above its system's parent phase (here the best of the large ones); null without one."""
    rows = placed_parts(t).select("p_partkey", "sys", "p_size", "e_above_hull")
    out = summaries.relative_to(rows, "sys", "e_above_hull", F.col("p_size") > 25)
    return out.select("p_partkey", (r("relative", 5) + 0.0).alias("relative"))


@query("SELECT p_brand, count(*) AS n, round(min(p_retailprice / p_size), 6) AS least FROM part WHERE p_size % 3 = 0 GROUP BY p_brand")
def own_entries(t):
    """Entries that have an energy of their own, by system."""
    own = t.part.withColumn("energy", F.when(F.col("p_size") % 3 == 0, F.col("p_retailprice"))).filter("energy is not null")
    return own.groupBy("p_brand").agg(F.count("*").alias("n"), r(F.min(rec.per_atom(F.col("energy"), F.col("p_size"))), 6).alias("least"))


@query("SELECT p_partkey, round((p_retailprice - s_acctbal) / s_acctbal, 6) AS drift, abs((p_retailprice - s_acctbal) / s_acctbal) > 0.2 AS suspect FROM part JOIN supplier ON s_suppkey = p_partkey % 100 + 1")
def geometry_drift(t):
    d = fv.drift(F.col("s_acctbal"), F.col("p_retailprice"))
    rows = t.part.join(t.supplier, F.col("s_suppkey") == F.col("p_partkey") % 100 + 1)
    return rows.select("p_partkey", r(d, 6).alias("drift"), (F.abs(d) > 0.2).alias("suspect"))


@query("SELECT p_partkey, CASE WHEN p_size - 5 > 0 THEN 'failed' ELSE 'done' END AS state, CASE WHEN p_size - 5 > 0 THEN NULL ELSE CAST(p_size - 5 AS DOUBLE) END AS hull_energy FROM part")
def divergence_gate(t):
    """A positive energy an atom is a failure and enters no hull."""
    epa = (F.col("p_size") - 5).cast("double")
    gate = gates.at_most("divergence", "epa", 0.0)
    judged = gates.judge(t.part.withColumn("epa", epa), [gate])
    return judged.select("p_partkey", F.when(F.col("reason").isNull(), "done").otherwise("failed").alias("state"), F.when(F.col("reason").isNull(), F.col("epa")).alias("hull_energy"))


@query("SELECT o_orderkey, best, CASE WHEN best IS NOT NULL THEN row_number() OVER (ORDER BY best DESC NULLS LAST, o_orderkey) END AS rank FROM orders LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS best FROM lineitem WHERE l_quantity > 25 GROUP BY 1) ON l_orderkey = o_orderkey")
def linked_scores(t):
    files = t.lineitem.filter("l_quantity > 25").select(F.concat(F.lit("cand_"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"), F.lit(".cif")).alias("file"), F.col("l_extendedprice").alias("best"))
    return store.linked_scores(t.orders.select("o_orderkey"), files, "o_orderkey", "file", r"^cand_(\d+)_", "best").select("o_orderkey", "best", long("rank").alias("rank"))


@query(f"WITH {HULL_SQL} SELECT sys, CASE WHEN right(sys, 1) IN ('1', '2') THEN 'other energies, as some are missing' END AS note, count(*) AS n, count(*) FILTER (above <= 1e-9) AS n_stable FROM p GROUP BY sys")
def reference_stage(t):
    """Reference energies on file, newer ones upserted, one source a system, and the hull of what is left."""
    from funnelspark.operators import hull

    own = t.part.select("p_partkey", F.col("p_brand").alias("sys"), ((F.col("p_size") - 1) / F.lit(49.0)).alias("x"), (-F.col("p_retailprice") / 1000.0).alias("dft"))
    first = own.filter("p_partkey % 2 = 0").withColumn("dft", F.lit(9.0))
    known = sinks.upsert_last(first, own, ["p_partkey"])
    ends = own.select("sys").distinct().withColumn("x", F.explode(F.array(F.lit(0.0), F.lit(1.0)))).select(F.lit(None).cast("long").alias("p_partkey"), "sys", "x", F.lit(0.0).alias("dft"))
    both = known.unionByName(ends).withColumn("mlip", F.when(~F.right("sys", F.lit(1)).isin("1", "2") | (F.col("x") > 0), F.col("dft")))
    placed = hull.place_binary(store.energies_on_file(both, "mlip", "dft", "sys")).filter("p_partkey is not null")
    return placed.groupBy("sys", "note").agg(F.count("*").alias("n"), F.count_if("stable").alias("n_stable"))


@query("SELECT l_orderkey, arg_max(l_returnflag, (l_linenumber, l_returnflag)) AS state, max(l_linenumber) AS written FROM lineitem GROUP BY 1")
def rebuilt_store(t):
    """Artifacts of structures written as claims in JSON, read back, and the newest of each as a store anew."""
    path = _folder(t, "artifacts")
    trees.write_records(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"), path, ["l_orderkey"])
    rows = trees.task_results(t.spark, path, "l_orderkey long, l_linenumber int, l_returnflag string")
    rows = rows.withColumn("at", F.struct("l_linenumber", "l_returnflag"))
    return store.rebuilt(rows, "l_orderkey", "at").select("l_orderkey", F.col("l_returnflag").alias("state"), F.col("l_linenumber").alias("written"))


@query(f"WITH {HULL_SQL}, v AS (SELECT a.sys, a.x, a.e FROM a LEFT JOIN h ON h.sys = a.sys AND h.x = a.x WHERE a.x IN (0, 1) OR (a.e - h.hull <= 1e-9 AND NOT EXISTS (SELECT 1 FROM a l JOIN a u ON u.sys = l.sys WHERE l.sys = a.sys AND l.x < a.x AND u.x > a.x AND l.e + (u.e - l.e) * (a.x - l.x) / (u.x - l.x) <= a.e + 1e-12))), "
       "k AS (SELECT sys, x AS x0, lead(x) OVER (PARTITION BY sys ORDER BY x) AS x1, e AS e0, lead(e) OVER (PARTITION BY sys ORDER BY x) AS e1 FROM v) SELECT sys, round(x0, 6) AS x0, round(x1, 6) AS x1, round((e1 - e0) / (x1 - x0), 5) + 0.0 AS slope FROM k WHERE x1 IS NOT NULL")
def hull_panel(t):
    """The tie lines of every system, as a panel draws them."""
    from funnelspark.operators import hull
    from funnelspark.plans.bindings import _part_entries

    lines = hull.tie_lines(hull.binary_vertices(_part_entries(t).select("sys", "x", "e"))).filter("x1 is not null")
    return lines.select("sys", r("x0", 6).alias("x0"), r("x1", 6).alias("x1"), (r((F.col("e1") - F.col("e0")) / (F.col("x1") - F.col("x0")), 5) + 0.0).alias("slope"))
