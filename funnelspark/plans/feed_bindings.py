"""Tables kept up to date, joins by order, periodic cells, hashes of large sets, on the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.operators import arrivals, coverage, enumerate as en, hull, incremental, periodic, ranges
from funnelspark.plans.bindings import GREEDY_SQL, HULL_SQL, _doc_tokens, _part_entries, long, query, r
from funnelspark.sources import inventory
from funnelspark.sources.folders import shared_dir
from funnelspark.sources.snapshots import Snapshots


def _folder(t, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


# --- kept up to date -------------------------------------------------------------------------------------------------


@query(f"WITH {HULL_SQL} SELECT p_partkey, round(above, 5) + 0.0 AS e_above_hull, above <= 1e-9 AS stable FROM p")
def incremental_hulls(t):
    """Entries come as a stream in three batches, some with an energy that is put right later; only the systems of a batch are placed anew."""
    ends = F.when(F.col("x") == 0, -1).otherwise(-2).cast("long")
    rows = _part_entries(t).select(F.coalesce("p_partkey", ends).alias("id"), "sys", F.lit(1).cast("long").alias("seq"), "x", "e")
    wrong = rows.filter("id >= 0 and id % 5 = 0").withColumns({"seq": F.lit(0).cast("long"), "e": F.col("e") - 3})
    feed = _folder(t, "feed")
    for batch in (rows.filter("id < 0").unionByName(rows.filter("id % 3 = 0 and id >= 0 and id % 5 > 0")).unionByName(wrong), rows.filter("id >= 0 and id % 3 = 1 and id % 5 > 0"), rows.filter("id >= 0 and (id % 3 = 2 or id % 5 = 0)")):
        batch.coalesce(1).write.mode("append").parquet(feed)
    store = Snapshots(t.spark, _folder(t, "hulls"))
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    incremental.keep_placed(stream, store, _folder(t, "checkpoint"), hull.place_binary).awaitTermination()
    return store.read("placements").filter("id >= 0").select(F.col("id").alias("p_partkey"), (r("e_above_hull", 5) + 0.0).alias("e_above_hull"), "stable")


@query(GREEDY_SQL)
def arriving_documents(t):
    """Documents arrive in three batches; each meets the index of what was kept before, and what it keeps goes into the index."""
    rows = _doc_tokens(t)
    store, third = Snapshots(t.spark, _folder(t, "pool")), ((t.documents.agg(F.max("doc_id")).first()[0] or 0) + 3) // 3
    for i in range(3):
        out = arrivals.absorb(store, rows.filter((F.col("doc_id") >= i * third) & (F.col("doc_id") < (i + 1) * third)), i, ["lang"], "doc_id", "t", 0.8)
    return out.select("id", "kept", "duplicate_of")


@query("""WITH a AS (SELECT o_custkey AS k, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
SELECT b.k, a.n AS n_pinned, b.n AS n_now, a.total AS total_pinned, b.total AS total_now FROM b LEFT JOIN a USING (k)""")
def two_tables_snapshot(t):
    """Two tables change together: a reader of the first version still sees both as they were, one of the newest both as they are."""
    store = Snapshots(t.spark, _folder(t, "store"))
    tables = lambda o: {"counts": o.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n")), "totals": o.groupBy(F.col("o_custkey").alias("k")).agg(r(F.sum("o_totalprice"), 2).alias("total"))}
    first = store.commit(tables(t.orders.filter("o_orderkey % 2 = 0")), batch=1)
    store.commit(tables(t.orders), batch=2)
    store.commit({"counts": t.orders.limit(0).select(F.col("o_custkey").alias("k"), F.lit(0).cast("long").alias("n"))}, batch=2)  # is in already
    at = lambda v, name: store.read("counts", v).join(store.read("totals", v), "k").select("k", F.col("n").alias(f"n_{name}"), F.col("total").alias(f"total_{name}"))
    return at(None, "now").join(at(first, "pinned"), "k", "left").select("k", "n_pinned", "n_now", "total_pinned", "total_now")


@query("""WITH c AS (SELECT c_nationkey AS k, c_custkey, round(c_acctbal, 2) AS bal FROM customer WHERE c_nationkey % 7 <> 3 AND (c_nationkey % 5 <> 0 OR c_acctbal > 0)), n AS (SELECT count(DISTINCT c_nationkey) AS n FROM customer WHERE c_nationkey % 5 = 0 AND c_acctbal > 0 AND c_nationkey % 7 <> 3)
SELECT k, c_custkey, bal, n.n AS n_read FROM c, n""")
def changed_files(t):
    """A file a nation, parsed once; after some were written again and some deleted only the former are read."""
    folder, spark = _folder(t, "tree"), t.spark
    rows = t.customer.select(F.col("c_nationkey").alias("nation"), F.concat_ws(",", "c_custkey", F.col("c_acctbal").cast("string")).alias("value"), "c_acctbal")
    rows.drop("c_acctbal").repartition(4, "nation").write.partitionBy("nation").text(folder)
    store = Snapshots(spark, _folder(t, "parsed"))

    def parse(files: DataFrame) -> DataFrame:
        lines = files.select("path", F.regexp_extract("path", r"nation=(\d+)", 1).cast("int").alias("k"), F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")).filter("line <> ''")
        return lines.select("path", "k", F.split_part("line", F.lit(","), F.lit(1)).cast("long").alias("c_custkey"), F.split_part("line", F.lit(","), F.lit(2)).cast("double").alias("bal"))

    inventory.scan(store, folder, parse, "*.txt")
    again = rows.filter("nation % 5 = 0 and c_acctbal > 0").drop("c_acctbal").repartition(4, "nation")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(conf)
    for k in range(25):  # nations
        if k % 5 == 0 or k % 7 == 3:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{folder}/nation={k}"), True)
    again.filter("nation % 7 <> 3").write.mode("append").partitionBy("nation").text(folder)
    counts = inventory.scan(store, folder, parse, "*.txt")
    return store.read("parsed").select("k", "c_custkey", r("bal", 2).alias("bal"), F.lit(counts["read"]).cast("long").alias("n_read"))


# --- joins by order --------------------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT * FROM events WHERE event_type <> 'purchase'), p AS (SELECT user_id, event_id AS e, value AS paid FROM events WHERE event_type = 'purchase')
SELECT c.event_id, (SELECT max(e) FROM p WHERE p.user_id = c.user_id AND p.e <= c.event_id) AS low, (SELECT min(e) FROM p WHERE p.user_id = c.user_id AND p.e > c.event_id) AS high,
       (SELECT round(arg_max(paid, e), 4) FROM p WHERE p.user_id = c.user_id AND p.e <= c.event_id) AS paid FROM c""")
def bracketing_purchases(t):
    """The purchases before and after every other event of a user."""
    rows = t.events.filter("event_type <> 'purchase'").select("event_id", "user_id", F.col("event_id").alias("at"))
    breaks = t.events.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("at"), F.col("value").alias("paid"))
    out = ranges.bracket(rows, breaks, ["user_id"], "at")
    return out.select("event_id", F.col("low.at").alias("low"), F.col("high.at").alias("high"), r("low.paid", 4).alias("paid"))


@query("""SELECT o_orderkey, (SELECT round(arg_max(c_acctbal, c_custkey), 2) FROM customer WHERE c_custkey <= o_custkey * 2 % 5000 AND c_custkey % 3 = 0) AS balance FROM orders""")
def as_of_balances(t):
    """One order of all rows, no groups: the last customer at or below a number."""
    rows = t.orders.select("o_orderkey", (F.col("o_custkey") * 2 % 5000).alias("at"))
    breaks = t.customer.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("at"), F.col("c_acctbal").alias("balance"))
    return ranges.as_of(rows, breaks, [], "at", ["balance"]).select("o_orderkey", r("balance", 2).alias("balance"))


# --- periodic cells --------------------------------------------------------------------------------------------------

_CELLS = """s AS (SELECT vec_id // 8 AS cell, vec_id AS site, 'K' || vec_id % 4 AS kind, CAST(embedding[1] AS DOUBLE) * 4 AS x, CAST(embedding[2] AS DOUBLE) * 4 AS y, CAST(embedding[3] AS DOUBLE) * 4 AS z FROM embeddings),
l AS (SELECT DISTINCT cell, 3.0 + cell % 4 AS ax, 0.7 * (cell % 3) AS bx, 4.0 + cell % 3 AS b_y, 0.5 * (cell % 2) - 0.8 AS cx, 0.3 * (cell % 5) AS cy, 5.0 - cell % 2 AS cz FROM s),
k AS (SELECT i.i, j.j, m.m FROM range(-3, 4) i(i), range(-3, 4) j(j), range(-3, 4) m(m)),
d AS (SELECT a.cell, a.site AS a, b.site AS b, a.kind AS ka, b.kind AS kb, b.x - floor(b.x) + k.i - (a.x - floor(a.x)) AS u, b.y - floor(b.y) + k.j - (a.y - floor(a.y)) AS v, b.z - floor(b.z) + k.m - (a.z - floor(a.z)) AS w
      FROM s a JOIN s b ON a.cell = b.cell, k WHERE a.site <> b.site OR k.i <> 0 OR k.j <> 0 OR k.m <> 0),
n AS (SELECT d.*, sqrt((u * ax + v * bx + w * cx) ** 2 + (v * b_y + w * cy) ** 2 + (w * cz) ** 2) AS dist FROM d JOIN l USING (cell))"""


def _cells(t) -> tuple[DataFrame, DataFrame]:
    e = F.col("embedding")
    sites = t.embeddings.select(F.floor(F.col("vec_id") / 8).alias("cell"), F.col("vec_id").alias("site"), F.concat(F.lit("K"), (F.col("vec_id") % 4).cast("string")).alias("kind"), F.transform(F.slice(e, 1, 3), lambda x: x.cast("double") * 4).alias("at"))
    c = F.col("cell")
    row = lambda *v: F.array(*(x.cast("double") for x in v))
    lattice = F.array(row(3.0 + c % 4, F.lit(0.0), F.lit(0.0)), row(F.lit(0.7) * (c % 3), 4.0 + c % 3, F.lit(0.0)), row(F.lit(0.5) * (c % 2) - 0.8, F.lit(0.3) * (c % 5), F.lit(5.0) - c % 2))
    return sites, sites.select("cell").distinct().withColumn("lattice", lattice)


@query(f"""WITH {_CELLS}, q AS (SELECT cell, min(dist / (0.8 * (0.3 + 0.1 * CAST(ka[2] AS INTEGER) + 0.3 + 0.1 * CAST(kb[2] AS INTEGER)))) AS worst, min(dist) FILTER (ka = kb AND ka IN ('K1', 'K3') AND dist < 1.6) AS close FROM n GROUP BY cell)
SELECT cell, round(CASE WHEN worst < 1 THEN worst END, 6) AS worst, round(close, 6) AS close, CASE WHEN worst < 1 THEN 'contact' WHEN close IS NOT NULL THEN 'gate' END AS fault FROM q""")
def contact_faults(t):
    """Cells in which two atoms, or an atom and an image, come too near for their radii, or two of a gated kind for that."""
    sites, cells = _cells(t)
    radii = t.spark.createDataFrame([(f"K{i}", 0.3 + 0.1 * i) for i in range(4)], "kind string, radius double")
    out = periodic.contact_faults(sites, cells, radii, ["K1", "K3"], same_kind=1.6, default_radius=0.1)
    return out.select("cell", r("worst", 6).alias("worst"), r("close", 6).alias("close"), "fault")


@query(f"WITH {_CELLS}, q AS (SELECT cell, a AS site, count(*) AS n, count(*) FILTER (ka = kb) AS same FROM n WHERE dist <= 3.1 GROUP BY 1, 2) SELECT s.cell, s.site, coalesce(n, 0) AS n, coalesce(same, 0) AS same FROM s LEFT JOIN q ON q.cell = s.cell AND q.site = s.site")
def periodic_neighbours(t):
    """Neighbours within a distance across the walls of skew cells, and how many are of the same kind."""
    sites, cells = _cells(t)
    return periodic.purity(sites, cells, 3.1).select("cell", "site", long("n").alias("n"), long("same").alias("same"))


# --- sets and shares -------------------------------------------------------------------------------------------------


@query("""WITH RECURSIVE t AS (SELECT l_returnflag AS g, l_orderkey || ':' || l_linenumber || ':' || CAST(round(l_extendedprice * 100) AS BIGINT) AS h, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_orderkey || ':' || l_linenumber || ':' || CAST(round(l_extendedprice * 100) AS BIGINT)) - 1 AS pos, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem),
u AS (SELECT g, pos // 100 AS pos, sha256(string_agg(h, ',' ORDER BY pos)) AS h, max((n + 99) // 100) AS n FROM t GROUP BY g, pos // 100
      UNION ALL SELECT g, pos // 100, sha256(string_agg(h, ',' ORDER BY pos)), max((n + 99) // 100) FROM u WHERE n > 1 GROUP BY g, pos // 100)
SELECT u.g AS l_returnflag, c.n, left(u.h, 16) AS set_hash FROM u JOIN (SELECT g, count(*) AS n FROM t GROUP BY g) c USING (g) WHERE u.n = 1""")
def large_set_hash(t):
    """A hash of each of three sets, of a third of all rows each, that no task holds whole."""
    text = F.concat_ws(":", "l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * 100).cast("long"))
    rows = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", text.alias("text"))
    return coverage.chunked_hash(rows, ["l_returnflag"], ["l_orderkey", "l_linenumber", "text"], F.col("text"), 100)


@query("""WITH p AS (SELECT p_partkey AS k, 2 + p_size % 9 AS n, 1 + p_size % 4 AS zmax FROM part), z AS (SELECT k, z, z * n AS atoms, greatest(round_even(1.5 * z * n, 0), 1) AS alone FROM p, range(1, 5) g(z) WHERE z <= zmax AND z * n <= 24),
b AS (SELECT *, greatest(max(alone) OVER (PARTITION BY k), count(*) OVER (PARTITION BY k)) AS budget, sum(alone) OVER (PARTITION BY k) AS w FROM z), x AS (SELECT *, budget * alone / w AS x, greatest(floor(budget * alone / w), 1) AS f FROM b),
y AS (SELECT *, budget - sum(f) OVER (PARTITION BY k) AS lft, row_number() OVER (PARTITION BY k ORDER BY x - floor(x) DESC, z) AS rn FROM x)
SELECT k, CAST(z AS INTEGER) AS z, CAST(alone AS BIGINT) AS per_z, CAST(f + CASE WHEN rn <= lft THEN 1 ELSE 0 END AS BIGINT) AS total FROM y""")
def z_targets(t):
    """How many cells are asked for at each multiple of a formula, one budget a row or one a formula."""
    rows = t.part.select(F.col("p_partkey").alias("k"), F.lit(1).alias("lo"), (1 + F.col("p_size") % 4).alias("hi"), (2 + F.col("p_size") % 9).alias("n_atoms"))
    each, _ = en.z_targets(rows, "k", "lo", "hi", 24, per_atom=1.5)
    whole, _ = en.z_targets(rows, "k", "lo", "hi", 24, per_atom=1.5, scope="total")
    return each.select("k", "z", F.col("n_target").alias("per_z")).join(whole.select("k", "z", long("n_target").alias("total")), ["k", "z"])


@query("""WITH p AS (SELECT o_custkey AS f, o_orderstatus AS s, CAST(sum(o_orderkey % 3) AS BIGINT) AS made FROM orders GROUP BY 1, 2), w AS (SELECT *, sum(made) OVER (PARTITION BY f) AS every FROM p)
SELECT f, s, made, CAST(CASE WHEN every > 0 THEN round_even(50.0::DOUBLE * made / every, 0) ELSE 0 END AS BIGINT) AS share FROM w""")
def produced_shares(t):
    """An ask of 50 a customer, dealt by what each state of orders has produced."""
    rows = t.orders.groupBy(F.col("o_custkey").alias("f"), F.col("o_orderstatus").alias("s")).agg(F.sum(F.col("o_orderkey") % 3).alias("made")).withColumn("ask", F.lit(50.0))
    return en.produced_shares(rows, "f", "ask", "made").select("f", "s", "made", "share")
