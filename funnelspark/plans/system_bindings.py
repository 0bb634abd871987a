"""Hulls of three components by facets: panels, decompositions, placements with reasons, on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.operators import facets
from funnelspark.plans.bindings import TERNARY, query, r, ternary_entries

#: Facets: three entries with a plane through them that none lies below; and what they make of every composition.
FACETS = f"""{TERNARY},
fc AS (SELECT t.*, row_number() OVER () AS fid FROM t WHERE abs(det) > 1e-9),
ok AS (SELECT fid FROM (SELECT fc.*, v.e, ((qy - sy) * (v.x - sx) + (sx - qx) * (v.y - sy)) / det AS m1, ((sy - py) * (v.x - sx) + (px - sx) * (v.y - sy)) / det AS m2 FROM fc JOIN v ON v.sys = fc.sys)
       GROUP BY fid HAVING min(e - (m1 * pe + m2 * qe + (1 - m1 - m2) * se)) >= -1e-9),
fac AS (SELECT fc.* FROM fc JOIN ok USING (fid)),
mix AS (SELECT d.sys, d.x, d.y, fac.*, ((qy - sy) * (d.x - sx) + (sx - qx) * (d.y - sy)) / det AS l1, ((sy - py) * (d.x - sx) + (px - sx) * (d.y - sy)) / det AS l2 FROM d JOIN fac ON fac.sys = d.sys),
best AS (SELECT * FROM mix WHERE l1 >= -1e-9 AND l2 >= -1e-9 AND l1 + l2 <= 1 + 1e-9 QUALIFY row_number() OVER (PARTITION BY sys, x, y ORDER BY fid) = 1),
share AS (SELECT sys, x, y, px AS cx, py AS cy, pe AS ce, l1 AS l FROM best UNION ALL SELECT sys, x, y, qx, qy, qe, l2 FROM best UNION ALL SELECT sys, x, y, sx, sy, se, 1 - l1 - l2 FROM best)
"""


def _near(c) -> F.Column:
    """Five digits, nudged off the ties that energies of seven digits often make."""
    return F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 5) + 0.0


def _xy(f) -> list[F.Column]:
    return [F.round(f[0], 4), F.round(f[1], 4)]


def _price(at: str) -> str:
    x, y = at.split(",")
    m1, m2 = f"((qy - sy) * ({x} - sx) + (sx - qx) * ({y} - sy)) / det", f"((sy - py) * ({x} - sx) + (px - sx) * ({y} - sy)) / det"
    return f"round({m1} * pe + {m2} * qe + (1 - {m1} - {m2}) * se, 4) + 0.0"


def _complexes(t) -> DataFrame:
    rows, ends = ternary_entries(t)
    return facets.facets(rows.unionByName(ends), 3)


@query(f"""WITH {FACETS} SELECT sys, round(px, 4) AS ax, round(py, 4) AS ay, round(qx, 4) AS bx, round(qy, 4) AS by_, round(sx, 4) AS cx, round(sy, 4) AS cy, {_price("1,0")} AS price_a, {_price("0,1")} AS price_b, {_price("0,0")} AS price_c FROM fac""")
def hull_facets_ternary(t):
    """Every facet by its corners, in order of composition, and the energies of the pure components on its plane."""
    c = F.array_sort(F.transform("corners", lambda c: c["fractions"]))
    rows = _complexes(t).select("sys", c.alias("c"), "prices")
    corners = [v.alias(n) for i, names in enumerate((("ax", "ay"), ("bx", "by_"), ("cx", "cy"))) for v, n in zip(_xy(F.col("c")[i]), names, strict=True)]
    return rows.select("sys", *corners, *((r(F.col("prices")[i], 4) + 0.0).alias(f"price_{n}") for i, n in enumerate("abc")))


@query(f"WITH {FACETS} SELECT DISTINCT sys, round(ax, 4) AS ax, round(ay, 4) AS ay, round(ae + 1e-9, 5) + 0.0 AS ae, round(bx, 4) AS bx, round(by_, 4) AS by_, round(be + 1e-9, 5) + 0.0 AS be FROM (SELECT sys, px AS ax, py AS ay, pe AS ae, qx AS bx, qy AS by_, qe AS be FROM fac UNION SELECT sys, px, py, pe, sx, sy, se FROM fac UNION SELECT sys, qx, qy, qe, sx, sy, se FROM fac)")
def hull_panel_ternary(t):
    """The tie lines of every system's panel, each once."""
    ends = [v.alias(f"{n}{m}") for n in "ab" for v, m in zip(_xy(F.col(n)["fractions"]), ("x", "y"), strict=True)]
    out = facets.edges(_complexes(t)).select("sys", *ends, _near("a.e").alias("ae"), _near("b.e").alias("be"))
    return out.withColumnRenamed("by", "by_").distinct()


@query(f"WITH {FACETS} SELECT DISTINCT sys, round(cx, 4) AS x, round(cy, 4) AS y, round(ce + 1e-9, 5) + 0.0 AS e FROM (SELECT sys, px AS cx, py AS cy, pe AS ce FROM fac UNION SELECT sys, qx, qy, qe FROM fac UNION SELECT sys, sx, sy, se FROM fac)")
def hull_vertices_ternary(t):
    x, y = _xy(F.col("fractions"))
    return facets.vertices(_complexes(t)).select("sys", x.alias("x"), y.alias("y"), _near("e").alias("e"))


@query(f"""WITH {FACETS}, one AS (SELECT sys, x, y, count(*) AS n, round(sum(l), 6) AS total, round(sum(l * ce) + 1e-9, 5) + 0.0 AS hull, string_agg(printf('%.3f', round(l + 1e-9, 3) + 0.0), ',' ORDER BY cx, cy) AS amounts FROM share WHERE l > 1e-9 GROUP BY sys, x, y)
SELECT id, n, total, hull, amounts FROM f JOIN one USING (sys, x, y)""")
def decomposition_ternary(t):
    """What every compound falls apart into on the hull of its system: how many phases, in what shares, at what energy."""
    rows, ends = ternary_entries(t)
    found = facets.placed(rows, facets.facets(rows.unionByName(ends), 3), 3)
    amounts = F.transform("decomposition", lambda d: d["amount"])
    total = F.aggregate(amounts, F.lit(0.0), lambda a, v: a + v)
    text = F.array_join(F.transform(amounts, lambda v: F.format_string("%.3f", F.round(v + 1e-9, 3) + 0.0)), ",")
    return found.select("id", F.size("decomposition").cast("long").alias("n"), r(total, 6).alias("total"), _near("hull").alias("hull"), text.alias("amounts"))


_ALONE = TERNARY.replace("SELECT sys, x, y, e FROM f UNION ALL", "SELECT sys, x, y, e FROM f WHERE id % 10 <> 2 UNION ALL")


@query(f"WITH {_ALONE} SELECT id, round(greatest(e - hull, 0) + 1e-9, 5) + 0.0 AS e_above_hull, round(greatest(hull - e, 0) + 1e-9, 5) + 0.0 AS below FROM f JOIN h USING (sys, x, y) WHERE id % 10 = 2")
def placed_alone_ternary(t):
    """Each candidate on the hull of the reference and itself, as if no other candidate were there."""
    rows, ends = ternary_entries(t)
    out = facets.place_alone(rows.filter("id % 10 = 2"), rows.filter("id % 10 <> 2").unionByName(ends), 3)
    return out.select("id", _near("e_above_hull").alias("e_above_hull"), _near("below").alias("below"))


_REFUSED = """k AS (SELECT sys, CASE WHEN sys % 5 = 0 AND count(DISTINCT id % 2) > 1 THEN 'several energy scales' WHEN sys % 4 = 1 AND count(DISTINCT id % 3) > 1 THEN 'several functionals' WHEN sys % 3 = 2 THEN 'an end member is missing' END AS absent FROM f GROUP BY sys)"""


@query(f"WITH {TERNARY}, {_REFUSED} SELECT id, CASE WHEN absent IS NULL THEN round(e - hull + 1e-9, 5) + 0.0 END AS e_above_hull, absent FROM f JOIN h USING (sys, x, y) JOIN k USING (sys)")
def hull_refusals_ternary(t):
    """Systems of several scales or functionals, or without an end member, aren't placed; every row says why."""
    rows, ends = ternary_entries(t)
    ends = ends.filter("sys % 3 <> 2 or id <> -2").withColumns({"scale": F.lit("0"), "run_type": F.lit("")})
    scale = F.when(F.col("sys") % 5 == 0, (F.col("id") % 2).cast("string")).otherwise("0")
    functional = F.when(F.col("sys") % 4 == 1, (F.col("id") % 3).cast("string")).otherwise(F.lit(" "))
    entries = rows.withColumns({"scale": scale, "run_type": functional}).unionByName(ends)
    out = facets.placed_with_reasons(rows, entries, 3)
    return out.select("id", _near("e_above_hull").alias("e_above_hull"), "absent")


@query(f"""WITH {FACETS}, nf AS (SELECT sys, count(*) AS facets FROM fac GROUP BY sys), nv AS (SELECT sys, count(*) AS vertices FROM (SELECT sys, px, py FROM fac UNION SELECT sys, qx, qy FROM fac UNION SELECT sys, sx, sy FROM fac) GROUP BY sys)
SELECT f.sys, count(*) + 3 AS entries, any_value(vertices) AS vertices, any_value(facets) AS facets, 4 - count(DISTINCT CASE WHEN x > 0 THEN 'x' ELSE '' END || CASE WHEN y > 0 THEN 'y' ELSE '' END || CASE WHEN 1 - x - y > 1e-9 THEN 'z' ELSE '' END) AS empty FROM f JOIN nf USING (sys) JOIN nv USING (sys) GROUP BY f.sys""")
def hull_audit_ternary(t):
    """What every hull stands on, and how many subsystems have no entry."""
    rows, ends = ternary_entries(t)
    entries = rows.unionByName(ends)
    out = facets.audit(entries, facets.facets(entries, 3), 3)
    return out.select("sys", "entries", "vertices", "facets", F.col("empty").cast("long").alias("empty"))


@query("""WITH m AS (SELECT p_brand AS sys, p_partkey % 11 = 0 AND p_size % 2 = 0 AS missing, p_size % 5 = 0 OR p_size / 100.0 <= 0.25 AS close FROM part)
SELECT sys, count(*) FILTER (missing AND close) AS blocking, count(*) FILTER (missing AND NOT close) AS waivable, CASE WHEN count(*) FILTER (missing AND close) > 0 THEN 'phases near the hull are missing' WHEN count(*) FILTER (missing) > 0 THEN 'phases are missing' END AS absent FROM m GROUP BY sys""")
def hull_coverage(t):
    """Which systems may have a hull, by the reference phases that are missing and how near they lie."""
    wanted = t.part.select(F.col("p_brand").alias("sys"), F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 5 > 0, F.col("p_size") / 100.0).alias("distance"))
    return facets.coverage_refusals(wanted, t.part.filter("not (p_partkey % 11 = 0 and p_size % 2 = 0)").select(F.col("p_partkey").alias("id")), 0.25)
