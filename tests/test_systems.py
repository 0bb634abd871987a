"""Facets of hulls, periodic cells, joins by order, hashes of large sets, spaces of formulas, against brute force."""

import bisect
import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelspark.operators import coverage, enumerate as en, facets, periodic, ranges

ENTRIES = "id long, sys string, fractions array<double>, e double"


def some_entries(k, n, seed, top=5):
    rng = np.random.default_rng(seed)
    ends = [(-1 - i, "s", [float(i == j) for j in range(k)], float(-0.1 * i)) for i in range(k)]
    mixed = [c for c in rng.integers(0, top, (n, k)) if (c > 0).sum() > 1]
    return ends + [(i, "s", [float(v) for v in c / c.sum()], float(-rng.random())) for i, c in enumerate(mixed)]


def lower_facets(entries, k):
    """All k entries with a plane through them that none lies below, of the least entries of each composition."""
    least = {}
    for i, _, x, e in entries:
        least[tuple(x)] = min(least.get(tuple(x), (np.inf, 0)), (e, i))
    x, e = np.array(list(least)), np.array([v[0] for v in least.values()])
    found = set()
    for some in itertools.combinations(range(len(x)), k):
        a = x[list(some)]
        if abs(np.linalg.det(a)) > 1e-9 and (e - x @ np.linalg.solve(a, e[list(some)])).min() > -1e-9:
            found.add(frozenset(tuple(p) for p in a.tolist()))
    return found


@pytest.mark.parametrize(("k", "n", "one_task"), [(2, 30, 100), (3, 40, 100), (3, 40, 8), (4, 25, 100), (4, 25, 9)])
def test_facets_are_the_planes_below_all(spark, k, n, one_task):
    rows = some_entries(k, n, k + n)
    found = facets.facets(spark.createDataFrame(rows, ENTRIES), k, one_task).collect()
    assert {frozenset(tuple(c.fractions) for c in r.corners) for r in found} == lower_facets(rows, k)
    assert len(found) == len({r.facet for r in found})
    for r in found:
        assert all(np.dot(c.fractions, r.prices) == pytest.approx(c.e) for c in r.corners)


def test_coplanar_entries_make_one_complex(spark):
    """A grid of entries in one plane below the end members, and one more on top of another: shares still mix to the row."""
    k, m = 3, 6
    rows = [(-1 - i, "s", [float(i == j) for j in range(k)], 0.0) for i in range(k)]
    grid = [c for c in itertools.product(range(1, m), repeat=2) if sum(c) < m]
    rows += [(i, "s", [a / m, b / m, (m - a - b) / m], -1.0) for i, (a, b) in enumerate(grid)] + [(99, "s", [1 / 6, 1 / 6, 4 / 6], -1.0)]
    df = spark.createDataFrame(rows, ENTRIES)
    complexes = facets.facets(df, k)
    areas = [abs(np.linalg.det(np.array([c.fractions for c in r.corners]))) for r in complexes.collect()]
    assert sum(areas) == pytest.approx(1.0)  # the simplex is covered once
    for r in facets.placed(df, complexes, k).filter("id >= 0").collect():
        assert r.e_above_hull == pytest.approx(0, abs=1e-9) and r.stable


def test_decomposition_mixes_to_the_entry(spark):
    rows = some_entries(3, 60, 5)
    by_id = {i: (np.array(x), e) for i, _, x, e in rows}
    for r in facets.place(spark.createDataFrame(rows, ENTRIES), 3).collect():
        x, e = by_id[r.id]
        assert sum(d.amount for d in r.decomposition) == pytest.approx(1)
        assert np.allclose(sum(d.amount * by_id[d.id][0] for d in r.decomposition), x)
        assert e - sum(d.amount * by_id[d.id][1] for d in r.decomposition) == pytest.approx(r.e_above_hull, abs=1e-9)
        if r.stable:
            assert len(r.decomposition) == 1 and by_id[r.decomposition[0].id][1] == pytest.approx(e)


def test_edges_and_vertices(spark):
    rows = some_entries(3, 40, 8)
    complexes = facets.facets(spark.createDataFrame(rows, ENTRIES), 3)
    want = lower_facets(rows, 3)
    assert {(tuple(r.a.fractions), tuple(r.b.fractions)) for r in facets.edges(complexes).collect()} == {tuple(sorted(p)) for f in want for p in itertools.combinations(f, 2)}
    assert sorted(tuple(r.fractions) for r in facets.vertices(complexes).collect()) == sorted({p for f in want for p in f})


def test_a_candidate_by_itself(spark):
    rows = some_entries(3, 30, 2)
    candidates = [(500, "s", [0.5, 0.25, 0.25], -9.0), (501, "s", [0.5, 0.25, 0.25], -8.0), (502, "s", [0.4, 0.4, 0.2], 0.5), (503, "t", [0.4, 0.4, 0.2], 0.5)]
    got = {r.id: r for r in facets.place_alone(spark.createDataFrame(candidates, ENTRIES), spark.createDataFrame(rows, ENTRIES), 3).collect()}
    for i, _, x, e in candidates[:3]:
        rebuilt = {r.id: r for r in facets.place(spark.createDataFrame([*rows, (i, "s", x, e)], ENTRIES), 3).collect()}
        assert got[i].e_above_hull == pytest.approx(rebuilt[i].e_above_hull, abs=1e-9)
    assert got[500].below > got[501].below > 0 and got[502].below == 0 and got[503].e_above_hull is None


def test_reasons_for_no_hull(spark):
    base = [("ok", x, e, "raw", "") for _, _, x, e in some_entries(3, 5, 1)]
    rows = base + [("scales", x, e, s, "") for (_, x, e, _, _), s in zip(base, itertools.cycle(["raw", "corrected"]), strict=False)]
    rows += [("kinds", x, e, "raw", r) for (_, x, e, _, _), r in zip(base, itertools.cycle(["GGA", "GGA+U", " "]), strict=False)]
    rows += [("short", x, e, "raw", "") for _, x, e, _, _ in base if x != [0.0, 1.0, 0.0]] + [("short", [0.0, 1.0, 0.0], None, "raw", "")]
    entries = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, sys string, fractions array<double>, e double, scale string, run_type string")
    some = [(1, "ok", [0.2, 0.3, 0.5], 0.0), (2, "scales", [0.2, 0.3, 0.5], 0.0), (3, "kinds", [0.2, 0.3, 0.5], 0.0), (4, "short", [0.2, 0.3, 0.5], 0.0), (5, "ok", None, 0.0), (6, "ok", [0.2, 0.3, 0.5], None), (7, "none", [0.2, 0.3, 0.5], 0.0), (8, None, [0.2, 0.3, 0.5], 0.0)]
    got = {r.id: (r.absent, r.e_above_hull is not None) for r in facets.placed_with_reasons(spark.createDataFrame(some, ENTRIES), entries, 3).collect()}
    assert got == {1: (None, True), 2: ("several energy scales", False), 3: ("several functionals", False), 4: ("an end member is missing", False), 5: ("no composition", False), 6: ("no energy", False), 7: ("no reference entries", False), 8: ("no reference entries", False)}
    assert facets.facets(spark.createDataFrame([], ENTRIES), 3).count() == 0


def test_periodic_neighbours_against_all_images(spark):
    rng = random.Random(6)
    cells = [(0, [[3.0, 0.0, 0.0], [2.4, 2.0, 0.0], [-1.0, 1.5, 4.0]]), (1, [[9.0, 0.0, 0.0], [0.0, 8.0, 0.0], [0.0, 3.0, 7.0]]), (2, [[1.0, 0.0, 0.0], [2.0, 0.0, 0.0], [0.0, 0.0, 1.0]])]
    sites = [(c, i, f"k{i % 2}", [rng.uniform(-1.5, 1.5) for _ in range(3)]) for c in (0, 1, 2) for i in range(5)] + [(0, 7, "k0", None), (5, 1, "k0", [0.0, 0.0, 0.0]), (1, 8, "k1", [1.0 - 1e-17, 0.0, -1e-17])]
    df, lattices = spark.createDataFrame(sites, "cell long, site long, kind string, at array<double>"), spark.createDataFrame(cells, "cell long, lattice array<array<double>>")
    cutoff, want = 3.7, set()
    for c, lattice in cells[:2]:
        own = [(i, np.array(at)) for cell, i, _, at in sites if cell == c and at]
        for (i, x), (j, y) in itertools.product(own, own):
            for s in itertools.product(range(-8, 9), repeat=3):
                d = float(np.linalg.norm((y + s - x) @ np.array(lattice)))
                if d <= cutoff and (i != j or any(s)):
                    want.add((c, i, j, s, round(d, 9)))
    got = periodic.neighbours(df, lattices, cutoff).collect()
    assert len(got) == len(want) and {(r.cell, r.a, r.b, tuple(r.shift), round(r.distance, 9)) for r in got} == want
    near = {(r.cell, r.site): r.distance for r in periodic.nearest(df, lattices, cutoff).collect()}
    assert all(near[c, i] == pytest.approx(min(w[4] for w in want if w[:2] == (c, i))) for c, i in near)


def test_contact_faults(spark):
    cube = [[4.0, 0.0, 0.0], [0.0, 4.0, 0.0], [0.0, 0.0, 4.0]]
    sites = [("near", 1, "Fe", [0.02, 0.0, 0.0]), ("near", 2, "Fe", [0.9, 0.0, 0.0]), ("gate", 1, "Sm", [0.0, 0.0, 0.0]), ("gate", 2, "Sm", [0.8, 0.0, 0.0]), ("fine", 1, "Fe", [0.0, 0.0, 0.0]), ("fine", 2, "Fe", [0.5, 0.5, 0.5])]
    radii = spark.createDataFrame([("Fe", 0.7), ("Sm", 0.4)], "kind string, radius double")
    cells = spark.createDataFrame([(c, cube) for c in ("near", "gate", "fine")], "cell string, lattice array<array<double>>")
    got = {r.cell: r for r in periodic.contact_faults(spark.createDataFrame(sites, "cell string, site long, kind string, at array<double>"), cells, radii, ["Sm"]).collect()}
    assert got["near"].fault == "contact" and got["near"].worst == pytest.approx(0.12 * 4 / (0.8 * 1.4))
    assert got["gate"].fault == "gate" and got["gate"].close == pytest.approx(0.8) and got["gate"].close_kind == "Sm"
    assert got["fine"].fault is None and got["fine"].n_sites == 2


@pytest.mark.parametrize("parts", [1, 7])
def test_bracket_against_bisection(spark, parts):
    rng = random.Random(parts)
    rows = [(i, rng.choice(["hot"] * 8 + ["b", None, "none"]), rng.choice([None, 5, rng.randrange(60)])) for i in range(300)]
    breaks = [(g, at, f"{g}{at}") for g in ("hot", "b", None, "lone") for at in rng.sample(range(60), 7)] + [("hot", 5, "hot5 more"), ("hot", 5, "a hot5"), ("b", None, "x")]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, "id long, g string, at long").repartition(5)
        got = {r.id: (r.low and (r.low.at, r.low.name), r.high and (r.high.at, r.high.name)) for r in ranges.bracket(df, spark.createDataFrame(breaks, "g string, at long, name string"), ["g"], "at").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 3)
    for i, g, at in rows:
        known = sorted({a: min(n for h, b, n in breaks if h == g and b == a) for h, a, _ in breaks if h == g and a is not None}.items())
        k = bisect.bisect_right([a for a, _ in known], at) if at is not None else None
        assert got[i] == ((known[k - 1] if k else None, known[k] if k < len(known) else None) if at is not None else (None, None))


def test_interpolation_and_its_ends(spark):
    rows = spark.createDataFrame([(g, float(x)) for g in ("a", "one") for x in (1, 2, 3, 5, 8, 10)], "g string, x double")
    curve = spark.createDataFrame([("a", 2.0, 4.0), ("a", 5.0, 7.0), ("a", 8.0, 1.0), ("one", 5.0, 10.0)], "g string, x double, y double")
    found = {(r.g, r.x): r.y for r in ranges.interpolated(rows, curve, ["g"], "x", "y").collect()}
    assert [found["a", x] for x in (1, 2, 3, 5, 8, 10)] == pytest.approx([2, 4, 5, 7, 1, 1.25])
    assert [found["one", x] for x in (1, 5, 10)] == pytest.approx([2, 10, 20])
    cut = {(r.g, r.x): r.y for r in ranges.interpolated(rows, curve, ["g"], "x", "y", None).collect()}
    assert cut["a", 1] is None and cut["a", 10] is None and cut["a", 8] == 1 and cut["one", 5] == 10 and cut["one", 8] is None


@pytest.mark.parametrize("n", [1, 7, 8, 64, 65, 700])
def test_chunked_hash_for_any_dealing(spark, n):
    texts = {"g": [f"t{i}" for i in range(n)], None: ["x"]}
    rows = [(g, i, t) for g, ts in texts.items() for i, t in enumerate(ts)]

    def digest(level):
        while True:
            level = [hashlib.sha256(",".join(level[i : i + 8]).encode()).hexdigest() for i in range(0, len(level), 8)]
            if len(level) == 1:
                return level[0][:16]

    for parts in (1, 6):
        random.Random(parts).shuffle(rows)
        df = spark.createDataFrame(rows, "g string, i long, t string").repartition(parts)
        assert {r.g: (r.n, r.set_hash) for r in coverage.chunked_hash(df, ["g"], ["i"], F.col("t"), 8).collect()} == {g: (len(ts), digest(ts)) for g, ts in texts.items()}


def test_targets_of_multiples(spark):
    rows = spark.createDataFrame([("a", 3, 1, 4), ("b", 20, 1, 2), ("c", 50, 1, 1)], "k string, n_atoms int, lo int, hi int")
    each, rejected = en.z_targets(rows, "k", "lo", "hi", 24, per_atom=0.5)
    assert sorted((r.k, r.z, r.n_target) for r in each.collect()) == [("a", 1, 2), ("a", 2, 3), ("a", 3, 4), ("a", 4, 6), ("b", 1, 10)]
    assert sorted((r.k, r.z) for r in rejected.collect()) == [("b", 2), ("c", 1)]
    whole, _ = en.z_targets(rows, "k", "lo", "hi", 24, per_atom=0.5, scope="total")
    assert sorted((r.k, r.z, r.n_target) for r in whole.collect()) == [("a", 1, 2), ("a", 2, 1), ("a", 3, 1), ("a", 4, 2), ("b", 1, 10)]
    fixed, _ = en.z_targets(rows, "k", "lo", "hi", 24, fixed=2, scope="total")
    assert sum(r.n_target for r in fixed.filter("k = 'a'").collect()) == 4  # one for each multiple at least
    with pytest.raises(ValueError, match="scope"):
        en.z_targets(rows, "k", "lo", "hi", 24, scope="other")


def test_spaces_against_plain_loops(spark):
    groups = [("s", "re", ["Sm", "Nd"], 1, 1, None, 0.5, 5), ("s", "tm", ["Fe", "Co"], 1, 2, 0.5, None, 5), ("t", "x", ["Fe"], 0, 1, None, None, 3), ("t", "y", ["Fe", "B"], 0, 1, None, None, 3)]
    df = spark.createDataFrame(groups, "space string, grp string, elements array<string>, least int, most_of int, low double, high double, most int")
    kept, rejected, refused = en.chemical_spaces(df, 3)
    assert [(r.space, r.elements) for r in refused.collect()] == [("t", "Fe")]
    want, out = set(), {}
    for re_, fe, co, n in itertools.product(("Sm", "Nd"), range(6), range(6), range(1, 6)):
        counts = {re_: n, "Fe": fe, "Co": co}
        total = n + fe + co
        if 0 < fe + co and total <= 5 and np.gcd.reduce([n, fe, co]) == 1:
            name = "".join(f"{e}{c}" for e, c in sorted(counts.items()) if c)
            if n / total > 0.5 + 1e-12:
                out[name] = "re above its share"
            elif (fe + co) / total < 0.5 - 1e-12:
                out[name] = "tm below its share"
            else:
                want.add(name)
    assert {r.formula for r in kept.collect()} == want and {r.formula: r.reason for r in rejected.collect()} == out
