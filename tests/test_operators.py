import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelspark.operators import coverage, dedup, enumerate as en, facets, gates, guards, hull, jobs, ranking, stats
from funnelspark.plans import report
from funnelspark.sources import readers, sinks


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_hand_worked_binary_hull(spark):
    # Sm, Fe, Fe2Sm and Fe17Sm2 in energies per atom; x is the share of Sm
    entries = spark.createDataFrame([("s", 0.0, 0.0), ("s", 1.0, 0.0), ("s", 1 / 3, -0.5), ("s", 2 / 19, -6.0 / 19), ("s", 1 / 13, -3.0 / 13)], "sys string, x double, e double")
    placed = {round(r.x, 6): r for r in hull.place_binary(entries).collect()}
    assert placed[round(1 / 13, 6)].hull == pytest.approx(-0.2307692, abs=1e-3)
    assert placed[round(2 / 19, 6)].stable and placed[round(1 / 3, 6)].stable


@pytest.mark.parametrize("k", [3, 4])
def test_hull_is_least_mixture(spark, k):
    rng = np.random.default_rng(k)
    ends = [(i, "s", [float(i == j) for j in range(k)], 0.0) for i in range(k)]
    points = [(k + i, "s", [float(v) for v in c / c.sum()], float(-rng.random())) for i, c in enumerate(rng.integers(0, 4, (12, k))) if 1 < (c > 0).sum()]
    placed = {r.id: r for r in facets.place(spark.createDataFrame(ends + points, "id long, sys string, fractions array<double>, e double"), k).collect()}
    everything = ends + points
    for i, _, x, e in points:
        best = e
        for some in itertools.combinations(everything, k):  # all mixtures of k entries
            a = np.array([p[2] for p in some]).T
            if abs(np.linalg.det(a)) > 1e-9 and (share := np.linalg.solve(a, x)).min() >= -1e-9:
                best = min(best, float(share @ [p[3] for p in some]))
        assert placed[i].e_above_hull == pytest.approx(e - best, abs=1e-7)


def test_per_element_shift_leaves_the_hull(spark):
    rng = random.Random(1)
    base = [("s", x / 10, -rng.random() if 0 < x < 10 else 0.0) for x in range(11)]
    moved = [("s", x, e + 0.3 * x + 0.1 * (1 - x)) for _, x, e in base]
    above = lambda data: [round(r.e_above_hull, 9) for r in hull.place_binary(spark.createDataFrame(data, "sys string, x double, e double")).orderBy("x").collect()]
    assert above(base) == above(moved)


def test_guards(spark):
    df = spark.createDataFrame([("a", "raw", "GGA"), ("a", "corrected", ""), ("b", "raw", "GGA")], "g string, scale string, run string")
    assert rows(guards.one_value(df, ["g"], "scale").select("g")) == [("a",)]
    assert guards.one_value(df, ["g"], "run", blank_exempt=True).isEmpty()
    with pytest.raises(guards.Refused, match="energy scales"):
        guards.enforce(guards.one_value(df, ["g"], "scale"), "several energy scales")
    guards.enforce(guards.one_value(df.filter("g = 'b'"), ["g"], "scale"), "several energy scales")
    lacking = spark.createDataFrame([("s", {"Fe": 1}), ("s", {"Fe": 2, "Sm": 1})], "sys string, counts map<string,long>")
    assert rows(guards.end_members(lacking, "sys").select("sys", F.array_join("missing", ","))) == [("s", "Sm")]


def test_gates_events_and_log(spark):
    df = spark.createDataFrame([(1, 0.05, 5), (2, 0.5, 5), (3, None, 1), (4, 0.01, 1)], "id long, e double, n int")
    some = [gates.at_most("distance", "e", 0.1), gates.at_least("size", "n", 2)]
    judged = gates.judge(df, some)
    assert rows(judged.select("id", F.coalesce("reason", F.lit("-")))) == [(1, "-"), (2, "distance"), (3, "distance"), (4, "size")]
    found = rows(gates.events(judged, some, "id").select("id", "gate", "passed"))
    assert found == [(1, "distance", True), (1, "size", True), (2, "distance", False), (3, "distance", False), (4, "distance", True), (4, "size", False)]
    log = {r.reason: (r.n, r.examples) for r in gates.rejection_log(judged, "id", ["distance", "size", "never"]).collect()}
    assert log == {"distance": (2, [2, 3]), "size": (1, [4]), "never": (0, None)}


def test_threshold_conversion(spark):
    kinds = "id long, kind string, alpha double, beta double"
    fits = spark.createDataFrame([(1, "mp", 2.0, 0.1), (2, "pilot", 4.0, 0.2), (3, "pilot", None, None)], kinds)
    assert tuple(gates.calibrated_threshold(fits, 1.0).first()) == (0.2, "calibrated by pilot")
    assert gates.calibrated_threshold(spark.createDataFrame([], kinds), 1.0).first().how.startswith("literal")


@pytest.mark.parametrize(("a", "b", "rho"), [([1, 2, 3, 4], [10, 20, 30, 40], 1.0), ([1, 2, 3], [3, 2, 1], -1.0), ([1, 1, 2], [1, 1, 2], 1.0), ([1], [1], None), ([2, 2, 2], [1, 2, 3], None)])
def test_spearman(spark, a, b, rho):
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b, strict=True)], "a double, b double")
    got = stats.spearman(df, [], "a", "b").first().rho
    assert got == rho or got == pytest.approx(rho)


def test_share_r2_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((20, 3))
    x /= x.sum(axis=1, keepdims=True)
    y = x @ [1.0, 2.0, -1.0] + 0.1 * rng.random(20)
    long = [(i, f"p{j}", float(x[i, j]), float(y[i])) for i in range(20) for j in range(3)]
    got = stats.share_r2(spark.createDataFrame(long, "k long, p string, s double, y double"), "k", "p", "s", "y").first()
    w = np.linalg.lstsq(x, y, rcond=None)[0]
    assert got.r2 == pytest.approx(1 - ((y - x @ w) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_outcomes(spark):
    df = spark.createDataFrame([("e", "A", False), ("e", "A", True), ("e", "B", True), ("e", "C", False), ("e", "C", False)], "engine string, s string, ok boolean")
    assert rows(jobs.outcomes(df, "engine", "s", "ok")) == [("e", "converged", 2), ("e", "not_converged", 1), ("e", "retried", 1)]


def test_pareto(spark):
    df = spark.createDataFrame([(1, 10, 1.0), (2, 20, 1.5), (3, 15, 0.9), (4, 20, 1.2), (5, 10, 1.0), (6, None, 9.0)], "id int, e int, j double").withColumn("g", F.lit("x"))
    for parts in (1, 3):
        assert [r[0] for r in rows(ranking.pareto_front(df, ["g"], "e", "j", parts).select("id"))] == [1, 2, 5]
    again = ranking.pareto_front(ranking.pareto_front(df, ["g"], "e", "j"), ["g"], "e", "j")
    assert [r[0] for r in rows(again.select("id"))] == [1, 2, 5]


def test_overlap_pairs_against_brute_force(spark):
    rng = random.Random(3)
    sets = {i: {rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 9))} for i in range(40)}
    df = spark.createDataFrame([(i, "b", sorted(s)) for i, s in sets.items()], "id long, b string, t array<string>")
    want = {(i, j) for i, j in itertools.combinations(sets, 2) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.6}
    assert {(r.id_a, r.id_b) for r in dedup.overlap_pairs(df, ["b"], "id", "t", 0.6).collect()} == want


def test_greedy_by_rounds_and_by_one_task(spark):
    rng = random.Random(12)
    links = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(90)}) + [(100 + i, 101 + i) for i in range(800)]  # and a long chain
    members = spark.createDataFrame([(i,) for i in range(901)], "id long")
    want, kept = {}, set()
    for i in range(901):
        matches = [a for a, b in links if b == i and a in kept]
        want[i] = (not matches, min(matches, default=None))
        kept |= set() if matches else {i}
    pairs = spark.createDataFrame(links, "id_a long, id_b long")
    assert {r.id: (r.kept, r.duplicate_of) for r in dedup.greedy_groups(pairs, members).collect()} == want
    few = spark.createDataFrame([x for x in links if x[0] < 60], "id_a long, id_b long")
    got = {r.id: (r.kept, r.duplicate_of) for r in dedup.greedy_groups(few, members.filter("id < 60"), gathered=5).collect()}
    assert got == {i: want[i] for i in range(60)}


def test_greedy_skips_dropped(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (4, 5)], "id_a long, id_b long")
    members = spark.createDataFrame([(i,) for i in range(1, 6)], "id long")
    got = {r.id: (r.kept, r.duplicate_of) for r in dedup.greedy_groups(pairs, members).collect()}
    assert got == {1: (True, None), 2: (False, 1), 3: (True, None), 4: (True, None), 5: (False, 4)}


def test_coverage_and_diff(spark):
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "chemsys string")
    assert rows(coverage.missing_subsystems(df("Fe-Sm"), df("Fe")).select("chemsys")) == [("Fe-Sm",), ("Sm",)]
    assert rows(coverage.contained(df("Fe", "Fe-Sm", "B-Fe"), df("Fe-Sm")).select("chemsys")) == [("Fe",), ("Fe-Sm",)]
    old, new = (spark.createDataFrame(x, "k int, v double") for x in ([(1, 1.0), (2, 2.0), (3, 3.0)], [(1, 1.0 + 1e-9), (2, 2.1), (4, 4.0)]))
    assert rows(coverage.snapshot_diff(old, new, "k", ["v"])) == [(2, "~"), (3, "-"), (4, "+")]


def test_enumeration(spark):
    assert en.stoichiometries(spark, 3, 12).count() == 196
    groups = {"re": (["Sm", "Nd"], [1]), "tm": (["Fe", "Co"], [1, 2])}
    kept, refused = en.chemical_space(spark, groups, 8, {"tm": (0.5, 1.0)})
    want = set()
    for r in ("Sm", "Nd"):
        for n in (1, 2):
            for tm in itertools.combinations(("Co", "Fe"), n):
                for v in itertools.product(range(1, 9), repeat=n + 1):
                    if sum(v) <= 8 and np.gcd.reduce(v) == 1 and sum(v[1:]) / sum(v) >= 0.5:
                        want.add("".join(f"{e}{c}" for e, c in sorted(zip((r, *tm), v, strict=True))))
    assert {r.formula for r in kept.collect()} == want and refused.count() > 0
    with pytest.raises(ValueError, match="more than one group"):
        en.chemical_space(spark, {"a": (["Fe"], [1]), "b": (["Fe"], [1])}, 4)


def test_split_total_is_exact(spark):
    df = spark.createDataFrame([("g", i, float(w)) for i, w in enumerate([5, 3, 2, 1])], "g string, k int, w double").withColumn("t", F.lit(17).cast("long"))
    assert sum(r.share for r in en.split_total(df, ["g"], "t", "w", "k").collect()) == 17


def test_upserts(spark):
    old, new = (spark.createDataFrame(x, "k int, a string, b int") for x in ([(1, "x", 1), (2, "y", 2)], [(2, "z", 9), (3, "w", 3)]))
    assert rows(sinks.upsert_columns(old, new, ["k"], ["b"])) == [(1, "x", 1), (2, "y", 9), (3, "w", 3)]
    assert rows(sinks.upsert_last(old, new, ["k"])) == [(1, "x", 1), (2, "z", 9), (3, "w", 3)]
    assert rows(sinks.insert_or_ignore(old, new, ["k"])) == [(1, "x", 1), (2, "y", 2), (3, "w", 3)]


def test_readers(spark, tmp_path):
    (tmp_path / "c.csv").write_text("# list\nformula,z_min,z_max,n\nSm2Fe17,1,2,80\nSmFe5,,3,\nSmFe3\n")
    assert rows(readers.composition_list(spark, str(tmp_path / "c.csv"), (1, 1), 7)) == [("Sm2Fe17", 1, 2, 80), ("SmFe3", 1, 1, 7), ("SmFe5", 3, 3, 7)]
    (tmp_path / "bad.csv").write_text("SmFe5,one\n")
    with pytest.raises(Exception, match="no integer"):
        readers.composition_list(spark, str(tmp_path / "bad.csv")).collect()
    seeds = tmp_path / "seeds"
    seeds.mkdir()
    cell = "1.0\n5 0 0\n0 5 0\n0 0 4\n"
    (seeds / "good.vasp").write_text(f"SmFe5\n{cell}Fe Sm\n1 1\nDirect\n0 0 0\n0.5 0.5 0.5\n")
    (seeds / "old.vasp").write_text(f"old\n{cell}1 1\nDirect\n0 0 0\n0.5 0.5 0.5\n")
    got = {r.comment: r for r in readers.structure_files(spark, str(seeds), "*.vasp").collect()}
    assert got["SmFe5"].symbols == ["Fe", "Sm"] and got["SmFe5"].reason is None and got["old"].reason == "no species line"
    cache = tmp_path / "cache"
    cache.mkdir()
    for name, e in (("a", -1.0), ("b", -2.0)):
        (cache / f"{name}.json").write_text('{"chemsys": "Fe", "entries": [{"mp_id": "m", "e_raw_per_atom": %s}]}' % e)
    assert [r.e_raw_per_atom for r in readers.entry_cache(spark, str(cache)).collect()] == [-1.0]
    (tmp_path / "ignored.json").write_text('{"ignored": {"m1": {"why": "far"}, "m2": {}}}')
    assert rows(readers.id_list(spark, str(tmp_path / "ignored.json"), "ignored")) == [("m1", "far"), ("m2", "excluded")]


def test_sinks_write(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"'), (2, None)], "k int, t string").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "r"), {"k": "the key"})
    text = next((tmp_path / "r").glob("part-*")).read_text()
    assert text == '# k: the key\nk,t\n1,"a ""b"""\n2,\n'
    sinks.replace_table(df, str(tmp_path / "t"))
    sinks.replace_table(df.filter("k = 1"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_page(spark):
    page = report.Page("a < b").table("t", spark.range(3), shown=2).render()
    assert "a &lt; b" in page and "First 2 rows" in page
