"""Steps that once grew faster than their input: what they must not do, and that their results are the same."""

import bisect
import itertools
import math
import random

from pyspark.sql import functions as F

import pytest

import __spark_entry__ as entry
from funnelspark.operators import arrivals, coverage, dedup, enumerate as en, facets, ranges, ranking, signatures, stats
from funnelspark.sources import campaign, readers, trees
from funnelspark.sources.snapshots import Snapshots


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_brackets_without_frames_that_are_read_anew(spark):
    rng = random.Random(3)
    values = [None if i % 50 == 0 else rng.randrange(40) for i in range(3000)]
    points = sorted(rng.sample(range(40), 9))
    rows = spark.createDataFrame(list(enumerate(values)), "id int, x int")
    out = ranges.bracket(rows, spark.createDataFrame([(p, p * 10) for p in points], "x int, v int"), [], "x")
    assert "unboundedfollowing" not in _plan(out)
    for r in out.collect():
        at = None if r.x is None else bisect.bisect_right(points, r.x)
        want = (None, None) if at is None else (points[at - 1] if at else None, points[at] if at < len(points) else None)
        assert (r.low and r.low.x, r.high and r.high.x) == want and r.x == values[r.id]
    line = ranges.interpolated(rows.filter("x is not null"), spark.createDataFrame([(p, float(p)) for p in points], "x int, v double"), [], "x", "v")
    assert line.filter(F.abs(F.col("v") - F.col("x")) > 1e-9).count() == 0


def test_a_composition_is_placed_once(spark):
    ends = [(-i - 1, s, [float(i == j) for j in range(3)], 0.0) for s in (1, 2) for i in range(3) if (s, i) != (2, 1)]
    rows = [(i, 1 + i % 3, None if i % 10 == 0 else [0.5, 0.5, 0.0], None if i % 7 == 0 else -i / 100.0) for i in range(60)]
    rows += [(60, 1, [0.25, 0.25, 0.5], -0.1)]
    kinds = "id long, sys int, fractions array<double>, e double"
    entries, compounds = spark.createDataFrame(rows + ends, kinds), spark.createDataFrame(rows, kinds)
    out = facets.placed(compounds, facets.facets(entries, 3), 3)
    assert "flatmapcogroups" not in _plan(out)  # what is left of the plan is a join
    low = min(e for _, s, f, e in rows if s == 1 and f == [0.5, 0.5, 0.0] and e is not None)
    got = {r.id: r for r in out.collect()}
    assert len(got) == len(rows)
    for i, s, f, e in rows:
        r, hull = got[i], None if s != 1 or f is None else low * (0.5 if i == 60 else 1)
        assert (r.hull is None) == (hull is None) and (hull is None or abs(r.hull - hull) < 1e-9)
        assert (r.e_above_hull is None) == (r.stable is None) == (r.formation is None) == (hull is None or e is None)
        assert r.e_above_hull is None or abs(r.e_above_hull - (e - hull)) < 1e-9 and abs(r.formation - e) < 1e-9 and r.stable == (e - hull <= 1e-9)
        assert (r.decomposition is None) == (hull is None) and (hull is None or abs(sum(d.amount for d in r.decomposition) - 1) < 1e-9)


def test_few_candidates_of_overlapping_sets(spark):
    """Sets that share what is left of their prefixes only, or too few tokens of most buckets, go before they are shuffled."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    sets = [sorted(rng.sample(words, 60)) for _ in range(60)]
    sets += [[*s[:-rng.randrange(1, 8)], f"x{i}"] for i, s in enumerate(sets[:30])] + [sets[0], [], ["w1"], ["w1"]]
    rows = spark.createDataFrame([(i, 1, s) for i, s in enumerate(sets)], "id int, b int, t array<string>")
    alike = {(i, j) for j in range(len(sets)) for i in range(j) if sets[i] and len({*sets[i]} & {*sets[j]}) >= 0.8 * len({*sets[i]} | {*sets[j]})}
    assert {(r.id_a, r.id_b) for r in dedup.overlap_pairs(rows, ["b"], "id", "t", 0.8).collect()} == alike
    ordered = dedup.ordered_sets(rows, ["b"], "id", "t")
    pairs = spark.createDataFrame([(i, j) for j in range(90) for i in range(j)], "id_a int, id_b int")
    left = {(r.id_a, r.id_b) for r in dedup._bounded(pairs, ordered, ordered, 0.8).collect()}
    assert {p for p in alike if p[1] < 90} <= left and len(left) < 100 < pairs.count()
    meet = spark.createDataFrame([(0, 1, 60, 60, 5, 5), (2, 3, 60, 60, 12, 3)], "id_a int, id_b int, n_a int, n_b int, i_a int, i_b int")
    assert {r.id_a for r in dedup._candidates(meet, 0.8).collect()} == {0}
    assert "n_a#" in (plan := dedup._candidates(meet, 0.8)._jdf.queryExecution().optimizedPlan().toString()) and plan.count("Filter") == 2  # one before the sums


def _texts(rng, n=120):
    """Sets of unlike texts of few words, of all sizes, and a large family of near copies."""
    words = [f"w{i}" for i in range(900)]
    sets = [sorted(rng.sample(words, rng.choice((1, 3, 4, 5, 9, 30, 80, 250)))) for _ in range(n)]
    base = rng.sample(words, 150)
    for i in range(n):
        some = rng.sample(base, 150 - rng.randrange(16))
        sets += [sorted({*some, *rng.sample(words, rng.randrange(12))}), sorted({*sets[i], *rng.sample(words, rng.randrange(1 + len(sets[i]) // 4))})]
    return [list(s) for s in dict.fromkeys(map(tuple, sets))]


def _alike(sets, threshold):
    whole = [frozenset(s) for s in sets]
    return {(i, j): len(a & b) for j, b in enumerate(whole) for i, a in enumerate(whole[:j]) if a & b and len(a & b) >= threshold * len(a | b) - 1e-12}


@pytest.mark.parametrize("threshold", [0.7, 0.8, 0.95])
def test_unlike_sets_hardly_meet_and_families_meet_once(spark, threshold):
    """All pairs by brute force; near copies are no candidates, and unlike sets go before the shuffle."""
    sets = _texts(random.Random(7))
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "id int, x array<string>").select("id", dedup.hashed([], "x").alias("t"))
    want = _alike(sets, threshold)
    met = dedup.meeting_signatures(signatures.signatures(rows, threshold, signatures.frequent(rows)))
    for part in (dedup.FAMILY_PART, 20):
        got = dedup.set_pairs(rows, met, threshold, part).collect()
        assert {(r.id_a, r.id_b): r.n_common for r in got} == want and len(got) == len(want)
        assert all(abs(r.jaccard - r.n_common / (len(sets[r.id_a]) + len(sets[r.id_b]) - r.n_common)) < 1e-12 for r in got)
    families = dedup._families(met, rows, threshold)
    members = families.groupBy("head").count().agg(F.max("count")).first()[0]
    apart = (F.col("id_a") < F.col("id_b")) & (F.col("head_a") != F.col("head_b"))
    left = {(r.id_a, r.id_b) for r in dedup.candidates(dedup.side_of(met, rows, "a", families), dedup.side_of(met, rows, "b", families), apart, threshold).collect()}
    assert len(left - want.keys()) < len(sets) and (threshold > 0.8 or members > 80 and len(left & want.keys()) < len(want) / 5)


def test_blocks_share_no_tokens(spark):
    rows = spark.createDataFrame([(i, b, c, ["x", "y"]) for i, (b, c) in enumerate([("p", None), (None, "p"), ("", "p"), ("p", ""), ("q", "q"), ("p", None)])], "id int, b string, c string, t array<string>")
    assert [(r.id_a, r.id_b) for r in dedup.overlap_pairs(rows, ["b", "c"], "id", "t", 0.8).collect()] == [(0, 5)]


@pytest.mark.parametrize("name", ["near_dup_pairs", "greedy_dedup"])
def test_documents_are_read_once(spark, tmp_path, name):
    """Texts are taken apart once; what follows reads tokens."""
    rows = [(i, " ".join(s), "en", 1) for i, s in enumerate(_texts(random.Random(8), 12))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    out = entry.queries()[name](spark, str(tmp_path))
    assert not [f for f in out.inputFiles() if "documents.parquet" in f] and out.count() > 12


def test_matched_arrivals_meet_no_other(spark, tmp_path, monkeypatch):
    """What matches the pool is out before the rows of its batch meet each other; the index has signatures."""
    sets = _texts(random.Random(9), 40)
    rows = spark.createDataFrame([(i, "b", s) for i, s in enumerate(sets)], "id long, b string, t array<string>")
    met, own = [], arrivals.set_pairs
    monkeypatch.setattr(arrivals, "set_pairs", lambda x, *a: met.append({r.id for r in x.collect()}) or own(x, *a))
    store, half = Snapshots(spark, str(tmp_path)), len(sets) // 2
    arrivals.absorb(store, rows.filter(F.col("id") < half), 0, ["b"], "id", "t", 0.8)
    got = {r.id: r.duplicate_of for r in arrivals.absorb(store, rows.filter(F.col("id") >= half), 1, ["b"], "id", "t", 0.8).collect()}
    kept, alike = [], _alike(sets, 0.8)
    for i in range(len(sets)):
        assert got[i] == (of := next((k for k in kept if (k, i) in alike), None))
        kept += [i] if of is None else []
    assert met[1] == {i for i in range(half, len(sets)) if not any((k, i) in alike for k in kept if k < half)}
    assert "sig" in store.read("index").columns


def test_keyed_csv_of_many_parts(spark, tmp_path):
    """The last of a key by name of file and place in it, though Spark reads large files first; no sort of a key's rows."""
    (tmp_path / "a.csv").write_text("k,v\n" + "".join(f"{i % 7},{i}\n" for i in range(5000)) + " ,9\n")
    (tmp_path / "b.csv").write_text("k,v\n1,first\n1,last\n8,x\n")
    got = readers.keyed_csv(spark, str(tmp_path), "k")
    want = {str(i % 7): str(i) for i in range(5000)} | {"1": "last", "8": "x"}
    assert {r.k: r.v for r in got.collect()} == want and got.columns == ["k", "v"] and "window" not in _plan(got)


def test_trees_are_listed_read_and_written_by_tasks(spark, tmp_path):
    """As Spark's own listing has it, in several rounds; no path goes through the driver, no file through Spark's writer by partition."""
    (tmp_path / "a b" / "_x").mkdir(parents=True)
    for name in ("a b/one", "a b/_x/no", "a b/.no", "_k=1", "%20", "_no"):
        (tmp_path / name).write_text(name)
    for i in range(10_050):
        (tmp_path / "wide" / str(i)).mkdir(parents=True)
    for i in (3, 9_999):
        (tmp_path / "wide" / str(i) / "f").write_text("é\n")
    (tmp_path / "gone").symlink_to(tmp_path / "nowhere")
    tree = trees.run_tree(spark, str(tmp_path), r"([^/]+)$", ["name"])
    own = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).select("path", "length", "modificationTime", "content")
    assert sorted(tree.drop("name").collect()) == sorted(own.drop("content").collect()) and tree.count() == 5
    read = campaign.contents(spark, tree)
    assert "binaryfile" not in _plan(read)
    assert {(r.path, r.content) for r in read.collect()} == {(r.path, bytes(r.content).decode()) for r in own.collect()}
    rows = spark.createDataFrame([(i % 3, i, f"v{i}") for i in range(50)], "a int, b int, v string")
    trees.write_tree(rows, f"file://{tmp_path}/out", ["a", "b"], "v")
    assert {(r.a, r.b, r.value) for r in spark.read.text(f"{tmp_path}/out").collect()} == {tuple(r) for r in rows.collect()}
    assert not list((tmp_path / "out").rglob(".*"))  # neither checksums nor what was not yet whole


def test_containment_by_numbers(spark):
    """Systems of few and of many elements, small and large targets: as sets have it, without strings of subsystems being shuffled."""
    rng = random.Random(5)
    for n, most in ((9, 16), (9, 3), (80, 4)):
        names = [f"E{i:02}" for i in range(n)]
        rows = spark.createDataFrame([("-".join(sorted(rng.sample(names, rng.randrange(1, 7)))),) for _ in range(300)] + [(None,)], "chemsys string")
        keys = [r.chemsys for r in rows.collect() if r.chemsys]
        want = {t: sum(set(s.split("-")) <= set(t.split("-")) for s in keys) for t in keys}
        out = coverage.containment_counts(rows, rows, most=most)
        assert {r.target: r.n for r in out.collect()} == want
        assert "array_join" not in _plan(out)
        pairs = coverage.contained(rows, rows.limit(50), most=most)
        assert pairs.count() == sum(want[t] for t in {r.chemsys for r in rows.limit(50).collect() if r.chemsys})


def test_systems_of_all_orders(spark, tmp_path):
    """Every order of parts with brands counts, whatever its other lines are; one of parts without brands is no system."""
    brands, rng = {i: None if i % 9 == 8 else f"B{i % 30:02}" for i in range(60)}, random.Random(3)
    lines = [(o, rng.randrange(70)) for o in range(40) for _ in range(rng.choice((1, 2, 5, 24)))] + [(40, 8), (41, 99), (42, None), (43, 8), (43, 1)]
    spark.createDataFrame(list(brands.items()), "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    systems = [s for o in range(44) if (s := {brands.get(p) for k, p in lines if k == o} - {None})]
    want = {"-".join(sorted(t)): sum(s <= t for s in systems) for t in systems}
    assert {r.target: r.n for r in entry.queries()["subsystem_containment"](spark, str(tmp_path)).collect()} == want


def test_every_column_is_ranked_once(spark):
    """All pairs of columns as spearman has each, with nulls, ties, a constant column and one without values; rows aren't copied by pair."""
    rng = random.Random(6)
    rows = [(i % 7 / 2.0, None if i % 5 == 0 else rng.random(), None if i % 3 == 0 else rng.randrange(20), 4, None) for i in range(400)]
    df = spark.createDataFrame(rows, "p double, q double, r int, s int, t double")
    out = stats.rank_correlations(df, ["p", "q", "r", "s", "t"])
    got = {(x.a, x.b): (x.n, x.rho) for x in out.collect()}
    want = {(a, b): stats.spearman(df, [], a, b).first() for i, a in enumerate("pqrs") for b in "pqrs"[i + 1 :]}
    assert got.keys() == want.keys()
    for k, (n, rho) in got.items():
        assert n == want[k].n and (rho is None) == (want[k].rho is None) and (rho is None or abs(rho - want[k].rho) < 1e-9)
    assert got["p", "q"][1] is not None and got["p", "s"][1] is None and _plan(out).count("generate explode") <= 1


def test_vectors_of_counts_are_made_once(spark):
    """Spaces of the same size share their vectors, whose common divisors aren't taken anew for every choice; by hand it's the same."""
    rows = [(s, m, g, e, *b) for s, m in ((1, 4), (2, 4), (3, 3)) for g, e, b in (("a", ["Fe", "Co"], (1, 2, 0.5, None)), ("b", ["B", "F"], (0, 1, None, 0.3)), ("c", ["Si"], (0, 1, None, None)))]
    df = spark.createDataFrame(rows, "space int, most int, grp string, elements array<string>, least int, most_of int, low double, high double")
    kept, rejected, refused = en.chemical_spaces(df, 3)
    assert "v#" in _plan(kept) and "log2" not in _plan(kept) and refused.count() == 0
    want = {}
    for s, m in ((1, 4), (2, 4), (3, 3)):
        for fe, co, b, f, si in itertools.product(range(m + 1), repeat=5):
            n = {"Fe": fe, "Co": co, "B": b, "F": f, "Si": si}
            n, total = {e: x for e, x in sorted(n.items()) if x}, fe + co + b + f + si
            if fe + co and not (b and f) and total <= m and len(n) <= 3 and math.gcd(*n.values()) == 1:
                want[s, "".join(f"{e}{x}" for e, x in n.items())] = ("a below its share" if (fe + co) / total < 0.5 else "b above its share" if (b + f) / total > 0.3 else None, "-".join(n), n, total)
    assert {(r.space, r.formula): (None, r.chemsys, r.counts, r.n_atoms) for r in kept.collect()} == {k: v for k, v in want.items() if v[0] is None}
    assert {(r.space, r.formula): r.reason for r in rejected.collect()} == {k: v[0] for k, v in want.items() if v[0]}


def test_places_without_a_window_over_rows(spark, monkeypatch):
    """Places and hashes of large groups from parts of bounded size: rows are sorted once, in parts, and not again by a window."""
    rows = spark.createDataFrame([(None if i % 11 == 0 else i % 3, i * 7919 % 5003, f"t{i}") for i in range(5003)], "g int, i int, t string")
    plain = coverage.chunked_hash(rows, ["g"], ["i"], F.col("t"), 10).collect()
    monkeypatch.setattr(ranking, "PART", 300)
    out = ranking.numbered(rows, ["g"], [F.col("i")], "n", 5003)
    assert "row_number" not in _plan(out) and len(out.inputFiles()) >= 17
    order = {}
    for r in sorted(rows.collect(), key=lambda r: r.i):
        order.setdefault(r.g, []).append(r.i)
    assert {(r.g, r.i): r.n for r in out.collect()} == {(g, i): n + 1 for g, own in order.items() for n, i in enumerate(own)}
    assert sorted(coverage.chunked_hash(rows, ["g"], ["i"], F.col("t"), 10).collect(), key=str) == sorted(plain, key=str)
