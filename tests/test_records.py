"""Record rules, store operations and files of runs on small hand-worked inputs, with nulls and empty ones."""

import pytest
from pyspark.sql import functions as F

from funnelspark.functions import formula as fm
from funnelspark.functions import records as rec
from funnelspark.operators import store
from funnelspark.operators.guards import Refused
from funnelspark.sources import trees


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_moments(spark):
    counts = F.create_map(F.lit("Nd"), F.lit(2).cast("long"), F.lit("Dy"), F.lit(1).cast("long"))
    frozen, valence = (rec.hund_moment(F.lit(30.0), counts, F.lit(x)) for x in ("frozen", "valence"))
    assert one(spark, frozen, valence) == (pytest.approx(30 + 2 * 3.27 - 10), 30.0)
    none = F.array().cast("array<double>")
    small, large = F.array(F.lit(0.1), F.lit(-0.4)), F.array(F.lit(0.1), F.lit(2.0))
    assert one(spark, rec.frozen_visible(none), rec.frozen_visible(small), rec.frozen_visible(large)) == (False, True, False)
    with pytest.raises(Exception, match="Hund"):
        one(spark, rec.hund_moment(F.lit(1.0), F.create_map(F.lit("Fe"), F.lit(1).cast("long")), F.lit("frozen")))


def test_job_outcomes(spark):
    case = lambda exists, finished, reached, nsw, n_elec, n_ionic: rec.job_outcome(*(F.lit(x) for x in (exists, finished, reached, nsw, None, 60, n_elec, n_ionic)))
    got = one(spark, case(False, False, False, 99, 0, 0), case(True, False, True, 99, 10, 5), case(True, True, False, 0, 10, 1), case(True, True, False, 0, 60, 1), case(True, True, False, 50, 10, 50), case(True, True, False, 50, 10, 9))
    assert [(g.state, g.reason) for g in got] == [("failed", "no_log"), ("timeout", "cut_off"), ("done", ""), ("done", "scf_not_converged"), ("done", "ionic_step_limit"), ("done", "force_limit_not_met")]
    assert [g.converged for g in got[2:]] == [True, False, False, False]


def test_texts(spark):
    got = one(spark, rec.short_reason(F.lit("no entries among 12 of them. More.")), rec.short_reason(F.lit("missing references for [Fe, Co]")), rec.base_name(F.lit("/a/b/c.vasp")), rec.age_text(F.lit(7200)), rec.transient(F.lit(None).cast("string")))
    assert got == ("no entries", "missing references", "c.vasp", "2h", False)
    assert one(spark, *(rec.backoff_seconds(F.lit(i)) for i in (0, 3, 9))) == (5.0, 40.0, 480.0)
    m = lambda **kv: F.create_map(*(F.lit(x) for p in kv.items() for x in p))
    assert one(spark, rec.inherited(m(a="1", b="1"), m(b="2", c="2")), rec.merged_exclusions(m(a="1"), m(a="2", b="2"))) == ({"a": "1", "b": "2", "c": "2"}, {"a": "1", "b": "2"})


def test_gcd_of_large_counts(spark):
    big = F.array(*(F.lit(x).cast("long") for x in (2**40, 3 * 2**39, 2**62)))
    assert one(spark, fm.gcd_of(big), fm.gcd_of(F.array().cast("array<long>")), fm.gcd_of(F.array(F.lit(6).cast("long")))) == (2**39, 1, 6)


def test_rare_earths_are_the_lanthanides():
    assert len(fm.RARE_EARTHS) == 15 and not {"Sc", "Y"} & set(fm.RARE_EARTHS) and len(fm.ELEMENTS) == 118


def test_placement_reasons(spark):
    entries = [("a", 0.0, 0.0, "raw", "PBE"), ("a", 1.0, 0.0, "raw", ""), ("a", 0.5, -1.0, "raw", None), ("b", 0.0, 0.0, "raw", "PBE"), ("b", 1.0, 0.0, "other", "PBE"), ("c", 0.0, 0.0, "raw", "PBE")]
    entries = spark.createDataFrame(entries, "sys string, x double, e double, scale string, run_type string")
    asked = spark.createDataFrame([(1, "a", 0.25, -0.4), (2, "a", 0.5, None), (3, "b", 0.5, 0.0), (4, "c", 0.5, 0.0), (5, "d", 0.5, 0.0), (6, "a", 0.5, -1.5)], "id int, sys string, x double, e double")
    got = {r.id: (r.e_above_hull, r.absent) for r in store.placed_with_reasons(asked, entries).collect()}
    assert got[1] == (pytest.approx(0.1), None) and got[6] == (pytest.approx(-0.5), None)
    assert [got[i][1] for i in (2, 3, 4, 5)] == ["no energy", "several energy scales", "an end member is missing", "no reference entries"]


def test_store_operations_on_nothing(spark):
    rows = spark.createDataFrame([], "id long, state string, fault string, error string, converged boolean")
    assert store.requeue(rows, "state", "fault", "x").count() == 0 and store.tally(rows, ["state"]).count() == 0
    assert tuple(store.batch_stats(rows, "error", "converged").first()) == (0, 0, 0, 0, 0)
    assert [f.count() for f in store.absorbed(rows.withColumn("epa", F.lit(1.0)), "id", "epa", "converged", "error")] == [0, 0, 0]


def test_stage_slice():
    order = ["source", "screen", "dedup", "filter", "dft"]
    assert store.stage_slice(order) == order and store.stage_slice(order, through="dedup") == order[:3]
    assert store.stage_slice(order, since="filter") == order[3:] and store.stage_slice(order, "dft", "screen", ["dedup", "dft"]) == ["dedup", "dft"]


def test_latest_log_clears_a_fault(spark):
    logs = spark.createDataFrame([("a", 1, "E1"), ("a", 2, None), ("b", 1, None), ("b", 2, "E2"), ("c", 1, "E3")], "folder string, at int, fault string")
    assert sorted(map(tuple, store.latest_faults(logs, "folder", "at", "fault").collect())) == [("b", "E2"), ("c", "E3")]


def test_neighbours_against_all_pairs(spark):
    import random

    rng = random.Random(4)
    points = [(i, i % 2, [rng.random() for _ in range(4)]) for i in range(120)]
    got = {r.id: (r.n, r.others) for r in store.neighbours(spark.createDataFrame(points, "id long, kind int, v array<double>"), "kind", "id", "v", 0.3, 0.3).collect()}
    near = lambda a, b: sum((x - y) ** 2 for x, y in zip(a[2][:3], b[2][:3], strict=True)) <= 0.09
    assert got == {a[0]: (sum(near(a, b) for b in points) - 1, sum(near(a, b) and a[1] != b[1] for b in points)) for a in points}


def test_xyz_frames(spark, tmp_path):
    (tmp_path / "a.extxyz").write_text('2\nLattice="1 0 0 0 1 0 0 0 1"\nFe 0 0 0\nCo 0.5 0.5 0.5\n\n1\nno cell\nSm 1 2 3\n')
    (tmp_path / "b.extxyz").write_text("3\nx\nFe 0 0 0\n")
    got = {(r.path[-8:], r.frame): r for r in trees.extxyz(spark, str(tmp_path)).collect()}
    assert got["a.extxyz", 0].symbols == ["Fe", "Co"] and got["a.extxyz", 0].cell[0] == 1.0 and got["a.extxyz", 1].positions == [[1.0, 2.0, 3.0]]
    assert got["b.extxyz", 0].fault.startswith("unreadable") and len(got) == 3
    (tmp_path / "none").mkdir()
    with pytest.raises(Refused):
        trees.extxyz(spark, str(tmp_path / "none"))


def test_system_lists(spark):
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "chemsys string")
    names = lambda d: [r.chemsys for r in d.collect()]
    assert names(trees.system_list(df("b", "a"), df("a", "c"), df("z"))) == ["a", "b", "c"] and names(trees.system_list(None, None, df("z", "z"))) == ["z"]
