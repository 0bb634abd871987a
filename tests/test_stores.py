"""Snapshots, inventories, incremental hulls and arrivals: nothing half done, nothing read twice, equal to a whole rebuild."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import arrivals, dedup, hull, incremental
from funnelspark.sources import inventory
from funnelspark.sources.snapshots import Conflict, Parts, Snapshots


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def held(df):
    return sorted(r[0] for r in df.collect())


def test_a_failure_between_tables_leaves_all_as_they_were(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    assert store.read("a") is None and store.manifest()["version"] == 0
    store.commit({"a": numbers(spark, 1), "b": numbers(spark, 2)})
    broken = numbers(spark, 1).select(F.assert_true(F.col("v") > 5).isNull().alias("v"))
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION|is not true"):
        store.commit({"a": numbers(spark, 7, 8), "b": broken})
    assert store.versions() == [1] and held(store.read("a")) == [1] and held(store.read("b")) == [2]
    assert store.commit({"b": numbers(spark, 3)}) == 2
    assert held(store.read("a")) == [1] and held(store.read("b")) == [3] and held(store.read("b", 1)) == [2]


def test_a_batch_is_taken_once(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    assert store.commit({"a": numbers(spark, 1)}, batch=4) == 1
    assert store.commit({"a": numbers(spark, 9)}, batch=4) == 1 and store.commit({"a": numbers(spark, 9)}, batch=3) == 1
    assert held(store.read("a")) == [1]
    assert store.commit({"a": numbers(spark, 2)}, batch=5) == 2


def test_parts_are_replaced_one_by_one(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    rows = spark.createDataFrame([(i, i % 3) for i in range(9)], "v long, p int")
    store.commit({"t": Parts(rows, "p", [0, 1, 2])})
    before = store.manifest()["tables"]["t"]["parts"]
    store.commit({"t": Parts(rows.filter("p = 1 and v > 4"), "p", [1, 2])})  # part 2 is empty from now on
    after = store.manifest()["tables"]["t"]["parts"]
    assert after["0"] == before["0"] and after["1"] != before["1"] and "2" not in after
    assert held(store.read("t")) == [0, 3, 6, 7] and held(store.read("t", parts=[1])) == [7] and held(store.read("t", parts=[2])) == []
    assert held(store.read("t", 1)) == list(range(9))
    with pytest.raises(ValueError, match="isn't replaced"):
        store.commit({"t": Parts(rows, "p", [0])})


def test_old_versions_go_with_their_files(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path), keep=2)
    for i in range(4):
        store.commit({"a": numbers(spark, i)} | ({"b": numbers(spark, 9)} if i == 0 else {}))
    assert store.versions() == [3, 4] and held(store.read("b")) == [9]
    assert sorted(n.split("-")[0] for n in os.listdir(tmp_path / "data")) == ["a", "a", "b"]


def test_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    one, two = Snapshots(spark, str(tmp_path)), Snapshots(spark, str(tmp_path))
    one.commit({"a": numbers(spark, 1)})
    was = two.manifest()
    one.commit({"a": numbers(spark, 2)})
    monkeypatch.setattr(two, "manifest", lambda version=None: was)
    with pytest.raises(Conflict):
        two.commit({"a": numbers(spark, 3)})
    assert held(one.read("a")) == [2]


def test_unchanged_files_are_not_read_again(spark, tmp_path):
    folder = tmp_path / "tree"
    opened = spark.sparkContext.accumulator(0)

    def parse(files):
        @F.udf("long")
        def number(content):
            opened.add(1)
            return int(bytes(content))

        return files.select("path", number("content").alias("v"))

    def put(name, text):
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)

    for i in range(6):
        put(f"d{i % 2}/{i}.n", str(i))
    put("d0/skipped.txt", "x")
    store = Snapshots(spark, str(tmp_path / "store"))
    assert inventory.scan(store, str(folder), parse, "*.n") == {"read": 6, "dropped": 0, "kept": 0}
    assert held(store.read("parsed").select("v")) == list(range(6)) and opened.value == 6
    version = store.manifest()["version"]
    assert inventory.scan(store, str(folder), parse, "*.n") == {"read": 0, "dropped": 0, "kept": 6}
    assert opened.value == 6 and store.manifest()["version"] == version
    time.sleep(0.01)
    put("d0/0.n", "10")
    put("new/7.n", "7")
    (folder / "d1/5.n").unlink()
    assert inventory.scan(store, str(folder), parse, "*.n") == {"read": 2, "dropped": 1, "kept": 4}
    assert held(store.read("parsed").select("v")) == [1, 2, 3, 4, 7, 10] and opened.value == 8


def entries(spark, seed, n, systems=6):
    rng = random.Random(seed)
    rows = [(1000 + 2 * s + x, f"s{s}", 0, float(x), 0.0) for s in range(systems) for x in (0, 1)]
    rows += [(i, f"s{rng.randrange(systems)}", 0, rng.randrange(1, 10) / 10, -rng.random()) for i in range(n)]
    return spark.createDataFrame(rows, "id long, sys string, seq long, x double, e double")


def placements(df):
    return sorted((r.id, r.sys, round(r.e_above_hull, 9)) for r in df.collect())


def test_incremental_hulls_are_those_of_a_rebuild(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    whole = entries(spark, 1, 40)
    incremental.absorb(store, whole.filter("id >= 1000 or id % 2 = 0"), 0, hull.place_binary, 8)
    later = whole.filter("id < 1000 and id % 2 = 1 and sys in ('s1', 's2')").withColumn("seq", F.lit(5).cast("long"))
    before = store.manifest()["tables"]
    touched = incremental.absorb(store, later, 1, hull.place_binary, 8)
    after = store.manifest()["tables"]
    for t in ("entries", "placements"):  # files of other buckets are the same ones
        assert {p: f for p, f in before[t]["parts"].items() if int(p) not in touched} == {p: f for p, f in after[t]["parts"].items() if int(p) not in touched}
    now = whole.filter("id >= 1000 or id % 2 = 0 or sys in ('s1', 's2')")
    assert placements(store.read("placements")) == placements(hull.place_binary(now))
    version = store.manifest()["version"]
    incremental.absorb(store, later, 1, hull.place_binary, 8)  # once more after a failure
    assert store.manifest()["version"] == version
    put_right = spark.createDataFrame([(1000, "s0", 9, 0.0, -0.5)], "id long, sys string, seq long, x double, e double")
    incremental.absorb(store, put_right, 2, hull.place_binary, 8)
    assert placements(store.read("placements")) == placements(hull.place_binary(now.filter("id <> 1000").unionByName(put_right)))


@pytest.mark.parametrize("policy", ["drop", "warn", "off"])
def test_arrivals_are_one_pass(spark, tmp_path, policy):
    rng = random.Random(4)
    base = [[rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 12))] for _ in range(12)]
    sets = [sorted({*rng.choice(base), *rng.sample("abcdefghijklmnop", rng.randrange(3))}) for _ in range(60)] + [[], []]
    rows = spark.createDataFrame([(i, f"b{i % 2}", s) for i, s in enumerate(sets)], "id long, b string, t array<string>")
    store = Snapshots(spark, str(tmp_path))
    for n, (low, high) in enumerate([(0, 20), (20, 21), (21, 62)]):
        out = arrivals.absorb(store, rows.filter((F.col("id") >= low) & (F.col("id") < high)), n, ["b"], "id", "t", 0.7, policy)
    got = {r.id: (r.kept, r.duplicate_of) for r in out.collect()}
    alike = lambda i, j: i % 2 == j % 2 and len({*sets[i]} | {*sets[j]}) > 0 and len({*sets[i]} & {*sets[j]}) / len({*sets[i]} | {*sets[j]}) >= 0.7 - 1e-12
    kept, want = [], {}
    for i in range(62):
        matches = [j for j in (kept if policy == "drop" else range(i)) if sets[i] and alike(i, j)] if policy != "off" else []
        want[i] = (not matches or policy != "drop", min(matches, default=None))
        if want[i][0]:
            kept.append(i)
    assert got == want
    again = arrivals.absorb(store, rows.filter("id >= 21"), 2, ["b"], "id", "t", 0.7, policy)
    assert again.count() == 62


def test_star_pairs_say_what_all_pairs_say(spark):
    rows = spark.createDataFrame([(i, "b", list("abcdefgh")) for i in range(5)] + [(9, "b", list("abcdefghi")), (8, "b", [])], "id long, b string, t array<string>")
    firsts, copies = dedup.collapsed(rows, ["b"], "id", "t")
    pairs = dedup.overlap_pairs(firsts, ["b"], "id", "t", 0.8)
    assert sorted((r.id_a, r.id_b) for r in dedup.star_pairs(pairs, copies).collect()) == [(0, 1), (0, 2), (0, 3), (0, 4), (0, 9)]
    assert dedup.spread_pairs(pairs, copies).count() == 15
