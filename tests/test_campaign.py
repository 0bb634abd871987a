"""Trees of past work, claims, lives with state and timers, amendments."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from funnelspark.functions import values as fv
from funnelspark.operators import claims, periodic, store
from funnelspark.sources import campaign, sinks
from funnelspark.sources.snapshots import Conflict, Snapshots
from funnelspark.streaming import cycle, lifecycle

RULES = lifecycle.Rules({"new": {"a"}, "a": {"b", "bad"}, "b": {"a", "ok"}, "bad": {"a", "bad"}, "ok": {"a"}}, {"bad"}, {"ok"})
PATTERN = r"([^/]+)/s(\d+)/(\d+)-([A-Za-z]+)/OUT$"


def tree(root):
    for system, s, step, name in itertools.product(("Fe", "FeSm", "Sm"), (1, 2), (1, 2, 3), ("Relax",)):
        if step <= s + 1:
            at = root / system / f"s{s}" / f"{step}-{name}"
            at.mkdir(parents=True)
            (at / "OUT").write_text(f"energy = {step}.5\nE0 energy = -{step}.25 eV\n" + ("met\n" if s == 1 else "") + ("end\n" if step < 3 or system == "Fe" else ""))
            (at / "other").write_text("x")


def test_only_the_newest_steps_are_read(spark, tmp_path, monkeypatch):
    tree(tmp_path)
    names, asked = ["system", "s", "step", "name"], []
    plain = campaign.contents
    monkeypatch.setattr(campaign, "contents", lambda spark, files: asked.append(sorted(r.path.split("/", 3)[-1] for r in files.collect())) or plain(spark, files))
    got = campaign.runs(spark, str(tmp_path), PATTERN, names, ["system", "s"], "step", F.col("system").contains("Fe"))
    found = campaign.properties(got, {"energy": r"(?s).*energy = (-?[0-9.]+)", "none": "never ([0-9]+)"}, "end", "met")
    rows = {(r.system, r.s): (r.step, r.steps, r.energy, r.none, r.converged, r.warning) for r in found.collect()}
    assert rows == {("Fe", "1"): ("2", 2, -2.25, None, True, None), ("Fe", "2"): ("3", 3, -3.25, None, False, "last_step_only"), ("FeSm", "1"): ("2", 2, -2.25, None, True, None), ("FeSm", "2"): ("3", 3, -3.25, None, False, "cut_off")}
    assert len(asked[0]) == 4 and all("/Sm/" not in p for p in asked[0])
    assert {r.system for r in campaign.runs(spark, str(tmp_path), PATTERN, names, ["system", "s"], "step", limit=1).collect()} == {"Fe"}
    assert campaign.runs(spark, str(tmp_path), PATTERN, names, ["system", "s"], "step", F.lit(False)).collect() == []


def test_energies_are_attached_by_id(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "id long, v string")
    energies = spark.createDataFrame([(1, 2.0), (1, 1.0), (None, 9.0)], "id long, e double")
    assert sorted((r.v, r.e, r.attached) for r in campaign.attached(rows, energies, "id", ["e"]).collect()) == [("x", 1.0, True), ("y", None, False), ("z", None, False)]


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def test_nothing_is_claimed_twice(spark, tmp_path, monkeypatch):
    own = Snapshots(spark, str(tmp_path))
    held = lambda df: sorted(r.id for r in df.collect())
    assert claims.live(own) is None
    assert held(claims.claim(own, ids(spark, 1, 2, 2), "a", "2024-01-01")) == [1, 2]
    assert held(claims.claim(own, ids(spark, 2, 3), "b", "2024-01-02")) == [3]
    claims.release(own, ids(spark, 1, 9), "2024-01-03")
    assert held(claims.claim(own, ids(spark, 1, 2, 3), "b", "2024-01-04")) == [1]
    assert sorted((r.id, r.owner) for r in claims.live(own).collect()) == [(1, "b"), (2, "a"), (3, "b")]
    # another commits between our reading and our commit: we see its claims when we try again
    plain, tried = own.commit, []

    def late(changes, batch=None):
        if not tried:
            tried.append(1)
            claims.claim(Snapshots(spark, str(tmp_path)), ids(spark, 7), "c", "2024-01-05")
            raise Conflict("taken")
        return plain(changes, batch)

    monkeypatch.setattr(own, "commit", late)
    assert held(claims.claim(own, ids(spark, 7, 8), "a", "2024-01-05")) == [8]


def feed(n, keys, seed):
    rng, at = random.Random(seed), datetime(2024, 1, 1)
    return [(rng.choice(keys), i, rng.choice(["a", "b", "bad", "ok"]), at + timedelta(seconds=60 * i)) for i in range(n)]


def run_lives(spark, folder, batches, name, stale_s=None):
    at = folder / name
    for rows in batches:
        spark.createDataFrame(rows, "key string, seq long, state string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{at}/in")
    stream = spark.readStream.schema("key string, seq long, state string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    out = lifecycle.lives(stream, RULES, "1 minute", stale_s).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/cp").trigger(availableNow=True).start()
    out.awaitTermination()
    return [tuple(r) for r in spark.read.schema(lifecycle.OUT).parquet(f"{at}/out").collect()]


def test_lives_as_a_stream_are_the_batch_ones_and_replays_change_nothing(spark, tmp_path):
    rows = feed(60, "xyz", 1)
    want = sorted(tuple(r) for r in lifecycle.lives_batch(spark.createDataFrame(rows, "key string, seq long, state string, ts timestamp"), RULES).collect())
    got = run_lives(spark, tmp_path, [rows[:20], rows[10:45], rows[40:]], "replayed")  # with rows that come twice
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[4] for r in got} == {"changed", "fault", "refused"} and all(r[6] == min(5 * 2 ** (r[5] - 1), 480) for r in got if r[4] == "fault")


def test_silence_is_told_once_the_feed_has_gone_on(spark, tmp_path):
    at = datetime(2024, 1, 1)
    early, late = [("x", 1, "a", at), ("y", 2, "a", at)], [("y", 3, "b", at + timedelta(hours=3))]
    last = [("y", 4, "a", at + timedelta(hours=3, minutes=10))]
    got = run_lives(spark, tmp_path, [early, late, last], "silent", stale_s=3600.0)
    assert [r for r in got if r[4] == "stale"] == [("x", 1, "a", "a", "stale", 0, None)]


def test_a_loop_ends_after_idle_cycles(spark):
    rows = spark.createDataFrame(list(enumerate([3, 0, 1, 0, 0, 0, 5])), "n int, changes int")
    assert [r.n for r in lifecycle.idle_stop(rows, "n", "changes", 2).orderBy("n").collect()] == [0, 1, 2, 3, 4]
    assert lifecycle.idle_stop(rows, "n", "changes", 9).count() == 7


def test_amendments_and_moves(spark):
    old = spark.createDataFrame([(1, "new", 1.0), (2, "running", None), (3, "done", 3.0)], "id int, state string, x double")
    got = sinks.amended(old, spark.createDataFrame([(1, 5.0), (3, None), (9, 9.0)], "id int, x double"), "id", ["x"])
    assert sorted((r.id, r.x) for r in got.collect()) == [(1, 5.0), (2, None), (3, 3.0)]
    with pytest.raises(ValueError, match="state"):
        sinks.amended(old, old.select("id", "state"), "id", ["x"])
    changes = spark.createDataFrame([(1, "screening", 7.0), (2, "screened", 8.0), (9, "done", 1.0)], "id int, state string, x double")
    now, refused = sinks.moved(old, changes, "id", "state", cycle.allowed, ["x"])
    assert sorted((r.id, r.state, r.x) for r in now.collect()) == [(1, "screening", 7.0), (2, "running", None), (3, "done", 3.0)]
    assert [tuple(r) for r in refused.collect()] == [(2, "running", "screened")]
    with pytest.raises(ValueError, match="differ"):
        sinks.appended(old, old.drop("x"))


def test_small_rules(spark):
    one = spark.range(1).select(
        *(fv.n_bands(F.lit(e), F.lit(n)).alias(f"b{i}") for i, (e, n) in enumerate([(100, 30), (0, 5), (1000, 4), (7, 2)])),
        *(fv.queue_limits(F.lit(s)).alias(f"l{i}") for i, s in enumerate(["10|20|cpu=64,gres/gpu=2", "||", "x|5|mem=1,cpu=3", ""])),
    ).first()
    assert [one[f"b{i}"] for i in range(4)] == [68, None, 600, 16]
    assert [tuple(one[f"l{i}"]) for i in range(4)] == [(10, 20, 64, 2), (None, None, None, None), (None, 5, 3, None), (None, None, None, None)]


def test_region_share_and_pooled_parity(spark):
    cube = [[20.0, 0.0, 0.0], [0.0, 20.0, 0.0], [0.0, 0.0, 20.0]]
    sites = [("half", 1, "Fe", [0.0, 0.0, 0.0]), ("half", 2, "Fe", [0.5, 0.5, 0.5]), ("half", 3, "Sm", [0.9, 0.0, 0.0]), ("pure", 1, "Fe", [0.1, 0.1, 0.1]), ("none", 1, "Sm", [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(sites, "cell string, site long, kind string, at array<double>")
    cells = spark.createDataFrame([(c, cube) for c in ("half", "pure", "none")], "cell string, lattice array<array<double>>")
    assert {r.cell: (r.n, r.share) for r in periodic.region_share(df, cells, "Fe", 4.0).collect()} == {"half": (2, 0.5), "pure": (1, 1.0), "none": (0, 0.0)}
    points = spark.createDataFrame([("s", "p", ["A", "B", "A"], 1.0, 2.0), ("t", "p", ["A", "B"], 1.0, 2.0), ("t", "q", ["B"], 0.0, 3.0), ("t", "r", ["B"], None, 3.0)], "sys string, label string, el array<string>, a double, b double")
    whole, each = store.pooled_parity(points, "sys", "label", "el", "a", "b")
    assert sorted(map(tuple, whole.collect())) == [("s", 1, 1.0, 1.0), ("t", 2, 2.0, 3.0)] and sorted(map(tuple, each.collect())) == [("A", 1, 1.0, 1.0), ("B", 2, 2.0, 3.0)]
