"""The Merkle manifest and the filter audit against their SQL and plain loops, with nulls, repeats, ties and odd columns."""

import hashlib
import itertools
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from funnelspark.llm import filter_audit, manifest, queries


def rows(seed, n, langs=("en", "de", None, "", "é", "zz")):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        t = rng.choice([None, "", "Same TEXT", "x" * rng.randrange(4), " ".join(rng.choice(["Ab", "cd", "é", "$", "EF"]) for _ in range(rng.randrange(120)))])
        out.append((rng.choice([i, i, i, None, 7]), t, rng.choice(langs), rng.choice(["s", "t", "", None]), rng.choice([None, 5, len(t or "")])))
    return out + out[:3]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, data):
    """With columns whose names clash with those that the operators make."""
    docs = spark.createDataFrame(data, SCHEMA)
    for c in ("g", "pos", "n", "digest", "part", "mask", "fingerprint", "key", "good"):
        docs = docs.withColumn(c, F.lit("clash"))
    return docs


def saved(tmp_path, spark, data, labels=()):
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    return con


def same(con, got, sql):
    columns = ", ".join(got.columns)
    return sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, con.sql(f"SELECT {columns} FROM ({sql})").fetchall()))


@pytest.mark.parametrize("n,langs", [(150, ("en", "de", None, "", "é", "zz")), (90, tuple(f"l{i}" for i in range(70))), (1, ("en",)), (600, ("en",)), (65, (None,))])
def test_manifest_is_its_sql(spark, tmp_path, n, langs):
    data = rows(n, n, langs)
    con = saved(tmp_path, spark, data)
    got = queries.op12_manifest(spark, str(tmp_path))
    assert got.count() == len(data) and same(con, got, queries.OP12_SQL)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def test_manifest_by_hand(spark):
    """Ten leaves of one group, two of another: runs of eight and two, then the subroots, by plain hashing."""
    data = [(i, f"T{i}", "b" if i < 10 else "a", "s", 2) for i in range(12)]
    leaf = {i: h(*(f"{len(str(v).encode())}:{v}" for v in (i, "s", lang, 2, t))) for i, t, lang, *_ in data}
    runs = h(*(leaf[i] for i in range(8))), h(leaf[8], leaf[9])
    b, a = h(*runs), h(leaf[10], leaf[11])
    root = h(a, b)
    got = {r.doc_id: r for r in manifest.manifest(frame(spark, data)).withColumn("all", manifest.siblings(F.col("proof"))).collect()}
    assert {r.root for r in got.values()} == {root} and got[3].subroot == b and got[11].subroot == a
    assert got[3].all == "".join(leaf[i] for i in range(8) if i != 3) + runs[1] + a
    assert got[9].all == leaf[8] + runs[0] + a and got[10].all == leaf[11] + b


def test_tampering_shows(spark):
    data = [(i, t, "en", "s", 3) for i, t in enumerate(["Abc", "abc", None, "ÄB", "x Y"] * 20)]
    docs = frame(spark, data)
    text = F.col("text")
    found = manifest.manifest(docs, F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, manifest.lowered(text)).otherwise(text))
    found = found.withColumn("folded", manifest.folded(F.col("shown"), F.col("proof"))).collect()
    broken = {r.doc_id for r in found if r.folded != r.root}
    assert broken == {i for i, t, *_ in data if zlib.crc32(str(i).encode()) % 3 == 0 and t and any("A" <= c <= "Z" for c in t)}
    untouched = manifest.manifest(docs)
    assert untouched.filter(manifest.folded(F.col("shown"), F.col("proof")) != F.col("root")).count() == 0


def test_manifest_of_nothing(spark):
    assert manifest.manifest(frame(spark, [])).collect() == []


LABELS = [(i, i % 2, (i // 2) % 2) for i in range(0, 60, 3)] + [(3, 1, 1), (7, None, 1), (None, 1, 1)]


@pytest.mark.parametrize("held", [1 << 25, 300])
def test_audit_is_its_sql(spark, tmp_path, monkeypatch, held):
    monkeypatch.setattr(filter_audit, "HELD", held)
    long = " ".join(f"w{i} {i % 9} A" for i in range(40))
    data = rows(9, 120) + [(i, long, "en", f"s{i % 3}", 1) for i in range(200, 260)] + [(1, long, "en", None, 1), (205, long + "$", "en", "s1", 1)]
    random.Random(2).shuffle(data)
    con = saved(tmp_path, spark, data, LABELS)
    got = queries.op13_filter_audit(spark, str(tmp_path))
    assert got.count() == 600 * len({s or "" for *_, s, _ in data}) and same(con, got, queries.OP13_SQL)


def test_audit_by_applying_the_filters(spark):
    data = [(i, t, "en", "s", 1) for i, t in enumerate(["a b c d " * 20, "A b", "x $", " ".join(f"w{i}" for i in range(60)), "x $", None, "", "A b"])]
    raws = [(i, t or "") for i, t, *_ in data]
    fails = {
        "A": lambda i, t: len(t.split()) < 50,
        "B": lambda i, t: 100 * len(set(t.split())) < 65 * len(t.split()),
        "C": lambda i, t: 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
        "D": lambda i, t: any(c in "#$%&*|" for c in t),
        "E": lambda i, t: any(u == t and j < i for j, u in raws),
    }
    got = {(r.filter_order, r.step): r for r in filter_audit.audit(frame(spark, data), spark.createDataFrame([(1, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == 600
    for order in itertools.permutations("ABCDE"):
        left = raws
        for step, f in enumerate(order, 1):
            gone = [x for x in left if fails[f](*x)]
            left = [x for x in left if not fails[f](*x)]
            r = got["".join(order), step]
            assert (r.kept, r.removed, r.redundant) == (len(left), len(gone), sum(fails[f](*x) for x in raws) - len(gone))
            assert (r.good_lost, r.toxic_lost) == (sum(i == 1 for i, _ in gone), sum(i == 4 for i, _ in gone))
            assert r.unique_fails == sum(fails[f](*x) and sum(g(*x) for g in fails.values()) == 1 for x in raws)
    for f in "ABCDE":
        every = {r.shapley for (order, step), r in got.items() if order[step - 1] == f}
        assert every == {sum(r.removed for (order, step), r in got.items() if order[step - 1] == f)}


def test_equal_fingerprints_of_different_texts_stay_apart():
    chains = filter_audit.Chains()
    assert chains.add(1, b"x", 0, 5, {"p": 1}) is None and chains.add(1, b"y", 0, 9, {"p": 1}) is None
    assert chains.add(1, b"x", 0, 7, {"p": 2}) == (7, 0, {"p": 2})
    assert chains.add(1, b"x", 0, 5, {"q": 1}) is None
    assert chains.add(1, b"x", 0, 2, {"q": 1}) == (5, 0, {"p": 1, "q": 1})
    assert sorted(chains.least()) == [(1, b"x", 0, 2, {"q": 1}), (1, b"y", 0, 9, {"p": 1})]


def test_long_texts_are_counted_alike(monkeypatch):
    raw = "a b\tb\x0bc d \x1f e\r\n".encode() * 7
    want = filter_audit.word_counts(raw)
    monkeypatch.setattr(filter_audit, "LONG", 3)
    assert filter_audit.word_counts(raw) == want == (len(raw.split()), len(set(raw.split())))


def test_audit_of_nothing(spark):
    assert filter_audit.audit(frame(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []
