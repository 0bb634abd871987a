"""Every stage of the corpus pipeline against brute force, on documents with nulls, empty and long texts, repeats, ties and odd columns."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from funnelspark.llm import _spark, pii
from tests.llm.test_llm import edited, filled, leaks, predicted_by_hand, text


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("pipeline"))
    rng = random.Random(21)
    base = [text(rng, n) for n in (60, 90, 400)]
    item = text(rng, 30)
    texts = [*base, base[0], edited(rng, base[1], 1), None, "", "12 34", "a@b.co is my mail " + text(rng, 20), f"{text(rng, 9)} {item} {text(rng, 5)}", "call +1 (988) 555-2485 now", text(rng, 30_000), base[0]]
    rows = [(i, t, ["en", "de", None][i % 3], ["s", "t", None][i % 3], len(t or ""), f"k{i}", 0.5) for i, t in enumerate(texts)]
    rows += [(0, base[0], "en", "s", 1, "again", 0.5), (None, text(rng, 40), "en", None, 2, "no id", 0.5), (3, "another text of the same id " + text(rng, 8), "en", "t", 3, "x", 0.5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, score double").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, rows, item


def asked(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_language_keeps_every_text_with_letters(spark, folder):
    at, rows, _ = folder
    docs = _spark.table(spark, at, "documents")
    out = cp.identify_language(spark, docs, at)
    assert out.columns == docs.columns
    assert asked(out) == sorted((r for r in rows if any(c.isalpha() for c in r[1] or "")), key=str)
    assert cp.identify_language(spark, docs.limit(0), at).count() == 0


def test_language_leaves_out_what_no_language_fits(spark):
    """The rule held against the scores that plain algebra gives; texts of unknown letters go, all others stay."""
    rng = random.Random(24)
    letters = {"aa": "abcdefgh ", "bb": "efghijkl "}
    rows = [(i, "".join(rng.choices(letters[lang], k=60)), lang) for i, lang in enumerate(["aa", "bb"] * 40) if zlib.crc32(str(i).encode()) % 3 != 1]
    odd = [(1000, "中文字符没有人学过这种语言", None), (1001, "ωψχφυτσρ", None), (1002, "abcd efgh", None), (1003, "55", "aa"), (1004, None, "bb")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    score = predicted_by_hand([(i, t, lang if i < 1000 else None) for i, t, lang in rows + odd])
    want = {i for i, (lang, s) in score.items() if lang != "und" and s >= cp.LEAST_SCORE}
    got = {r.doc_id for r in cp.identify_language(spark, docs.filter("doc_id <> 1003 and doc_id <> 1004").unionByName(docs.filter("doc_id > 1002").withColumn("lang", F.lit(None).cast("string"))), "").collect()}
    assert got == want and {1000, 1001, 1003, 1004}.isdisjoint(got) and {r[0] for r in rows} | {1002} <= got
    only = {r.doc_id for r in cp.identify_language(spark, docs, "", wanted=("aa",)).collect()}
    assert only == {i for i in want if score[i][0] == "aa"}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in cp.identify_language(spark, unlabelled, "").collect()} == {r[0] for r in rows} | {1000, 1001, 1002}


def test_near_duplicates_keep_one_of_each_class(spark, folder):
    at, rows, _ = folder
    docs = _spark.table(spark, at, "documents")
    out = cp.drop_near_duplicates(spark, docs, at)
    got = [tuple(r) for r in out.collect()]
    assert out.columns == docs.columns and all(g in rows for g in got)
    kept = sorted((str(r[0]), r[1]) for r in got)
    # of base[0] (0, 3, 12, and 0 again), base[1] and its copy, null and empty texts, one each
    classes = {}
    for r in rows:
        classes.setdefault("" if not r[1] else "base1" if r[0] in (1, 4) else r[1], []).append(r)
    assert len(kept) == len(classes) and all(any((str(r[0]), r[1]) in kept for r in c) for c in classes.values())
    assert {r[0] for r in got if r[1] == rows[0][1]} == {0} and {r[0] for r in got} >= {1, 2} and 4 not in {r[0] for r in got}
    assert cp.drop_near_duplicates(spark, docs.limit(0), at).count() == 0


def test_decontamination_drops_whole_windows(spark, folder):
    at, rows, item = folder
    docs = _spark.table(spark, at, "documents")
    got = asked(cp.drop_contaminated(spark, docs, at))
    assert got == sorted((r for r in rows if not leaks(r[1], [(1, item)])[4]), key=str) and len(got) == len(rows) - 1
    assert cp.drop_contaminated(spark, docs.limit(0), at).count() == 0


def test_personal_data_is_masked(spark, folder):
    at, rows, _ = folder
    docs = _spark.table(spark, at, "documents")
    want = []
    for r in rows:
        t = r[1] and pii.masked(r[1], pii.find(r[1]))
        want.append((r[0], t, *r[2:4], None if t is None else len(t), *r[5:]))
    assert asked(cp.mask_personal_data(spark, docs, at)) == sorted(want, key=str)
    assert any("[EMAIL]" in (w[1] or "") for w in want) and any("[PHONE]" in (w[1] or "") for w in want)
    assert cp.mask_personal_data(spark, docs.limit(0), at).count() == 0


def test_mixing_takes_the_targets(spark, folder):
    at, rows, _ = folder
    out = cp.mix_sources(spark, _spark.table(spark, at, "documents"), at).collect()
    sizes = {s: sum(len((r[1] or "").split()) for r in rows if r[3] == s) for s in ("s", "t", None)}
    goal = dict(zip(sizes, filled(list(sizes.values()), [5, 2, 1]), strict=True))
    assert len(out) == len(rows) and all(abs(sum(r.taken for r in out if r.source == s) - goal[s]) <= 1 for s in sizes)


def test_run_applies_all_stages(spark, folder):
    at, rows, _ = folder
    out = cp.run(spark, at)
    docs = _spark.table(spark, at, "documents")
    for _, stage in cp.STAGES:
        docs = _spark.cut(stage(spark, docs, at), "stage")
    assert asked(out.select("doc_id", "taken")) == asked(docs.select("doc_id", "taken"))
    ids = [r.doc_id for r in out.collect()]
    assert 9 not in ids and 4 not in ids and 5 not in ids and {0, 1, 2, 8, 10, 11} <= set(ids)


def test_columns_of_any_name_pass(spark, folder):
    """Columns named like those that the operators make."""
    at, _, _ = folder
    docs = _spark.table(spark, at, "documents").withColumns({"lang_pred": F.lit("x"), "class_id": F.lit(1), "_id": F.lit(2), "words": F.lit("w"), "c0": F.lit(3), "contaminated": F.lit(True)})
    for _, stage in cp.STAGES[:-1]:
        out = _spark.cut(stage(spark, docs, at), "stage")
        assert out.columns == docs.columns
        docs = out
    assert docs.count() > 5
