import itertools
import random
import re

import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    """Short and long texts, one without n_chars, one without words twice; exact and near copies of each."""
    rng = random.Random(5)
    rows = []
    for size in (40, 40, 400, 400):
        base = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(size)]
        rows += [base, base[::-1], [*base[:-2], "other"], [*base[2:], "more"], base]
    rows = [" ".join(x) for x in rows] + ["1 2 3", "4 5 6"]
    rows = [(i, x, ("en", "de")[i % 5 == 4], None if i == 7 else len(x)) for i, x in enumerate(rows)]
    folder = tmp_path_factory.mktemp("whole")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    sets = {i: (lang, frozenset(re.split("[^a-z]+", x.lower())) - {""}) for i, x, lang, _ in rows}
    alike = lambda a, b: a[0] == b[0] and a[1] and len(a[1] & b[1]) >= 0.8 * len(a[1] | b[1])
    return str(folder), sets, {(i, j) for i, j in itertools.combinations(sorted(sets), 2) if alike(sets[i], sets[j])}


def test_pairs_of_long_documents(spark, documents):
    folder, sets, pairs = documents
    got = entry.queries()["near_dup_pairs"](spark, folder).collect()
    # copies are rows with the first of them; spread out again, the rows are all pairs
    first = {r.id_b: r.id_a for r in got if sets[r.id_a] == sets[r.id_b]}
    own = lambda i: first.get(i, i)
    linked = {(r.id_a, r.id_b) for r in got if sets[r.id_a] != sets[r.id_b]}
    assert all(own(i) == min(j for j in sets if sets[j] == sets[i]) for i in sets if sets[i][1]) and all(own(a) == a and own(b) == b for a, b in linked)
    spread = {(i, j) for i, j in itertools.combinations(sorted(sets), 2) if own(i) == own(j) or tuple(sorted((own(i), own(j)))) in linked}
    assert spread == pairs and len(got) == len(linked) + len(first) < len(pairs)
    assert all(r.n_common == len(sets[r.id_a][1] & sets[r.id_b][1]) for r in got)


def test_greedy_over_all_documents(spark, documents):
    folder, sets, pairs = documents
    kept, want = [], {}
    for i in sorted(sets):
        want[i] = next((k for k in kept if (k, i) in pairs), None)
        kept += [i] if want[i] is None else []
    got = entry.queries()["greedy_dedup"](spark, folder).collect()
    assert len(got) == len(sets) and {r.id: (r.kept, r.duplicate_of) for r in got} == {i: (of is None, of) for i, of in want.items()}
