import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from funnelspark.llm import near_dedup


def edited(words, n, rng, tag):
    """words with n of them replaced, far enough from each other that each takes five runs with it."""
    out = list(words)
    for k, at in enumerate(rng.sample(range(0, len(words) // 6), n)):
        out[at * 6 + 2] = f"{tag}x{k}"
    return out


def star(rng):
    base = [f"w{i}" for i in range(300)]
    return [base, *(edited(base, 5, rng, f"c{i}") for i in range(400))]


def crowd(rng):
    """Pairs of near copies, all of them of one base; a pair is nearer to itself than to any other."""
    base = [f"w{i}" for i in range(300)]
    firsts = [edited(base, 9, rng, f"p{i}") for i in range(150)]
    return [x for i, f in enumerate(firsts) for x in (f, [*f[:-2], f"q{i}", f[-1]])]


def all_pairs(texts, weights):
    """Least index of the class of each text, by comparisons of all pairs."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    runs = [near_dedup._unpacked(v.as_py()) for b in near_dedup._vectors(iter([batch])) for v in b.column(1)]
    label = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if label[i] != label[j] and near_dedup.similarity(runs[i], runs[j], weights) >= near_dedup.THRESHOLD:
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label]
    return label


@pytest.mark.parametrize("group", [star, crowd])
def test_large_groups_equal_all_pairs(spark, group):
    texts = [" ".join(x) for x in group(random.Random(7))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == all_pairs(texts, near_dedup.idf_weights(docs))


def test_blocks_equal_similarity():
    rng = np.random.default_rng(3)
    w = rng.random(1 << near_dedup.DF_BITS).astype(np.float32) + 1
    sets = [np.sort(rng.integers(0, 40, 60)).astype(np.uint64) for _ in range(30)]
    got = near_dedup.block_links(*([near_dedup._tokens(x) for x in half] for half in (sets[:12], sets[12:])), w, 0.45)
    assert got.any() and not got.all()
    assert got.tolist() == [[near_dedup.similarity(a, b, w) >= 0.45 for b in sets[12:]] for a in sets[:12]]


def test_blocks_are_cut_by_bytes_too(spark, monkeypatch):
    """Buckets of few but long texts are compared in several blocks, none with much more than PART_BYTES of vectors on a side."""
    texts = [" ".join(x) for x in crowd(random.Random(8))[:60]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    seen, plain = [], near_dedup.blocks

    def watched(*a):
        out = plain(*a)
        seen.append(out.groupBy("bucket", "kind", "i", "j", "left").agg({"vector": "count"}).agg({"count(vector)": "max"}).first()[0])
        return out

    monkeypatch.setattr(near_dedup, "blocks", watched)
    monkeypatch.setattr(near_dedup, "PART_BYTES", 5 * 300 * 6)
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()} == want
    assert seen[0] is None or seen[0] < 30
