"""Repeated passages against brute force; the index itself against all pairs of suffixes."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelspark.llm import queries, run_index


def brute(texts, length):
    """For each text its bytes, the runs of removed bytes and the bytes left."""
    raws = [(t or "").encode() for t in texts]
    times = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if times[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = [[i, i] for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1])]
        for s in spans:
            s[1] = next((j for j in range(s[0], len(r)) if not gone[j]), len(r))
        out.append((len(r), tuple(map(tuple, spans)), bytes(b for b, g in zip(r, gone, strict=True) if not g)))
    return out


def found(spark, rows, length, **sizes):
    docs = spark.createDataFrame([(i, t, 1, "x", [2]) for i, t in rows], "doc_id long, text string, i int, t string, starts array<int>")
    got = run_index.remove_repeats(docs, length, **sizes).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in got)


def expected(rows, length):
    return sorted((-1 if i is None else i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], length), strict=True))


def prose(rng, n, letters="abcdefgh éß"):
    return "".join(rng.choice(letters) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passages = [prose(rng, n) for n in (60, 45, 200, 41)]
    texts = [prose(rng, rng.randrange(0, 300)) for _ in range(20)]
    texts += [prose(rng, rng.randrange(30)) + rng.choice(passages) + prose(rng, rng.randrange(60)) for _ in range(30)]
    texts += [passages[2] * 3, "a" * 500, "ab" * 200, passages[0][:39], passages[0][:40], passages[0][1:41], "", None, "é" * 70, "né" * 60]
    whole = prose(rng, 700)
    texts += [whole, whole, whole[:350] + "!" + whole[351:], whole[:200] + whole[260:], whole[100:600]]
    rows = list(enumerate(texts))
    rows += [(None, whole), (None, None), (3, texts[3]), (3, texts[3]), (4, texts[5])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("length,gram,sizes", [(40, 8, {}), (40, 8, {"shard": 600}), (40, 8, {"hot": 400, "shard": 300}), (40, 8, {"hot": 0}), (64, 16, {"shard": 2000}), (9, 9, {})])
def test_removed_bytes_are_those_of_repeated_strings(spark, length, gram, sizes):
    rows = corpus(length + gram)
    assert found(spark, rows, length, gram=gram, **sizes) == expected(rows, length)


def test_long_texts_go_in_pieces(spark, monkeypatch):
    rng = random.Random(5)
    whole = prose(rng, 3000)
    rows = [(1, whole), (2, whole[500:2500]), (3, prose(rng, 900) + whole[2000:2300]), (4, "z" * 2000)]
    assert found(spark, rows, 50) == expected(rows, 50)
    texts = [t.encode() for _, t in rows]
    monkeypatch.setattr(run_index, "PIECE", 256)
    monkeypatch.setattr(run_index, "LONGEST", 100)
    for raw in texts:  # the pieces' regions hold every start once
        data = np.frombuffer(raw, dtype=np.uint8)
        starts = []
        for part, ends, place in run_index._pieces(data, np.array([0, len(data)]), 50):
            _, a, n, *_ = run_index.regions(part, ends, 50, 16)
            assert (n <= 100).all()
            starts += [x for f, k in zip((a + place).tolist(), n.tolist(), strict=True) for x in range(f, f + k)]
        assert starts == list(range(len(raw) - 49))


def test_empty_tables_and_texts(spark):
    assert found(spark, [], 40) == []
    assert found(spark, [(1, None), (2, ""), (3, "short")], 40) == [(1, 0, (), b""), (2, 0, (), b""), (3, 5, (), b"short")]


@pytest.mark.parametrize("n,letters", [(1, 1), (2, 1), (50, 1), (300, 2), (400, 5)])
def test_index_statistics(n, letters):
    rng = random.Random(n)
    parts = ["".join(chr(97 + rng.randrange(letters)) for _ in range(n)) for _ in range(2)]
    parts.append(parts[0])
    text = "\0".join(parts).encode() + b"\0"
    index = run_index.RunIndex(np.frombuffer(text, dtype=np.uint8))
    order = run_index.suffix_array(np.frombuffer(text, dtype=np.uint8)).tolist()
    assert order == sorted(range(len(text)), key=lambda i: text[i:])
    assert index.lengths.sum() == len(text) and (index.symbols[1:] != index.symbols[:-1]).all()

    def common(a, b):
        k = 0
        while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        return k

    assert index.statistics().tolist() == [max(common(i, j) for j in range(len(text)) if j != i) for i in range(len(text))]


def test_large_texts_sort_alike():
    """Beyond 2**21 bytes two ranks and a place no longer fit one word."""
    rng = np.random.default_rng(1)
    block = rng.integers(1, 5, 1_100_000, dtype=np.uint8)
    text = np.concatenate((block, block[:1_050_000], np.zeros(1, dtype=np.uint8)))
    order, raw = run_index.suffix_array(text), text.tobytes()
    assert np.array_equal(np.sort(order), np.arange(len(text)))
    for k in rng.integers(1, len(text), 3000).tolist():
        a, b = order[k - 1], order[k]
        size = 64
        while raw[a : a + size] == raw[b : b + size]:
            size *= 2
        assert raw[a : a + size] < raw[b : b + size]


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_query_is_the_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = sorted((i.doc_id, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, (n, spans, kept) in zip(docs, brute([r.text for r in docs], 400), strict=True))
    got = queries.op11_run_index(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def brute_words(rows, k):
    """For each row the number of its words in a run of k words that a row of another id or text also has."""
    split = [re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode()) for _, t in rows]
    holders = {}
    for row, w in zip(rows, split, strict=True):
        for j in range(len(w) - k + 1):
            holders.setdefault(tuple(w[j : j + k]), set()).add(row)
    return [sum(any(len(holders[tuple(w[j : j + k])]) > 1 for j in range(max(0, p - k + 1), min(p, len(w) - k) + 1)) for p in range(len(w))) for w in split]


def worded_corpus(seed, k):
    rng = random.Random(seed)
    vocabulary = [prose(rng, rng.randrange(1, 8)).replace(" ", "_") or "x" for _ in range(40)]
    talk = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [talk(n) for n in (k, k - 1, k + 1, 3 * k)]
    texts = [talk(rng.randrange(0, 6 * k)) for _ in range(20)]
    texts += [talk(rng.randrange(k)) + rng.choice(passages) + talk(rng.randrange(2 * k)) for _ in range(30)]
    own = talk(2 * k)
    texts += [own + talk(3) + own, ["a"] * 9 * k, ["a"] * k, ["a"] * (k - 1), [], passages[3][: k + 2], passages[3][k:]]
    rows = [(i, "".join(w + rng.choice([" ", "\n", " \t"]) for w in t)) for i, t in enumerate(texts)]
    rows += [(None, rows[3][1]), (None, None), (5, rows[5][1]), (5, rows[5][1]), (6, rows[22][1]), (90, "\0 \x1f" * 2 * k), (91, "\0\n\x1f " * k)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,gram,sizes", [(12, 3, {}), (5, 5, {"shard": 100}), (12, 4, {"hot": 0}), (12, 4, {"hot": 60, "shard": 200}), (51, 8, {})])
def test_passages_of_words_across_documents(spark, k, gram, sizes):
    rows = worded_corpus(k, k)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    named = docs.distinct().withColumns({"i": F.xxhash64("doc_id"), "t": F.xxhash64("text", F.length("text"))})
    got = named.join(run_index.repeated_passages(docs, k, gram, **sizes), ["i", "t"], "left").select("doc_id", "text", F.coalesce("n_repeated_words", F.lit(0)).alias("n")).collect()
    assert {(r.doc_id, r.text): r.n for r in got} == dict(zip(rows, brute_words(rows, k), strict=True))


def test_words_of_long_texts_go_in_pieces(monkeypatch):
    rng = random.Random(8)
    texts = [prose(rng, 3000).encode(), b"x" * 900, b" " * 700, b"x" * 300 + b" " + b"y" * 500]
    whole = [run_index._worded(np.frombuffer(t, dtype=np.uint8), np.array([0, len(t)])) for t in texts]
    monkeypatch.setattr(run_index, "PIECE", 256)
    for t, (found, ends) in zip(texts, whole, strict=True):
        again, bounds = run_index._worded(np.frombuffer(t, dtype=np.uint8), np.array([0, len(t)]))
        assert len(found) == len(t.split()) and np.array_equal(found, again) and np.array_equal(ends, bounds)


def test_query_counts_words_of_passages_too_short_to_be_removed(spark, tmp_path):
    """Passages of 51 words that repeat across documents are caught though they have fewer than 400 bytes."""
    rng = random.Random(3)
    talk = lambda n: " ".join(prose(rng, 5, "abcdefgh") for _ in range(n))
    passage = talk(51)
    assert len(passage.encode()) < 400
    texts = [f"{talk(80)} {passage} {talk(60)}", f"{talk(10)}\n{passage}", talk(200), None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.n_removed, r.n_repeated_words) for r in queries.op11_run_index(spark, str(tmp_path)).collect())
    assert got == [(0, 0, 51), (1, 0, 51), (2, 0, 0), (3, 0, 0)]
