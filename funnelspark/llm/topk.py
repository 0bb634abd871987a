"""Exact top-k by inner product: Fagin's threshold algorithm over sorted lists of every dimension, in blocks.

Components become ``floor(256 * x)``. Candidates are dealt by hash to blocks of about ``BLOCK`` vectors and queries to
groups of about ``QUERIES``; a block meets a group in one task, where the candidates' components are sorted once by
dimension. A query walks all lists at the same depth from the end that favours it, scoring what it meets; no unseen
candidate can score above the sum over dimensions of query component times list value at that depth, and the walk stops
once that bound is below the k-th best score (at equality it goes on: a smaller id may still tie). The depth grows
geometrically, so a query whose lists do not separate costs one pass over its block.

Where there are several blocks, every query meets one of them first; its k-th best score there is the least that counts in
all others, so walks there end by it too and candidates below it aren't handed on. Blocks' lists of k are merged by a window
that keeps k rows a query.

Scores are exact: where a block's products could pass 2 ** 53 they are summed as whole numbers of any size. Scores beyond a
long are ranked by their true value and shown as the greatest or least long.

Nulls: vectors that are null or hold null or non-finite components, and rows of null id, take no part; an empty vector does,
and scores 0. Shorter vectors count as padded with zeros. Rows of one id are candidates each for themselves; a query's own row
is one of the candidates' rows of its id and vector, so other rows of its id are candidates for it. A query row that repeats
is searched once and answered as often. Empty tables give an empty one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.llm._spark import cut

K, BLOCK, QUERIES, FIRST_DEPTH = 5, 8_000, 5_000, 8
EXACT = 2.0**53
LEAST, MOST = -(2**63), 2**63 - 1


def usable(embedding: Column) -> Column:
    """The components as doubles; null where the vector takes no part."""
    x = embedding.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, x)


def threshold_search(q: np.ndarray, x: np.ndarray, ids: np.ndarray, order: np.ndarray, own: int, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the k best of x for q of those that score floor at least, and how many were scored; order: each
    dimension's rows by falling component; own: the query's own row in x, or -1."""
    n, d = x.shape
    dims = np.flatnonzero(q)
    seen = np.zeros(n, dtype=bool)
    best_id, best = np.zeros(0, dtype=np.int64), np.zeros(0)
    walk = [order[:, j] if q[j] > 0 else order[::-1, j] for j in dims]
    top, depth, met = 0, min(FIRST_DEPTH, n), 0
    while True:
        if depth * max(1, len(dims)) >= 2 * n or not len(dims):
            depth = n
            new = np.flatnonzero(~seen)
        else:
            new = np.unique(np.concatenate([w[top:depth] for w in walk]))
            new = new[~seen[new]]
        seen[new] = True
        met += len(new)
        new = new[new != own]
        scores = x[new] @ q
        new, scores = new[scores >= floor], scores[scores >= floor]
        best_id, best = np.concatenate((best_id, ids[new])), np.concatenate((best, scores))
        if len(best) > k:
            edge = np.partition(best, len(best) - k)[len(best) - k]
            keep = np.flatnonzero(best >= edge)
            keep = keep[np.lexsort((best_id[keep], -best[keep]))[:k]]
            best_id, best = best_id[keep], best[keep]
        if depth >= n:
            break
        bound = sum(q[j] * x[w[depth - 1], j] for j, w in zip(dims, walk, strict=True))
        if bound < floor or len(best) >= k and bound < best.min():
            break
        top, depth = depth, min(n, 4 * depth)
    at = np.lexsort((best_id, -best))[:k]
    return best_id[at], best[at], met


def _whole(v: float) -> int:
    """floor(256 * v) without overflow: beyond 2 ** 53 a double is whole."""
    return int(v) * 256 if abs(v) >= EXACT else int(np.floor(v * 256))


def exact_search(q: list[int], x: list[list[int]], ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """(id, score) of the k best in whole numbers of any size, but for row own."""
    scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), int(i)) for j, (i, v) in enumerate(zip(ids, x, strict=True)) if j != own)
    return [(i, -s) for s, i in scored[:k]]


def _matrix(vectors: pd.Series, d: int) -> np.ndarray:
    out = np.zeros((len(vectors), d))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _search(k: int) -> callable:
    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, Decimal]] = []
        if len(candidates) and len(queries):
            d = max(candidates.v.map(len).max(), queries.v.map(len).max())
            ids, asked = candidates.id.to_numpy(), _matrix(queries.v, d)
            raw = _matrix(candidates.v, d)
            large = np.abs(raw).max(initial=0)
            with np.errstate(over="ignore"):
                x = np.floor(raw * 256)
                order = np.argsort(-x, axis=0, kind="stable").astype(np.int32)
            plain = None
            rows: dict[int, list[int]] = {}
            for j, i in enumerate(ids):
                rows.setdefault(i, []).append(j)
            for name, mark, floor, q, v in zip(queries.id, queries.mark, queries.floor, asked, queries.v, strict=True):
                own = next((j for j in rows.get(name, ()) if np.array_equal(candidates.v.iat[j], v)), -1)
                if large < EXACT / 256 and np.abs(q).max(initial=0) < EXACT / 256 and np.abs(np.floor(q * 256)).sum() * (256 * large + 1) < EXACT:
                    low = -np.inf if floor is None else float(floor)
                    found, scores, _ = threshold_search(np.floor(q * 256), x, ids, order, own, k, low)
                    out += [(name, mark, i, Decimal(int(s))) for i, s in zip(found, scores, strict=True)]
                else:
                    plain = plain or [[_whole(v) for v in row] for row in raw]
                    out += [(name, mark, i, Decimal(s)) for i, s in exact_search([_whole(v) for v in q], plain, ids, own, k)]
        # scores travel as text that sorts by value: doubles can't hold them and decimals only 38 digits
        return pd.DataFrame([(q, m, i, str(s)) for q, m, i, s in out], columns=["query_id", "mark", "vec_id", "score"]).astype({"query_id": "int64", "mark": "int64", "vec_id": "int64", "score": "object"})

    return search


def sortable(score: Column) -> Column:
    """Whole numbers written in digits as text whose order is theirs: sign, length, digits (of negative ones complemented)."""
    digits = F.regexp_replace(score, "-", "")
    size = F.length(digits)
    below = F.concat(F.lit("0"), F.lpad((9999 - size).cast("string"), 4, "0"), F.translate(digits, "0123456789", "9876543210"))
    return F.when(F.startswith(score, F.lit("-")), below).otherwise(F.concat(F.lit("1"), F.lpad(size.cast("string"), 4, "0"), digits))


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query_id", "mark").orderBy(F.desc("sorted"), "vec_id"))
    return found.withColumn("sorted", sortable(F.col("score"))).withColumn("rank", rank).filter(F.col("rank") <= k).drop("sorted")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, group: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of vectors(vec_id, embedding) for each of queries(vec_id, embedding)."""
    part = lambda df: df.select(F.col("vec_id").cast("long").alias("id"), usable(F.col("embedding")).alias("v")).filter("id is not null and v is not null")
    rows, asked = part(vectors), part(queries).withColumn("mark", F.xxhash64("v")).groupBy("id", "mark").agg(F.max("v").alias("v"), F.count("*").alias("times"))
    asked = cut(asked, "asked")
    blocks, groups = (1 + f.count() // size for f, size in ((rows, block), (asked, group)))
    each = lambda first, n: F.explode(F.sequence(F.lit(first), F.lit(n - 1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
    often, asked = asked.filter("times > 1").select("id", "mark", "times"), asked.drop("times").withColumn("group", F.pmod(F.xxhash64("id", "mark"), F.lit(groups)).cast("int"))

    def found(rows: DataFrame, asked: DataFrame) -> DataFrame:
        rows = rows.withColumn("group", each(0, groups))
        return rows.groupBy("block", "group").cogroup(asked.groupBy("block", "group")).applyInPandas(_search(k), "query_id long, mark long, vec_id long, score string")

    none = F.lit(None).cast("string").alias("floor")
    first = found(rows.filter("block = 0"), asked.select("*", F.lit(0).alias("block"), none))
    if blocks > 1:
        first = cut(first, "first")
        floors = _best(first, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), "mark", F.col("score").alias("floor"))
        rest = asked.join(floors, ["id", "mark"], "left").withColumn("block", each(1, blocks))
        first = first.unionByName(found(rows.filter("block > 0"), rest))
    score = F.expr("try_cast(score as bigint)")
    shown = F.coalesce(score, F.when(F.startswith("score", F.lit("-")), F.lit(LEAST)).otherwise(F.lit(MOST)))
    best = _best(first, k).select(F.col("query_id").alias("id"), "mark", "rank", "vec_id", shown.alias("score"))
    again = best.join(often, ["id", "mark"]).withColumn("_", F.explode(F.sequence(F.lit(2).cast("long"), "times")))  # query rows that repeat
    return best.drop("mark").unionByName(again.select("id", "rank", "vec_id", "score")).withColumnRenamed("id", "query_id")
