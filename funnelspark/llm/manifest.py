"""A Merkle manifest of a dataset: a digest of every row, a tree for each group, one root, and a proof for every row.

H is lower-case hexadecimal sha256 of its inputs' concatenation, digests as hexadecimal text. A leaf is H of a row's fields,
each ``-`` if null, else its number of UTF-8 bytes, ``:`` and its value, so no two rows run together. In each group leaves
ascend by the key; every ``fanout`` neighbours (the last run may be shorter, even one) become their H, level by level, until
one is left, the subroot. The subroots, by group (null first, bytewise), are the leaves of one more such tree, whose root it is.

Trees are built bottom-up: a level's runs, of at most ``fanout`` rows each, are grouped by their parent's place and written to
the shared folder. Proofs are pushed top-down: the root's is empty, and each level joins its runs to its parents' proofs;
each child of a run puts its own siblings in front of what its parent inherited. So what is shuffled at each level is a row
for each run, an eighth of the level, and nothing is gathered beyond a run.

Places come from a range sort by group, key and leaf: the rows before a part's are counted by part, so a group of any size
is spread over all tasks. Levels are as many as the logarithm of the largest group.

Nulls: any field may be null; a null group is a group of its own, a null key goes first. Rows that repeat are leaves of
their own; rows of one key are ordered by their leaves, so equal ones are interchangeable. An empty table has no root and no
rows. Columns that aren't fields are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.llm._spark import cut

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def h(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it goes into a leaf."""
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(fields: dict[str, Column]) -> Column:
    return h(*map(field, fields.values()))


def lowered(text: Column) -> Column:
    """A-Z in lower case; lower() is the fast way where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def placed(leaves: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``pos``, the place from 0 of a row in its group ``g`` by the columns ``by``, and ``n``, the group's rows."""
    spread = leaves.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("g", *by, "tie").withColumn("part", F.spark_partition_id())
    spread = cut(spread, "leaves")
    counts = spread.groupBy("g", "part").agg(F.count("*").alias("own"))
    before = F.sum("own").over(W.partitionBy("g").orderBy("part").rowsBetween(W.unboundedPreceding, 0)) - F.col("own")
    counts = counts.select("g", "part", before.alias("before"), F.sum("own").over(W.partitionBy("g")).alias("n"))
    own = F.row_number().over(W.partitionBy("g", "part").orderBy(*by, "tie"))
    out = spread.withColumn("own", own).join(counts, ["g", "part"])
    return out.withColumn("pos", F.col("before") + F.col("own") - 1).drop("tie", "part", "own", "before")


def levels(nodes: DataFrame, fanout: int, payload: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """Runs by level, from the leaves up, and the roots: g, level, digest, of nodes(g, pos, n, digest and a payload).

    A run is g, at (its parent's place), n (nodes of the parents' level) and its children in order."""
    runs, roots, largest = [], nodes.filter("n = 1").select("g", F.lit(0).alias("level"), "digest"), nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        child = F.struct("pos", "digest", *(payload if not runs else []))
        grouped = nodes.filter("n > 1").groupBy("g", F.floor(F.col("pos") / fanout).alias("at")).agg(F.max(F.ceil(F.col("n") / fanout)).alias("n"), F.array_sort(F.collect_list(child)).alias("children"))
        runs.append(cut(grouped, f"{name}-{len(runs)}"))
        nodes = runs[-1].select("g", F.col("at").alias("pos"), "n", F.unhex(h(*_digests(F.col("children")))).alias("digest"))
        roots = roots.unionByName(nodes.filter("n = 1").select("g", F.lit(len(runs)).alias("level"), "digest"))
        largest = -(-largest // fanout)
    return runs, roots


def _digests(children: Column) -> tuple[Column]:
    """The children's digests as one text."""
    return (F.array_join(F.transform(children, lambda c: _text(c["digest"])), ""),)


def children(runs: DataFrame, proofs: DataFrame, payload: list[str]) -> DataFrame:
    """The nodes of a level with their proofs: g, pos, payload and what proofs(g, pos, proof ..) carries besides."""
    carried = [c for c in proofs.columns if c not in ("g", "pos", "proof")]
    met = runs.join(proofs.withColumnRenamed("pos", "at"), ["g", "at"])
    every = met.select("g", *carried, "proof", F.transform("children", lambda c: c["digest"]).alias("digests"), F.posexplode("children").alias("i", "child"))
    joined = lambda part: F.unhex(F.array_join(F.transform(part, _text), ""))
    own = F.struct(joined(F.slice("digests", F.lit(1), F.col("i"))).alias("left"), joined(F.slice("digests", F.col("i") + 2, F.size("digests"))).alias("right"))
    return every.select("g", F.col("child.pos").alias("pos"), *(F.col(f"child.{c}").alias(c) for c in payload), *carried, F.concat(F.array(own), "proof").alias("proof"))


def pushed(runs: list[DataFrame], tops: DataFrame, payload: list[str], leaves: DataFrame) -> DataFrame:
    """The leaves with proofs, from those of the roots: tops(g, level, proof ..)."""
    at = lambda level: tops.filter(F.col("level") == level).select("g", F.lit(0).cast("long").alias("pos"), *(c for c in tops.columns if c not in ("g", "level")))
    proofs = None
    for level in range(len(runs), 0, -1):
        own = at(level)
        proofs = own if proofs is None else own.unionByName(proofs.select(own.columns))
        proofs = children(runs[level - 1], proofs, payload if level == 1 else [])
    lone = leaves.filter("n = 1").select("g", "pos", *payload).join(at(0).drop("pos"), "g")
    return lone if proofs is None else proofs.unionByName(lone.select(proofs.columns))


def manifest(docs: DataFrame, tampered: Column | None = None, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id", fanout: int = FANOUT) -> DataFrame:
    """doc_id (the key), leaf, subroot, root, proof, shown: a row for each row of docs.

    proof is an array of (left, right) from the leaf's level to the root's: the siblings' digests, as bytes, on either side.
    shown is the leaf of the row as it may have been altered since (``tampered``: its text, for example with A-Z lowered), to be
    held against the proof by ``folded``; without it the leaf itself."""
    plain = {c: F.col(f"`{c}`") for c in fields}
    shown = leaf(plain) if tampered is None else F.when(tampered.eqNullSafe(plain["text"]), F.lit(None)).otherwise(leaf(plain | {"text": tampered}))
    g = F.coalesce(F.concat(F.lit("="), plain[group]), F.lit(""))
    leaves = docs.select(plain[key].alias("key"), g.alias("g"), F.unhex(leaf(plain)).alias("digest"), F.unhex(shown).alias("shown"))
    payload = ["key", "leaf", "shown"]
    leaves = cut(placed(cut(leaves, "digests"), ["key", "digest"]).withColumn("leaf", F.col("digest")), "placed")
    runs, subroots = levels(leaves, fanout, payload, "level")
    subroots = cut(subroots, "subroots")
    top = subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("level").alias("height"), "digest")
    top = cut(placed(top, ["of"]).withColumn("subroot", F.col("digest")), "top")
    top_runs, roots = levels(top, fanout, ["of", "height", "subroot"], "top")
    roots = roots.select("g", "level", F.col("digest").alias("root"), F.array().cast("array<struct<left:binary,right:binary>>").alias("proof"))
    tops = pushed(top_runs, roots, ["of", "height", "subroot"], top)
    tops = cut(tops.select(F.col("of").alias("g"), F.col("height").alias("level"), "subroot", "root", "proof"), "tops")
    out = pushed(runs, tops, payload, leaves)
    return out.select(F.col("key").alias("doc_id"), _text(F.col("leaf")).alias("leaf"), _text(F.col("subroot")).alias("subroot"), _text(F.col("root")).alias("root"), "proof", _text(F.coalesce("shown", "leaf")).alias("shown"))


def folded(shown: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, shown, lambda acc, s: h(_text(s["left"]), acc, _text(s["right"])))


def siblings(proof: Column) -> Column:
    """All of a proof as one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(_text(s["left"]), _text(s["right"]))), "")
