"""The registered queries of this subpackage, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.llm import cross_entropy, decontaminate, filter_audit, html_text, language, manifest, mixing, near_dedup, pii, quality, run_index, topk, url_rules
from funnelspark.llm._spark import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def pii_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op3_pii SQL can say: how many spans of the four base kinds a text holds."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def url_fixed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op5_url_rules SQL can say: host, path, the fixed rule and its verdict; null where the mined rules decide."""
    found = url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return found.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("verdict"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    last = F.try_element_at("positions", F.lit(-1)).alias("last_position")
    return found.select("doc_id", "size", "source_size", "target", "taken", "position", last, F.size("positions").cast("long").alias("n_reads"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op8_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0")
    return cross_entropy.score(table(spark, sf_dir, "documents"), good)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.select(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_index.remove_repeats(table(spark, sf_dir, "documents"), words=run_index.PASSAGE)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "n_repeated_words")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, manifest.lowered(text)).otherwise(text)
    found = manifest.manifest(table(spark, sf_dir, "documents"), altered)
    found = found.withColumn("folded_root", manifest.folded(F.col("shown"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_decontaminate, op2_near_dedup, op3_pii, op4_language, op5_url_rules, op6_mixing, op7_topk, op8_cross_entropy, op9_quality, op10_html_text, op11_run_index, op12_manifest, op13_filter_audit, pii_base_counts, url_fixed_rules)
    return {f.__name__: f for f in own}


_WORDS = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS t
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS t
       FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks)),
h AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw USING (k, t)),
p AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS x FROM (SELECT DISTINCT doc_id, i, k FROM h)) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(m.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)
"""

#: mixed(...) of a table of documents; the pipeline's SQL has its own input.
MIX_SQL = r"""
z AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, coalesce(md5(CAST(doc_id AS VARCHAR)), '') AS o FROM {}),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM z GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, CAST(sum(source_size) OVER () AS BIGINT) AS everything, source_size * 3 AS cap FROM s),
v AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight FROM r),
f AS (SELECT *, row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank) AS place,
        CAST(everything - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM v),
g AS (SELECT *, arg_min(level, place) FILTER (level * weight <= cap) OVER () AS fill FROM f),
goal AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), fill * weight) AS target,
           CASE WHEN count(*) OVER () > 1 THEN CAST(rank AS DOUBLE) / (count(*) OVER () - 1) - 0.5 ELSE 0 END AS slope FROM g),
laid AS (SELECT z.*, CAST(sum(size) OVER (PARTITION BY source ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS start FROM z)
SELECT doc_id, size, source_size, target, taken, 2 * u / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * u)) AS position,
       2 * w / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * w)) AS last_position, n_reads
FROM (SELECT *, CASE WHEN n_reads > 0 THEN u + CAST((n_reads - 1) * size AS DOUBLE) / target END AS w
      FROM (SELECT *, CASE WHEN taken > 0 THEN CAST((taken + size - 1) // size AS BIGINT) ELSE 0 END AS n_reads, CASE WHEN source_size > 0 THEN CAST(start AS DOUBLE) / source_size ELSE 0 END AS u
            FROM (SELECT doc_id, size, source_size, target, slope, start,
       CAST(CASE WHEN source_size > 0 THEN least(floor(target / source_size * (start + size)) - floor(target / source_size * start), size * 3) ELSE 0 END AS BIGINT) AS taken
FROM laid JOIN goal ON laid.source IS NOT DISTINCT FROM goal.source)))
"""

OP6_SQL = "WITH " + MIX_SQL.format("documents").strip()

OP7_SQL = """
WITH e AS (SELECT vec_id, row_number() OVER () AS rn, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.rn, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.rn <> q.rn),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY rn ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


PII_BASE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
c AS (SELECT doc_id, x, list_filter(list_transform(regexp_extract_all(x, '[0-9](?:[\x20-]?[0-9])+'), lambda s: list_reverse(list_transform(string_split(regexp_replace(s, '[^0-9]', '', 'g'), ''), lambda n: CAST(n AS INTEGER)))), lambda v: len(v) BETWEEN 13 AND 19) AS cards FROM d)
SELECT doc_id, CAST(len(regexp_extract_all(x, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')) AS BIGINT) AS n_email,
       CAST(len(list_filter(regexp_extract_all(x, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'), lambda s: len(list_filter(string_split(s, '.'), lambda n: coalesce(TRY_CAST(n AS BIGINT), 256) > 255)) = 0)) AS BIGINT) AS n_ip,
       CAST(len(list_filter(cards, lambda v: list_sum(list_transform(v, lambda n, i: CASE WHEN i % 2 = 1 THEN n WHEN n > 4 THEN 2 * n - 9 ELSE 2 * n END)) % 10 = 0)) AS BIGINT) AS n_card,
       CAST(len(list_filter(regexp_extract_all(x, '\+[0-9][\x20().0-9-]+[0-9]'), lambda s: length(regexp_replace(s, '[^0-9]', '', 'g')) BETWEEN 9 AND 15)) AS BIGINT) AS n_phone
FROM c
"""

_FITS = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN " + "{" + str(i) + "}" for i, (_, h, p) in sorted(enumerate(url_rules.FIXED_RULES), key=lambda r: -len(r[1][1] + r[1][2])))
URL_FIXED_SQL = rf"""
WITH h AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
SELECT page_id, host, path, CASE {_FITS.format(*(f"'{h}{p}'" for _, h, p in url_rules.FIXED_RULES))} END AS rule, CASE {_FITS.format(*(f"'{v}'" for v, _, _ in url_rules.FIXED_RULES))} END AS verdict FROM h
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
#: Bit by bit, as no function has it.
_CRC32 = """xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, x: list_reduce(range(8), lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, xor(c, x)), CAST(4294967295 AS BIGINT)))"""

OP12_SQL = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS g, {_LEAF.format("text")} AS leaf,
       CASE WHEN {_CRC32} % 3 = 0 THEN {_LEAF.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_LEAF.format("text")} END AS shown FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
up AS (SELECT g, 0 AS level, pos, n, leaf AS h FROM l
       UNION ALL SELECT g, level + 1, pos // 8, max((n + 7) // 8), sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY g, level, pos // 8),
s AS (SELECT g, level, h AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
tup AS (SELECT 0 AS level, pos, n, subroot AS h FROM s
        UNION ALL SELECT level + 1, pos // 8, max((n + 7) // 8), sha256(string_agg(h, '' ORDER BY pos)) FROM tup WHERE n > 1 GROUP BY level, pos // 8),
f AS (SELECT id, g, 0 AS level, pos, shown AS h, '' AS proof FROM l
      UNION ALL SELECT f.id, f.g, f.level + 1, f.pos // 8, sha256(string_agg(CASE WHEN u.pos = f.pos THEN f.h ELSE u.h END, '' ORDER BY u.pos)),
        f.proof || coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos <> f.pos), '')
      FROM f JOIN up u ON u.g = f.g AND u.level = f.level AND u.pos // 8 = f.pos // 8 AND u.n > 1 GROUP BY f.id, f.g, f.level, f.pos, f.h, f.proof),
t AS (SELECT f.id, 0 AS level, s.pos, f.h, f.proof FROM f JOIN s ON s.g = f.g AND s.level = f.level
      UNION ALL SELECT t.id, t.level + 1, t.pos // 8, sha256(string_agg(CASE WHEN u.pos = t.pos THEN t.h ELSE u.h END, '' ORDER BY u.pos)),
        t.proof || coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos <> t.pos), '')
      FROM t JOIN tup u ON u.level = t.level AND u.pos // 8 = t.pos // 8 AND u.n > 1 GROUP BY t.id, t.level, t.pos, t.h, t.proof),
r AS (SELECT level, h AS root FROM tup WHERE n = 1)
SELECT l.doc_id, l.leaf, s.subroot, r.root, sha256(t.proof) AS proof_sha256, t.h AS folded_root, t.h = r.root AS verified
FROM l JOIN s USING (g) CROSS JOIN r JOIN t ON t.id = l.id AND t.level = r.level
"""

OP13_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS v FROM documents),
m AS (SELECT doc_id, part, [len(v) < 50, 100 * len(list_distinct(v)) < 65 * len(v), 100 * len(regexp_extract_all(x, '[A-Z]')) > 5 * length(x), regexp_matches(x, '[#$%&*|]'),
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY x), false)] AS fails FROM w),
b AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM m LEFT JOIN b USING (doc_id) GROUP BY part, fails),
i AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
o AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS seq FROM i a, i b, i c, i d, i e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT seq, array_to_string(list_transform(seq, lambda k: 'ABCDE'[k]), '') AS filter_order, i.f AS step, seq[i.f] AS k, seq[1:i.f - 1] AS earlier FROM o, i),
z AS (SELECT part, filter_order, step, k, n, good, toxic, fails[k] AS bad, len(list_filter(earlier, lambda q: fails[q])) > 0 AS gone, len(list_filter(fails, lambda q: q)) AS total FROM c, s),
r AS (SELECT part, filter_order, step, k, sum(n) FILTER (NOT bad AND NOT gone) AS kept, sum(n) FILTER (bad AND NOT gone) AS removed, sum(n) FILTER (bad AND gone) AS redundant,
        sum(n) FILTER (bad AND total = 1) AS unique_fails, sum(good) FILTER (bad AND NOT gone) AS good_lost, sum(toxic) FILTER (bad AND NOT gone) AS toxic_lost FROM z GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, k), 0) AS BIGINT) AS shapley FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {"pii_base_counts": PII_BASE_SQL, "url_fixed_rules": URL_FIXED_SQL, "op12_manifest": OP12_SQL, "op13_filter_audit": OP13_SQL, "op1_decontaminate": OP1_SQL, "op6_mixing": OP6_SQL, "op7_topk": OP7_SQL}
