"""A corpus, from raw documents to a training mix: language, near duplicates, benchmark leaks, personal data, mixture.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written and read again as the next one's docs. All but
the last return the columns of documents; rows are told apart by doc_id and text, so an id that repeats is no trouble.
A null text has no letters and goes in the first stage; empty tables pass through all stages; columns of any name, also of
those that the operators make, come through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.llm import decontaminate, language, mixing, near_dedup, pii
from funnelspark.llm._spark import broadcast_if, cut, table

#: Rows of ids that may be broadcast, 24 bytes each; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _identity() -> F.Column:
    return F.struct("doc_id", F.xxhash64("text", F.length("text")).alias("text_hash"))


def _joined(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """docs whose identity is (left_semi) or isn't (left_anti) among ids(id)."""
    ids = broadcast_if(ids.select(F.col("id.doc_id").alias("_id"), F.col("id.text_hash").alias("_hash")), BROADCAST_IDS)
    return docs.join(ids, docs.doc_id.eqNullSafe(ids._id) & (F.xxhash64(docs.text, F.length(docs.text)) == ids._hash), how)


#: Languages to keep (None: every one that is learnt), and the least score of a document in its language.
WANTED: tuple[str, ...] | None = None
LEAST_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: tuple[str, ...] | None = WANTED, least: float = LEAST_SCORE) -> DataFrame:
    """Leaves out documents that no language fits: texts without letters, and those whose best score is below ``least``, such as
    texts in a script or of letters that no labelled document has; with ``wanted`` those predicted to be in another language too.

    The model is learnt from all labelled documents. Where nothing is labelled there is none, and every text with a letter stays.
    Rows that repeat all stay; a null lang or doc_id isn't learnt from; a null text has no letters."""
    names = ["doc_id", "text", *(c for c in docs.columns if c not in ("doc_id", "text"))]
    model = language.train(docs, F.lit(True))
    plain = docs.select(*(F.col(f"`{c}`").alias(f"c{i}" if c != "text" else "text") for i, c in enumerate(names)))
    if model[0]:
        fits = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least)
        kept = language.predict(plain, model).filter(fits if wanted is None else fits & F.col("lang_pred").isin(*wanted))
    else:
        kept = plain.filter(F.col("text").rlike(r"\p{L}"))
    kept = kept.select(*(F.col(f"c{i}" if c != "text" else "text").alias(c) for i, c in enumerate(names)))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least doc_id of every class.

    Null and empty texts are copies of each other; rows that repeat are one document. A class of null ids only keeps all its
    rows, as none of them is the least."""
    found = cut(near_dedup.near_duplicates(docs.select(_identity().alias("doc_id"), "text")), "classes")
    kept = _joined(docs, found.select(F.col("class_id").alias("id")).distinct(), "left_semi")
    repeated = found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    return kept.dropDuplicates(["doc_id", "text"]) if repeated.limit(1).count() else kept


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a whole window of a benchmark item. A null or empty text holds none; null and empty items have none;
    rows that repeat go or stay together."""
    found = decontaminate.decontaminate(docs.select(_identity().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _joined(docs, cut(found.filter("contaminated").select(F.col("doc_id").alias("id")).distinct(), "contaminated"), "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span by its kind; n_chars follows (null for a null text, which stays null). Rows that repeat stay alike."""
    masked = pii.mask_pii(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: what is taken of each document, and where in training. A null or empty text has no words and is taken 0 times; null is a
    source of its own; rows that repeat are documents of their own."""
    return mixing.mix(docs)


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
]

#: The language model and the samples of near_dedup are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
