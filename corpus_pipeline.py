"""From raw documents to token ids: the stages of a training corpus, in order.

Every stage reads all that the one before it kept. Ids name documents: a null id is one like any other,
and rows that repeat an id and a text leave the exact stage once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanframe.llm import decontaminate, exact_dedup, language, near_dedup
from gleanframe.llm.queries import encoded
from gleanframe.llm.tables import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text gets the language that its codeword decodes to, and texts without one go: null ones, those
    without a letter and those that show no evidence of it. An ambiguous text stays if it shows evidence of a
    language about as near, since a short clean one can be that; where there is nothing to learn from, all texts
    with a letter stay."""
    return language.with_language(docs, language.train(docs))


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column has."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def _of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with one of the ids."""
    staying = _free(docs, "staying")
    ids = ids.select(F.col("doc_id").alias(staying)).distinct().hint("merge")
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col(staying)), "left_semi")


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays: the longest as written, then the one of the smallest id."""
    found = stored(exact_dedup.exact_duplicates(docs), "exact")
    kept = found.filter("kept")
    if found.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return _of(docs, kept)
    # an id that names several texts stays with those that do
    plain = F.translate(F.coalesce("text", F.lit("")), exact_dedup.WHITE.decode(), "")
    staying, sha = _free(docs, "staying"), _free(docs, "sha")
    kept = kept.select(F.col("doc_id").alias(staying), F.col("text_sha256").alias(sha)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(staying)) & (F.sha2(plain, 256) == F.col(sha))
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the smallest id stays, with the text
    that is kept of it."""
    staying, sha = _free(docs, "staying"), _free(docs, "sha")
    kept = near_dedup.near_rows(docs, words=5, percent=80).filter("kept").select(
        F.col("doc_id").alias(staying), F.col("sha").alias(sha)).distinct().hint("merge")
    same = F.col("doc_id").eqNullSafe(F.col(staying)) & (near_dedup.text_key("text") == F.col(sha))
    return docs.join(kept, same, "left_semi")


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a passage with the benchmark go."""
    return decontaminate.without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document that is left, and whether they decode to its text."""
    return encoded(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", remove_copies),
    ("near_dedup", remove_near_copies),
    ("decontamination", decontaminate_documents),
    ("sentencepiece", encode_documents),
]

# SQL has no classifier, no signatures and no pieces; tests/llm/test_pipeline.py holds the stages against
# plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
