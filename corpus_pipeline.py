"""A corpus made ready for training: five stages, each written and read again before the next.

Language ID drops documents without a language, near-dedup keeps one document of each class,
decontamination drops documents that hold a benchmark item, secrets are replaced by marks, and
the last stage returns the pieces of what is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import decontaminate, language_id, order_minhash, secrets, sentencepiece_codec
from tarmac.llm.common import table
from tarmac.session import scratch

#: A document is dropped if no language has this share of it.
LEAST_SHARE = 0.2


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter go, and a null text is one of them.

    The model is that of all labelled documents that are not held out, as for the operator's query.
    """
    told = language_id.predict(docs, language_id.learn_from_table(spark, sf_dir))
    kept = told.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.select("row.*")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates, by doc_id."""
    return order_minhash.classes(docs).where("first").select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.search(docs, table(spark, sf_dir, "benchmark")).where(F.size("found") == 0).select("row.*")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced, n_chars brought up to date."""
    return secrets.redact(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every document."""
    return sentencepiece_codec.encode(docs).select(
        "row.doc_id", "row.lang", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify),
    ("near_duplicates", deduplicate),
    ("decontaminate", decontaminated),
    ("secrets", redact),
    ("sentencepiece", tokenise),
]

#: Language mixtures, sketches and pieces are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
