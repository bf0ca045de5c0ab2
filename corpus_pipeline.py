"""A corpus pipeline: five operators of voxloom.llm, one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents.  All but the last return the
columns of documents.

1. toxicity: documents with a score of 0.5 or more go.  Null and empty texts stay.
2. line_dedup: lines found in ten documents or more stay where they occur first, by id
   and position; n_chars follows the text.
3. near_dedup: of documents whose sets of five-word shingles have a similarity of 0.8
   or more, directly or through others, the one with the least id stays.
4. decontaminate: documents with a window like a benchmark item go.
5. sentencepiece: ids of each text by the public vocabulary, and whether they decode
   to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import catalog
from voxloom.llm.decontaminate import without_leaks
from voxloom.llm.line_dedup import dedup_lines
from voxloom.llm.near_dedup import keep_one
from voxloom.llm.sentencepiece_stream import Vocabulary, encode_documents
from voxloom.llm.storage import Scratch
from voxloom.llm.tables import fold, table
from voxloom.llm.toxicity import train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id")) != 0)
    return docs.where(train(docs, labels).score(F.col("text")) < 0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = dedup_lines(docs, min_docs=10, keep="first")
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = encode_documents(docs, Vocabulary.load(catalog.PIECE_MODEL))
    return coded.select(F.col("id").alias("doc_id"), "n_tokens", "ids", "round_trip")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("sentencepiece", sentencepiece),
]

#: A trained classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; a copy goes once the next is written."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before, docs = docs, scratch.save(stage(spark, docs, sf_dir))
        scratch.drop(before)
    return docs
