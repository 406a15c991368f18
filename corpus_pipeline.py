"""A corpus through five operators: toxicity, language, lines, near copies, packing.

All stages but the last return the columns they were given. Rows are told apart by their texts, so repeated rows share
their fate in the first two stages, count as copies of each other's lines in the third and as near copies in the fourth.
Rows with a null doc_id pass stages three and four as they are. Empty tables pass all stages. Columns beside those of
documents pass too, whatever their names, if they begin with no double underscore.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.llm import language, toxicity
from grovespark.llm.line_dedup import dedup_lines
from grovespark.llm.packing import pack_documents
from grovespark.llm.queries import WORD_BPE
from grovespark.llm.scratch import materialize
from grovespark.llm.simhash import near_dedup


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit; learns from the labels of the training fold. Null texts are clean."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters that fit one of the languages; learns from the training fold's languages. Null texts go."""
    return language.drop_unknown(docs, language.train(docs, language.training_fold(F.col("doc_id"), 4, 2)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first line of each class stays, by (doc_id, position); n_chars follows the text. A document may be left empty."""
    return dedup_lines(docs, counts=None).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group whose five-word shingles are alike by a Jaccard similarity of 0.8 or
    more; documents without words are one group."""
    return near_dedup(docs, width=5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document in sequences of 4,096 tokens; a null text is its end token alone, repeated rows are packed each."""
    return pack_documents(docs, WORD_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: The stages' models and tokens can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one's result written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
