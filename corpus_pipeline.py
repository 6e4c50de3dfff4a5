"""From raw documents to packed training sequences, in five stages.

Each stage is a function of the session, the documents its predecessor kept and the folder
of the tables. What it returns is written as Parquet and read again for the next one. All
but the last return documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table, shared_table
from tidemark.llm.mixing import mixed_documents, word_count
from tidemark.llm.neardup import without_near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.pii import redact
from tidemark.llm.toxicity import fit, reject_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents scored as toxic go."""
    return reject_toxic(docs, fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of near-duplicates the least id stays."""
    return without_near_duplicates(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: spans of personal data give way to their kind; all documents stay."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents as often as their source's target asks for."""
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: bins of 2048 words without two texts alike or of one source."""
    return pack(docs, word_count(F.col("text")), F.xxhash64("text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix),
    ("packing", pack_sequences),
]

# SQL can express neither the learned stages nor the greedy packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
