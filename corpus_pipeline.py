"""From raw documents to packed training sequences, as five stages.

Each stage takes the documents that the one before kept and reads nothing else but
tables that do not change (labels, benchmark). Every stage's result is written as
Parquet and read again, so a lost executor costs no more than the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import decontamination, near_duplicates, packing, secrets, toxicity
from ordermill.llm.common import read_table, set_aside
from ordermill.session import scratch_path

# Least share of common five-word shingles for two documents to be near duplicates.
SIMILARITY_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the limit."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the least doc_id (rows without one come last).

    Rows are judged by their own texts, whatever their ids. Documents without words are no group and stay.
    """
    return near_duplicates.one_of_each(docs, similarity=SIMILARITY_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    rows, restore = set_aside(docs, "n_words", "hits", "items", "_text")
    found = decontamination.find_contamination(rows, read_table(spark, sf_dir, "benchmark"))
    return restore(found.where(F.size("hits") == 0))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by a mark and n_chars brought up to date."""
    rows, restore = set_aside(docs, "spans", "blob_id", "_found")
    ledger = secrets.update_ledger(spark, rows, scratch_path(spark, "secret-ledger"))
    clean = secrets.redact(secrets.findings(rows, ledger))
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return restore(clean.withColumn("n_chars", n_chars))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# Tokenizers, compression and MinHash have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
