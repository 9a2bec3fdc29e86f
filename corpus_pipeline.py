"""The corpus pipeline: quality, near duplicates, secrets, mixture, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. ``run`` writes each stage's result to the shared folder and reads it back, so a
lost executor costs at most the stage at hand. Stages that end in a Python function bound the session's
Arrow batches: with Spark's own bound of 64 MB, each task holds several times that outside the heap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetsight.llm import conv_classifier, minhash, mixture, packing, secret_scan
from fleetsight.llm.common import bound_batches, crc_remainder, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the convolutional classifier scores at its threshold or above."""
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    learnt = crc_remainder(F.col("doc_id"), 4) != 2
    net = conv_classifier.train(docs.select("doc_id", "text"), labels, learnt)
    return conv_classifier.keep(docs.select(*COLUMNS), net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates by five-word shingles."""
    return minhash.deduplicate(docs.select(*COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    bound_batches(spark)
    return secret_scan.redact(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each part of a document that a slot takes, with the part as its text."""
    return mixture.mixed_documents(docs.select(*COLUMNS)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences' pieces, with their ids."""
    bound_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mix_sources),
    ("packing", pack),
]

# The classifier's weights and the tokenizer can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
