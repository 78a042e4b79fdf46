"""From raw documents to packed training sequences.

Each stage applies one operator to everything its predecessor kept; in between the documents
are written as Parquet to the shared folder and read again. Tables that a stage stored on
the way are deleted when it is finished.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.llm import decontaminate, packing, quality, recompression, simhash
from meterfold.llm.queries import tokenizer_file


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept(docs, labels, host="source", path="lang")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.one_of_each(docs, radius=2, width=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of 20-word windows that start earlier."""
    return recompression.cut_texts(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark items cover less than a twentieth."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file(), capacity=2048)


STAGES = [
    ("quality classifier", classify),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

#: SQL cannot express the classifier, SimHash or the packing; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.finished(spark, name.replace(" ", "-"), functools.partial(stage, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
