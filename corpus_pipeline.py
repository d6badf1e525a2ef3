"""The corpus pipeline: documents in, token sequences out.

Each stage works on all that the one before it kept, written as Parquet and
read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.llm.common import stored

STAGES = [
    ("language ID", stages.known_language),
    ("n-gram Jaccard join", stages.one_of_each_group),
    ("suffix-array dedup", stages.without_repeated_bytes),
    ("PII", stages.without_personal_data),
    ("packing", stages.packed),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
