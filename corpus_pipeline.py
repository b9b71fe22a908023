"""Cleaning a corpus in five stages: quality rules, line dedup, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns a DataFrame that is written as
Parquet and read back as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bookfold.llm.stages import drop_poor_documents, drop_repeated_lines, drop_repeated_passages, keep_one_of_each_group, pack
from bookfold.session import shared_folder

STAGES = [
    ("quality_rules", drop_poor_documents),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack),
]

#: Trees, hashed signatures and dynamic programming have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
