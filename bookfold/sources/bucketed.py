"""Tables bucketed by their join keys: joins and grouped counts on those keys run without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookfold.operators.enrich import with_master
from bookfold.operators.quality import all_rows


def write_bucketed(rows: DataFrame, folder: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows as a table of ``buckets`` buckets, one file each, sorted by the keys; read back. Rows are dealt to their
    buckets first, so that a bucket is one file and not one for each writing task."""
    name = f"bucketed_{uuid4().hex}"
    dealt = rows.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", folder).saveAsTable(name)
    return rows.sparkSession.table(name)


def matched_counts(facts: DataFrame, master: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key of the facts: rows, and rows of the master; with both sides bucketed by the keys, without an exchange."""
    ours = facts.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    theirs = master.groupBy(*keys).agg(F.count("*").alias("n_matches"))
    return ours.join(theirs, list(keys), "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0)))


def enriched_and_unmatched(facts: DataFrame, master: DataFrame, others: dict[str, DataFrame], keys: Sequence[str], columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Facts with columns of the master, and per table in ``others`` how many facts have no row there."""
    counts = []
    for name, table in others.items():
        matched = matched_counts(facts, table, keys)
        counts.append(matched.agg(F.coalesce(F.sum(F.when(F.col("n_matches") == 0, F.col("n_rows"))), F.lit(0)).alias("error_count")).select(F.lit(name).alias("table_name"), "error_count"))
    return with_master(facts, master, keys, columns), all_rows(counts)
