"""Rows per key, kept across loads: each load is counted once and merged in, older loads are not read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookfold.sources.snapshots import Snapshots


def counted(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of one load. Null is a key like any other."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def merged(state: DataFrame, further: DataFrame, keys: Sequence[str]) -> DataFrame:
    return state.unionByName(further).groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"))


class KeyCounts:
    """The state under ``path``, replaced as a snapshot: a load that fails leaves it as it was. The name of the load is
    committed with the state it was merged into, so a load that comes again is passed over."""

    def __init__(self, spark: SparkSession, path: str, keys: T.StructType):
        self.keys = keys.fieldNames()
        self._state = Snapshots(spark, path, T.StructType([*keys, T.StructField("n_rows", T.LongType())]))

    def merge(self, load: str, rows: DataFrame) -> bool:
        """Whether the load was new."""
        if not self._state.log().filter(F.col("note") == load).isEmpty():
            return False
        self._state.replace(merged(self.counts(), counted(rows, self.keys), self.keys), note=load)
        return True

    def counts(self) -> DataFrame:
        return self._state.read()

    def duplicates(self) -> DataFrame:
        """Keys of more than one row over all loads."""
        return self.counts().filter("n_rows > 1").withColumnRenamed("n_rows", "duplicate_count")
