"""Tables that stay readable while they are replaced: versions in folders of their own, and a log of what was committed.

A replacement writes a new folder and then enters it in the log, one row in one new file. Readers follow the newest
entry, so a build that fails half way, at any point, leaves the old content in place, and frames that read the old
version go on reading it. A table may have parts (the runs of the quality results), each with versions of its own; the
newest version of every part meets the data in a semi-join on partition columns, which prunes all other folders.

Two writers that commit the same number are told apart by time and folder, alike for all readers.
"""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("note", T.StringType()),
    ]
)
_NEWEST = ("number", "committed_at", "folder")


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def folder_exists(spark: SparkSession, name: str) -> bool:
    system, path = _path(spark, name)
    return system.exists(path)


class Snapshots:
    """One table under ``path``; ``part_column``: the column whose values are replaced one at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, part_column: str | None = None):
        self.spark, self.path, self.schema, self.part_column = spark, path, schema, part_column

    def ensure(self) -> None:
        self.spark.createDataFrame([], LOG_SCHEMA).write.mode("ignore").parquet(f"{self.path}/log")

    def log(self) -> DataFrame:
        """What was committed, one row a version."""
        if not folder_exists(self.spark, f"{self.path}/log"):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/log")

    def replace(self, rows: DataFrame, part: str = "", note: str = "") -> int:
        """Commits ``rows`` as the new content of the table or of one part; the number of rows. The note goes into the
        log with it. The rows may come from the
        table itself, as its present version is left alone."""
        newest = self.log().filter(F.col("part") == part).agg(F.max("number")).first()[0]
        number = 0 if newest is None else newest + 1
        folder = f"{number:08d}-{uuid4().hex}"
        counted = Observation()
        names = [n for n in self.schema.fieldNames() if n != self.part_column]
        rows.select(names).observe(counted, F.count(F.lit(1)).alias("n_rows")).write.parquet(self._data(part, folder))
        entry = (part, number, folder, counted.get["n_rows"], datetime.now(timezone.utc), note)
        self.spark.createDataFrame([entry], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return entry[3]

    def _data(self, part: str, folder: str) -> str:
        return f"{self.path}/data/" + (f"{self.part_column}={part}/" if self.part_column else "") + f"version={folder}"

    def read(self, number: int | None = None) -> DataFrame:
        """The newest content, or that of an earlier version of a table without parts."""
        log = self.log()
        if self.part_column:
            return self._newest_parts(log)
        entry = (log if number is None else log.filter(F.col("number") == number)).orderBy(*map(F.desc, _NEWEST)).first()
        if entry is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._data("", entry["folder"])).select(self.schema.fieldNames())

    def _newest_parts(self, log: DataFrame) -> DataFrame:
        if not folder_exists(self.spark, f"{self.path}/data"):
            return self.spark.createDataFrame([], self.schema)
        # An empty first version is as good as none; Spark prunes at run time only where the other side is filtered.
        newest = log.filter("n_rows > 0 or number > 0").groupBy("part").agg(F.max(F.struct(*_NEWEST)).alias("newest"))
        newest = newest.select(F.col("part").alias(self.part_column), F.col("newest.folder").alias("version"))
        versioned = T.StructType([*self.schema, T.StructField("version", T.StringType())])
        data = self.spark.read.schema(versioned).parquet(f"{self.path}/data")
        return data.join(newest, [self.part_column, "version"], "left_semi").select(self.schema.fieldNames())

    def expire(self, keep: int = 2) -> int:
        """Deletes the folders of all but the newest ``keep`` versions of each part; how many there were."""
        entries = self.log().groupBy("part").agg(F.sort_array(F.collect_list(F.struct(*_NEWEST)), False).alias("versions"))
        old = entries.select("part", F.explode(F.slice("versions", keep + 1, 1 << 30)["folder"]).alias("folder"))
        deleted = 0
        for row in old.toLocalIterator():
            system, path = _path(self.spark, self._data(row["part"], row["folder"]))
            deleted += bool(system.delete(path, True))
        return deleted
