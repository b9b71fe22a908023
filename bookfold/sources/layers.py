"""The stored tables: Parquet under one root, a folder per layer.

The refined tables and the quality results are replaced as a whole or run by run; they are kept as snapshots.

Staging and raw are partitioned by ``target_month``, the column that builds filter on, and by batch. Inside each file
rows are sorted by the clustering columns; on request, files are ranges of them. A batch that is appended again replaces
itself, and the ledger tells what each batch has brought to each table. Tables are read with their declared schema, so a month
stays text and an empty table is readable.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookfold.schemas import (
    AUDIT_LOG_SCHEMA,
    EXTRACTS,
    GENERIC_COLUMNS,
    QUALITY_RESULTS_SCHEMA,
    REJECTED_ROWS_SCHEMA,
    ROW_IDENTITY,
    RUN_EVENTS_SCHEMA,
    ingest_schema,
    raw_schema,
    source_schema,
    staging_schema,
)
from bookfold.session import ROWS_PER_TASK
from bookfold.sources.clustering import clustered, file_ranges, may_hold
from bookfold.sources.snapshots import Snapshots, folder_exists

AUDIT_LOG = "pipeline_audit_log"
QUALITY_RESULTS = "source_quality_results"
RUN_EVENTS = "run_events"
REJECTED_ROWS = "rejected_rows"
BATCH_LEDGER = "batch_ledger"
SHEET_LEDGER = "sheet_ledger"
#: Logs that only grow: the day they are partitioned by, and the stamp it is taken from.
_DATED = {AUDIT_LOG: ("started_date", "started_at"), RUN_EVENTS: ("happened_date", "happened_at")}
#: Tables replaced run by run.
_BY_RUN = (QUALITY_RESULTS, REJECTED_ROWS)
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("source_file_id", T.StringType()),
        T.StructField("source_sheet_name", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)
#: Counts of sheets that were found in what was written; the batch is named by the partition.
SHEETS_SCHEMA = T.StructType([f for f in LEDGER_SCHEMA if f.name != "batch_id"] + [LEDGER_SCHEMA["batch_id"]])
Sheet = tuple[str, str]
_RUN_ID = re.compile(r"[A-Za-z0-9_.-]+")


class Layers:
    def __init__(self, spark: SparkSession, root: str, generic_columns: int = GENERIC_COLUMNS):
        self.spark = spark
        self.root = root.rstrip("/")
        self._schemas: dict[str, T.StructType] = {
            "staging_ingest": ingest_schema(generic_columns),
            "raw_ingest": ingest_schema(generic_columns),
            AUDIT_LOG: AUDIT_LOG_SCHEMA,
            QUALITY_RESULTS: QUALITY_RESULTS_SCHEMA,
            RUN_EVENTS: RUN_EVENTS_SCHEMA,
            REJECTED_ROWS: REJECTED_ROWS_SCHEMA,
        }
        self._cluster = {
            "staging_ingest": ("source_file_name", "source_sheet_name"),
            "raw_ingest": ("source_file_name", "source_sheet_name"),
        }
        for kind, extract in EXTRACTS.items():
            self._schemas[extract.staging_table] = staging_schema(kind)
            self._schemas[extract.raw_table] = raw_schema(kind)
            self._schemas[extract.source_table] = source_schema(kind)
            self._cluster[extract.staging_table] = ("source_file_name",)
            self._cluster[extract.raw_table] = extract.cluster

    def path(self, table: str) -> str:
        layer = "audit" if table in (*_DATED, *_BY_RUN, BATCH_LEDGER, SHEET_LEDGER) else table.split("_", 1)[0]
        return f"{self.root}/{layer}/{table}"

    def partition_column(self, table: str) -> str:
        return "target_month" if table in self._cluster else _DATED[table][0]

    def snapshots(self, table: str) -> Snapshots | None:
        """The versions of a table that is replaced; None for one that is only appended to."""
        if table in self._cluster or table in _DATED:
            return None
        return Snapshots(self.spark, self.path(table), self._schemas[table], "run_id" if table in _BY_RUN else None)

    def ensure(self) -> None:
        """Create every table that does not exist yet; existing ones are left alone."""
        for table, schema in self._schemas.items():
            if versions := self.snapshots(table):
                versions.ensure()
                continue
            empty = self.spark.range(0).select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
            if table in _DATED:
                day, stamp = _DATED[table]
                empty = empty.withColumn(day, F.to_date(stamp))
            empty.write.mode("ignore").partitionBy(self.partition_column(table)).parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        if versions := self.snapshots(table):
            return versions.read()
        schema = self._schemas[table]
        return self.spark.read.schema(schema).parquet(self.path(table)).select(schema.fieldNames())

    def read_month(self, table: str, target_month: str) -> DataFrame:
        return self.read(table).filter(F.col("target_month") == target_month)

    def read_batch(self, table: str, target_month: str, loaded_at: datetime) -> DataFrame:
        """The rows of one load; a file holds one load, so the others are skipped by their statistics."""
        return self.read_month(table, target_month).filter(F.col("loaded_at") == F.lit(loaded_at))

    def append(self, table: str, rows: DataFrame, batch_id: str | None = None, sheets: Sequence[Sheet] | None = (), files: int | None = None) -> int:
        """Add a batch and return its number of rows, counted while they are written; an empty batch adds no file.

        A batch that the ledger has is not written again. One that was written and not entered, as its driver was lost,
        replaces its own files. The ledger gets the rows of the batch, and of each of ``sheets`` (file, sheet name), a few
        that are known. With None it gets every sheet, also those without a file or a name: any number of them, counted
        from these two columns of the files just written, and entered without passing the driver.
        With ``files``, rows are dealt to so many files, more if they would hold over ``ROWS_PER_TASK`` rows, by ranges of the clustering columns (one shuffle), and the
        ranges are kept; otherwise the sort is local, without a shuffle."""
        if batch_id is not None:
            if not _RUN_ID.fullmatch(batch_id):
                raise ValueError(f"batch id cannot name a partition: {batch_id!r}")
            landed = self._ledger(table).filter((F.col("batch_id") == batch_id) & F.col("source_file_id").isNull()).first()
            if landed:
                return landed["n_rows"]
        batch = batch_id or uuid4().hex
        rows, keys = rows.select(self._schemas[table].fieldNames()), self._cluster[table]
        of_sheet = [(F.col("source_file_id") == file) & (F.col("source_sheet_name") == sheet) for file, sheet in sheets or ()]
        counted = Observation()
        counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(own).alias(f"n{i}") for i, own in enumerate(of_sheet)]]
        if files:
            rows = clustered(rows, ["target_month"], keys, ROW_IDENTITY, max(files, -(-rows.count() // ROWS_PER_TASK))).observe(counted, *counts)
            rows = rows.withColumn("batch_id", F.lit(batch))
        else:
            # Sorted last and by the partition columns first, as the writer asks for: it would sort the whole rows once more.
            rows = rows.observe(counted, *counts).withColumn("batch_id", F.lit(batch)).sortWithinPartitions("target_month", "batch_id", *keys)
        writer = rows.write.partitionBy("target_month", "batch_id")
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(self.path(table))
        if files:
            own = self.spark.read.schema(self._batch_schema(table)).parquet(self.path(table)).filter(F.col("batch_id") == batch)
            ranges = file_ranges(own.select(*keys, "_metadata"), keys).coalesce(1)
            ranges.write.mode("overwrite").parquet(f"{self.path(table)}_ranges/batch_id={batch}")
        found, now = counted.get, datetime.now(timezone.utc)
        if sheets is None:
            # Before the batch is entered, which makes them count; an attempt after a lost driver replaces them.
            own = self.spark.read.schema(self._batch_schema(table)).parquet(self.path(table)).filter(F.col("batch_id") == batch)
            of_sheet = own.groupBy("source_file_id", "source_sheet_name").agg(F.count(F.lit(1)).alias("n_rows"))
            of_sheet.withColumn("committed_at", F.lit(now)).write.mode("overwrite").parquet(f"{self._sheet_ledger(table)}/batch_id={batch}")
        entries = [(batch, None, None, found["n"], now), *[(batch, *sheet, found[f"n{i}"], now) for i, sheet in enumerate(sheets or ())]]
        entered = self.spark.createDataFrame(entries, LEDGER_SCHEMA).coalesce(1)
        entered.write.mode("append").parquet(f"{self.path(BATCH_LEDGER)}/table_name={table}")
        return found["n"]

    def _batch_schema(self, table: str) -> T.StructType:
        return T.StructType([*self._schemas[table], T.StructField("batch_id", T.StringType())])

    def _ledger(self, table: str) -> DataFrame:
        """The folder of each table is its own, as tables are written at the same time."""
        path = f"{self.path(BATCH_LEDGER)}/table_name={table}"
        if not folder_exists(self.spark, path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(path)

    def _sheet_ledger(self, table: str) -> str:
        return f"{self.path(SHEET_LEDGER)}/table_name={table}"

    def _entered(self, table: str) -> DataFrame:
        """The ledger, and the sheets found in batches that it has."""
        ledger = self._ledger(table)
        if not folder_exists(self.spark, self._sheet_ledger(table)):
            return ledger
        sheets = self.spark.read.schema(SHEETS_SCHEMA).parquet(self._sheet_ledger(table))
        return ledger.unionByName(sheets.join(ledger.select("batch_id"), "batch_id", "left_semi"))

    def landed(self, tables: Sequence[str] | None = None) -> DataFrame:
        """What batches have brought: table_name, batch_id, source_file_id and source_sheet_name (both null: the whole
        batch, or rows that have neither), n_rows, committed_at."""
        frames = [self._entered(t).withColumn("table_name", F.lit(t)) for t in (self._cluster if tables is None else tables)]
        found = frames[0]
        for frame in frames[1:]:
            found = found.unionByName(frame)
        return found

    def look_up(self, table: str, target_month: str, wanted: Mapping[str, str | None]) -> DataFrame:
        """The rows of a month with these values of clustering columns. Batches without ranges are read whole."""
        same = F.lit(True)
        for key, value in wanted.items():
            same &= F.col(key).isNull() if value is None else F.col(key) == value
        rows = self.spark.read.schema(self._batch_schema(table)).parquet(self.path(table))
        rows = rows.filter((F.col("target_month") == target_month) & same)
        if folder_exists(self.spark, f"{self.path(table)}_ranges"):
            ranges = self.spark.read.option("basePath", f"{self.path(table)}_ranges").parquet(f"{self.path(table)}_ranges")
            ranges = ranges.withColumn("batch_id", F.col("batch_id").cast("string"))
            known = [r["batch_id"] for r in ranges.select("batch_id").distinct().collect()]
            paths = [r["file_path"] for r in ranges.filter(may_hold(wanted)).select("file_path").collect()]
            rows = rows.filter(~F.col("batch_id").isin(known)).unionByName(rows.filter(F.col("batch_id").isin(known) & F.col("_metadata.file_path").isin(paths)))
        return rows.select(self._schemas[table].fieldNames())

    def replace(self, table: str, rows: DataFrame) -> int:
        """Swap the whole content; the old one stays readable until the new one is complete. The number of rows."""
        return self.snapshots(table).replace(rows)

    def read_audit_day(self, started_at: datetime) -> DataFrame:
        """Audit rows of runs that started on the day of ``started_at``; other days are pruned."""
        dated = T.StructType([*AUDIT_LOG_SCHEMA, T.StructField("started_date", T.DateType())])
        log = self.spark.read.schema(dated).parquet(self.path(AUDIT_LOG))
        return log.filter(F.col("started_date") == F.to_date(F.lit(started_at))).drop("started_date")

    def append_audit(self, rows: DataFrame) -> None:
        self._append_dated(AUDIT_LOG, rows)

    def append_event(self, run_id: str, status: str, n_rows: int = 0, error_message: str = "") -> None:
        event = (run_id, status, datetime.now(timezone.utc), n_rows, error_message)
        self._append_dated(RUN_EVENTS, self.spark.createDataFrame([event], RUN_EVENTS_SCHEMA).coalesce(1))

    def _append_dated(self, table: str, rows: DataFrame) -> None:
        day, stamp = _DATED[table]
        log = rows.select(self._schemas[table].fieldNames()).withColumn(day, F.to_date(stamp))
        log.write.mode("append").partitionBy(day).parquet(self.path(table))

    def read_events(self, since: date | None = None) -> DataFrame:
        """Events of the runs, from a day on if asked; earlier days are pruned."""
        dated = T.StructType([*RUN_EVENTS_SCHEMA, T.StructField("happened_date", T.DateType())])
        events = self.spark.read.schema(dated).parquet(self.path(RUN_EVENTS))
        return (events if since is None else events.filter(F.col("happened_date") >= F.lit(since))).drop("happened_date")

    def replace_run(self, run_id: str, results: DataFrame) -> None:
        """Quality results of one run, replacing earlier results of that run, also by none at all."""
        self._replace_run(QUALITY_RESULTS, run_id, results.coalesce(1))

    def replace_rejected(self, run_id: str, rows: DataFrame) -> int:
        """Rejected rows of one run, as ``replace_run``; any number of them, in as many files as tasks. The number of rows."""
        return self._replace_run(REJECTED_ROWS, run_id, rows)

    def _replace_run(self, table: str, run_id: str, rows: DataFrame) -> int:
        if not _RUN_ID.fullmatch(run_id):
            raise ValueError(f"run id cannot name a partition: {run_id!r}")
        return self.snapshots(table).replace(rows, run_id)
