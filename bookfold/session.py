"""Session settings the refinery relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
#: Rows of 20 text columns that a task can sort in a few hundred MB.
ROWS_PER_TASK = 500_000
_METHOD_SIZE = "spark.sql.codegen.hugeMethodLimit"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Stamps stored as INT96 have no statistics, so the files of other loads could not be skipped.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # The JVM never compiles methods above 8000 bytes; wide typed projections run faster split up.
    _METHOD_SIZE: "8000",
}


def build_session(app_name: str = "bookfold", master: str | None = None, shuffle_bytes: int | None = None) -> SparkSession:
    """``shuffle_bytes``: what the widest shuffle is expected to move; AQE merges partitions that end up small."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_bytes:
        partitions = max(200, shuffle_bytes // _SHUFFLE_PARTITION_BYTES)
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which every executor can reach."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="bookfold-")
    return f"{root.rstrip('/')}/bookfold/{purpose}-{uuid4().hex}"


def spread(scan: DataFrame, rows_per_task: int = ROWS_PER_TASK, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of a scan over all cores, and over so many tasks that none gets many more than ``rows_per_task`` rows; a scan that
    splits into as many tasks is left as it is.

    With ``keys``, expressions by which later steps group their rows, rows of equal keys come together, whatever the scan
    splits into: what is derived from the scan then needs no shuffle of its own for these steps.

    Meant ahead of work that costs far more than moving its input. Rows are dealt by their places in the scan, which a
    recomputed task finds again; dealt in turn, they would first be sorted.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, -(-scan.count() // rows_per_task))
    if keys:
        return scan.repartition(wanted, *map(F.expr, keys))
    return scan if scan.rdd.getNumPartitions() >= wanted else scan.repartition(wanted, F.monotonically_increasing_id())


def split_methods(spark: SparkSession) -> SparkSession:
    """A session of any maker, with the method size of ``SETTINGS`` where it allows larger ones: what the JVM does not
    compile runs several times slower."""
    if int(spark.conf.get(_METHOD_SIZE)) > int(SETTINGS[_METHOD_SIZE]):
        spark.conf.set(_METHOD_SIZE, SETTINGS[_METHOD_SIZE])
    return spark


def together(jobs: Sequence[Callable[[], None]]) -> None:
    """Submit independent Spark jobs at once, so that one's last tasks do not hold up the next."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        for submitted in [pool.submit(job) for job in jobs]:
            submitted.result()
