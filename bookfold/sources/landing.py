"""The landing directory: list it, choose the files of a month, read their bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.operators.assertions import one_file_per_kind, raised_message
from bookfold.operators.files import classify, latest_per_kind
from bookfold.schemas import EXTRACTS, KINDS

_MIME_TYPES = {
    ".xls": "application/vnd.ms-excel",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
}


class SourceFileError(ValueError):
    """A kind has no file, or its newest file is ambiguous."""


def manifest(spark: SparkSession, landing: str) -> DataFrame:
    """Files directly in ``landing``. Only metadata columns are read, so no file is opened."""
    folder = landing.split(":", 1)[-1].rstrip("/")
    folder = "/" + folder.lstrip("/") if folder.startswith("/") else folder
    listed = spark.read.format("binaryFile").load(landing)
    suffix = F.lower(F.regexp_extract("name", r"\.[^.]*$", 0))
    mime = F.lit("")
    for ending, mime_type in _MIME_TYPES.items():
        mime = F.when(suffix == ending, F.lit(mime_type)).otherwise(mime)
    return (
        listed.select(
            F.col("path").alias("file_id"),
            F.regexp_extract("path", r"[^/]*$", 0).alias("name"),
            F.col("modificationTime").alias("modified_time"),
            F.col("length").alias("n_bytes"),
            F.col("_metadata.file_path").alias("file_uri"),
        )
        .filter(F.regexp_replace("file_id", r"/[^/]*$", "").endswith(folder))
        .withColumn("mime_type", mime)
    )


def choose_files(files: DataFrame, target_month: str | None = None) -> list[dict]:
    """One file per kind as dicts, in the order of the kinds; the plan itself fails if one is missing or ambiguous."""
    kinds = files.sparkSession.createDataFrame([(i, k, EXTRACTS[k].label) for i, k in enumerate(KINDS)], "place int, source_kind string, label string")
    newest = latest_per_kind(classify(files), target_month).drop("is_month_match")
    try:
        chosen = one_file_per_kind(newest, kinds).orderBy("place").drop("place").collect()
    except Exception as problem:
        if (message := raised_message(problem)) is None:
            raise
        raise SourceFileError(message) from None
    return [r.asDict() for r in chosen]


def run_month(chosen: list[dict], target_month: str | None) -> str:
    """The month asked for, else the largest one named by the chosen files."""
    if target_month:
        return target_month
    months = [f["target_month"] for f in chosen if f["target_month"]]
    if not months:
        raise SourceFileError("target_month could not be extracted from selected source files")
    return max(months)


def file_contents(spark: SparkSession, landing: str, chosen: list[dict]) -> DataFrame:
    """Name, kind and bytes of the chosen files; the path filter prunes all other files from the scan."""
    kind = F.lit(None).cast("string")
    for file in chosen:
        kind = F.when(F.col("path") == file["file_id"], F.lit(file["source_kind"])).otherwise(kind)
    return (
        spark.read.format("binaryFile")
        .load(landing)
        .filter(F.col("_metadata.file_path").isin([f["file_uri"] for f in chosen]))
        .select(
            kind.alias("source_kind"),
            F.col("path").alias("file_id"),
            F.regexp_extract("path", r"[^/]*$", 0).alias("file_name"),
            "content",
        )
    )
