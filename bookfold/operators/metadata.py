"""Metadata columns every stored row carries, and month counts over stored tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookfold.operators.quality import all_rows
from bookfold.schemas import staged_name

_METADATA = ("row_number", "target_month", "loaded_at", "source_file_id", "source_file_name", "source_sheet_name")


def with_metadata(rows: DataFrame, target_month: str, loaded_at: datetime | Column) -> DataFrame:
    """Month, load time and origin on every row; one load time per batch. Missing text becomes blank."""
    stamp = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    origin = {"file_id": "source_file_id", "file_name": "source_file_name", "sheet_name": "source_sheet_name"}
    stamped = rows.withColumnsRenamed(origin).withColumns({"target_month": F.lit(target_month), "loaded_at": stamp})
    business = [c for c in stamped.columns if c not in (*_METADATA, "source_kind", "error")]
    return stamped.select(*_METADATA, *business).na.fill("")


def staged(rows: DataFrame) -> DataFrame:
    """Prefix the business columns for the staging layer."""
    return rows.withColumnsRenamed({c: staged_name(c) for c in rows.columns if c not in _METADATA})


def month_count(table: DataFrame, target_month: str) -> DataFrame:
    return table.sparkSession.sql(
        "SELECT count(*) AS row_count FROM {t} WHERE target_month = :month", args={"month": target_month}, t=table
    )


def total_month_count(tables: list[DataFrame], target_month: str) -> DataFrame:
    counts = all_rows([month_count(t, target_month) for t in tables])
    return counts.agg(F.sum("row_count").alias("row_count"))
