"""Classify files by name and choose one per kind."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookfold.functions.cleanse import month_in_name
from bookfold.schemas import EXTRACTS


def kind_of(name: Column | str, patterns: Mapping[str, str] | None = None) -> Column:
    """The first kind whose pattern covers the whole name; null when none does."""
    patterns = patterns or {kind: e.name_pattern for kind, e in EXTRACTS.items()}
    text = F.col(name) if isinstance(name, str) else name
    chosen = F.lit(None).cast("string")
    for kind, pattern in reversed(list(patterns.items())):
        chosen = F.when(text.rlike(rf"(?iud)^(?:{pattern})\z"), F.lit(kind)).otherwise(chosen)
    return chosen


def classify(files: DataFrame, patterns: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``source_kind`` and ``target_month``; files of no kind are dropped."""
    return (
        files.withColumn("source_kind", kind_of("name", patterns))
        .filter(F.col("source_kind").isNotNull())
        .withColumn("target_month", month_in_name("name"))
    )


def latest_per_kind(candidates: DataFrame, target_month: str | None = None) -> DataFrame:
    """The newest file of each kind, those of the wanted month first.

    Without a match for the month every candidate counts. ``rank`` keeps files tied for newest, so a
    kind with two rows here is ambiguous. The rank filter becomes a group limit below the shuffle.
    """
    matches = F.coalesce(F.col("target_month") == F.lit(target_month), F.lit(False))
    newest = Window.partitionBy("source_kind").orderBy(F.desc("is_month_match"), F.desc_nulls_last("modified_time"))
    return (
        candidates.withColumn("is_month_match", matches)
        .withColumn("_rank", F.rank().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def missing_kinds(candidates: DataFrame, kinds: DataFrame) -> DataFrame:
    """Rows of ``kinds`` (``source_kind``, ...) with no candidate."""
    return kinds.join(candidates.select("source_kind").distinct(), "source_kind", "left_anti")


def latest_month(files: DataFrame) -> DataFrame:
    return files.agg(F.max("target_month").alias("target_month"))
