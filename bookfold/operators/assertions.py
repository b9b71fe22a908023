"""Conditions a plan asserts itself: it gives its rows, or the job fails with the message. Nothing is collected to decide."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RAISED = re.compile(r"\[USER_RAISED_EXCEPTION\] (.*?)(?: SQLSTATE: \w+)?\s*(?:\n|$)", re.DOTALL)


def raised_message(problem: Exception) -> str | None:
    """The message a plan failed with; None for any other failure."""
    found = _RAISED.search(str(problem))
    return found[1] if found else None


def unless(problem: Column, value: Column) -> Column:
    """``value``, or the job fails with ``problem`` where that is not null. Part of a column that is used, so that no
    optimizer drops it."""
    return F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(value)


def one_file_per_kind(newest: DataFrame, kinds: DataFrame) -> DataFrame:
    """``newest``: rows tied for newest per source_kind, with a name. ``kinds``: place, source_kind, label; a few rows.

    One row per kind, in their order by place, with all columns of ``newest``. Fails if a kind has no file, naming all
    such kinds, else if one has several, naming its files."""
    tied = newest.groupBy("source_kind").agg(
        F.count("*").alias("_tied"), F.max(F.struct("name", *[c for c in newest.columns if c not in ("name", "source_kind")])).alias("_file"),
        F.array_join(F.reverse(F.array_sort(F.collect_list("name"))), ", ").alias("_names"),
    )
    # The kinds are a fixed, short list, so one window holds them all.
    every = Window.partitionBy(F.lit(0))
    known = kinds.join(tied, "source_kind", "left")
    missing = F.array_sort(F.collect_list(F.when(F.col("_tied").isNull(), F.struct("place", "label"))).over(every))["label"]
    doubled = F.array_sort(F.collect_list(F.when(F.col("_tied") > 1, F.struct("place", "label", "_names"))).over(every))
    told = known.withColumns({"_missing": missing, "_doubled": doubled})
    problem = F.when(F.size("_missing") > 0, F.concat(F.lit("required source file not found: "), F.array_join("_missing", ", "))).when(
        F.size("_doubled") > 0, F.concat(F.lit("multiple latest files for "), F.get("_doubled", F.lit(0))["label"], F.lit(": "), F.get("_doubled", F.lit(0))["_names"])
    )
    return told.select("place", unless(problem, F.col("source_kind")).alias("source_kind"), "_file.*")


def gated(findings: DataFrame, row_counts: DataFrame, fail_on_findings: bool = True) -> DataFrame:
    """Columns source_rows and quality_errors of a run that passes. Fails if there is no refined row (``row_counts``:
    row_count), or, if asked to, with any error among the findings (error_count)."""
    zero = F.lit(0).cast("long")
    totals = row_counts.select(F.col("row_count").alias("n"), zero.alias("e")).unionByName(findings.select(zero.alias("n"), F.col("error_count").alias("e")))
    summed = totals.agg(F.coalesce(F.sum("n"), zero).alias("source_rows"), F.coalesce(F.sum("e"), zero).alias("quality_errors"))
    empty = F.when(F.col("source_rows") == 0, F.lit("the number of refined rows is 0"))
    failed = F.when(F.col("quality_errors") > 0, F.format_string("quality checks found %d errors", F.col("quality_errors")))
    problem = F.coalesce(empty, failed) if fail_on_findings else empty
    return summed.select(unless(problem, F.col("source_rows")).alias("source_rows"), "quality_errors")
