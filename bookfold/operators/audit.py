"""Run events folded to states, and rows that a build leaves out with the reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookfold.functions.cleanse import has_text, refine
from bookfold.schemas import EXTRACTS, ROW_IDENTITY

#: Events of a run in the order they can follow each other at one instant.
STATES = ("RUNNING", "LOADED", "FAILED", "SUCCESS")
ENDED = ("FAILED", "SUCCESS")
LOST = "LOST"


def last_states(events: DataFrame, keys: Sequence[str], now: Column, patience_seconds: int) -> DataFrame:
    """``events``: keys, status, happened_at, n_rows, error_message. Per key: the last status, LOST if the run has not
    ended and been silent for longer than ``patience_seconds``; when it began and was last heard of, the number of its
    events, the rows they brought, and the last error. Partial results merge, so a run with many events is no hot key."""
    place = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("status"))
    last = F.max(F.struct("happened_at", place.alias("place"), "status")).alias("last")
    error = F.max(F.when(F.coalesce("error_message", F.lit("")) != "", F.struct("happened_at", "error_message"))).alias("error")
    folded = events.groupBy(*keys).agg(last, error, F.min("happened_at").alias("began_at"), F.count("*").alias("n_events"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    silent = F.unix_seconds(now) - F.unix_seconds("last.happened_at") > patience_seconds
    status = F.when(~F.col("last.status").isin(*ENDED) & silent, LOST).otherwise(F.col("last.status"))
    return folded.select(*keys, status.alias("status"), "began_at", F.col("last.happened_at").alias("heard_at"), "n_events", "n_rows", F.col("error.error_message").alias("error_message"))


def rejected_rows(kind: str, raw: DataFrame, target_month: str) -> DataFrame:
    """Rows of a raw month that a build leaves out or reads in part: identity, loaded_at, whether it is left out, and
    the reasons, one for each key field that is blank and each number or date that cannot be read."""
    extract = EXTRACTS[kind]
    blank = [F.when(~has_text(k), F.lit(f"{k} is blank")) for k in extract.key_fields]
    unread = [
        F.when(refine(f.name, f.refined_type).isNull() & has_text(f.name), F.concat(F.lit(f"{f.name} is no {f.refined_type}: "), F.col(f.name)))
        for f in extract.fields
        if f.refined_type != "text"
    ]
    rows = raw.filter(F.col("target_month") == target_month)
    # A list of one: no filter on the reasons moves below a generator, where they would be made once more, and in a scan's few tasks.
    told = F.explode_outer(F.array(F.struct(F.array_compact(F.array(*blank)).alias("blank"), F.array_compact(F.array(*unread)).alias("unread"))))
    reasoned = rows.select(F.lit(kind).alias("source_kind"), *ROW_IDENTITY, "loaded_at", told.alias("told"))
    return reasoned.filter((F.size("told.blank") > 0) | (F.size("told.unread") > 0)).select(
        "source_kind", *ROW_IDENTITY, "loaded_at", (F.size("told.blank") > 0).alias("left_out"), F.concat("told.blank", "told.unread").alias("reasons")
    )
