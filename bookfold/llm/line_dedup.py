"""Boilerplate lines by site-relative frequency.

For each host, the pages that contain a line are divided by the host's pages; lines above a ratio are dropped
from that host's pages. Counts are sums of map-side partial sums per (host, line hash), so neither a hot host nor
a very common line gathers in one task. What is joined back to the pages is one row per host holding the hashes
of its boilerplate lines, at most (mean distinct lines per page) / ratio of them. It is written out first: the planner
knows its size and broadcasts it if it is small, so that no text is shuffled; else both sides of the join are plain
shuffles, whose hot partitions AQE splits.

Lines are compared with surrounding white space removed; blank lines are never counted nor dropped. A line
repeated in a page counts once for the page; repeated rows are pages of their own. A line must be on ``min_pages`` pages of
its host to be dropped, as a share of few pages tells little. A null host is a host of its own (null is
equal to null); a null text stays null; a text that loses all its lines becomes empty. Other columns pass
unchanged, whatever their names: the operator works on columns numbered by place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookfold.llm.common import only, stored

_TRIM = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.regexp_replace(line, _TRIM, ""))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate_lines(pages: DataFrame, ratio: float, min_pages: int, host: str = "source", text: str = "text") -> DataFrame:
    """``host_key``, ``lines``: hashes of the lines on more than ``ratio`` of the host's pages, and on ``min_pages`` at least."""
    keyed = only(pages, host=host, text=text).select(_host_key(F.col("host")).alias("host_key"), "text")
    seen = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: F.regexp_replace(x, _TRIM, "") != ""), _line_hash))
    counts = keyed.select("host_key", F.explode(seen).alias("line")).groupBy("host_key", "line").agg(F.count("*").alias("n"))
    # Reads the host column alone; the texts are scanned once for the counts.
    totals = keyed.groupBy("host_key").agg(F.count("*").alias("total"))
    frequent = counts.filter(F.col("n") >= min_pages).join(totals, "host_key").filter(F.col("n") > F.lit(ratio) * F.col("total"))
    return frequent.groupBy("host_key").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def _host_key(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit(""))


def drop_boilerplate_lines(pages: DataFrame, ratio: float = 0.2, min_pages: int = 3, host: str = "source", text: str = "text", dropped: str | None = None) -> DataFrame:
    """The pages, all columns in order, without their host's boilerplate lines; with ``dropped``, a last column of that
    name tells how many were dropped."""
    frequent = stored(boilerplate_lines(pages, ratio, min_pages, host, text), "boilerplate-lines")
    names = [f"c{i}" for i in range(len(pages.columns))]
    held, place = F.col(names[pages.columns.index(text)]), pages.columns.index(text)
    rows = pages.toDF(*names).withColumn("host_key", _host_key(F.col(names[pages.columns.index(host)])))
    joined = rows.join(frequent, "host_key", "left")
    lines = _lines(held)
    kept = F.filter(lines, lambda x: (F.regexp_replace(x, _TRIM, "") == "") | ~F.array_contains(F.col("lines"), _line_hash(x)))
    touched = F.col("lines").isNotNull() & held.isNotNull()
    result = joined.withColumn("kept", F.when(touched, kept))
    columns = [F.when(touched, F.array_join("kept", "\n")).otherwise(held) if i == place else F.col(c) for i, c in enumerate(names)]
    if dropped is None:
        return result.select(*columns).toDF(*pages.columns)
    return result.select(*columns, F.when(touched, F.size(lines) - F.size("kept")).otherwise(F.lit(0))).toDF(*pages.columns, dropped)
