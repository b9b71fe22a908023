"""Find the header row of every sheet and map its columns to fields.

Rows come one per sheet row: source_kind, file_id, sheet_name, row_number, values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.functions.cleanse import cell_at, pad_cells, payload_json
from bookfold.functions.labels import label_key, label_keys, may_be_label
from bookfold.schemas import EXTRACTS, GENERIC_COLUMNS, HEADER_SEARCH_ROWS, Extract, generic_column

SHEET = ("file_id", "sheet_name")
_WORK_COLUMNS = ("values", "n_cells", "has_text", "width", "header_row", "positions")


def _text_array(names) -> Column:
    names = list(names)
    return F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")


def _per_kind(extracts: Mapping[str, Extract], build) -> Column:
    """A constant per kind; the layouts are fixed, so this is a CASE over literals, not a join."""
    (first, *rest) = extracts.items()
    chosen = F.when(F.col("source_kind") == first[0], build(first[1]))
    for kind, extract in rest:
        chosen = chosen.when(F.col("source_kind") == kind, build(extract))
    return chosen


def known_labels(spark: SparkSession, extracts: Mapping[str, Extract] = EXTRACTS) -> DataFrame:
    """One row per label of the fixed layouts: source_kind, key, field."""
    rows = {(e.kind, label_key(label)): f.name for e in extracts.values() for f in e.fields for label in f.labels}
    values = ", ".join(f"('{kind}', '{key}', '{field}')" for (kind, key), field in rows.items())
    return spark.sql(f"SELECT * FROM VALUES {values} AS labels(source_kind, key, field)")


def _needed(extract: Extract) -> set[str]:
    return {f.name for f in extract.fields if f.needed}


def _can_map_by_position(extract: Extract) -> bool:
    return _needed(extract) <= {f.name for f in extract.fields if f.position is not None}


def measured(rows: DataFrame) -> DataFrame:
    """Add the size of each row, so that sheets can be summed up without reading their cells again."""
    return rows.withColumns(
        {"n_cells": F.size("values"), "has_text": F.exists("values", lambda v: v != "")}
    )


def header_candidates(rows: DataFrame, extracts: Mapping[str, Extract] = EXTRACTS) -> DataFrame:
    """Rows near the top of a sheet that hold a known label, with the first column of each field found.

    The label table is fixed (one row per label of the layouts), so broadcasting it is safe. Only the
    few cells that are labels are shuffled, once: both groupings share the sheet partitioning. Keys are made in Python, so rows
    and cells that cannot hold a label are left out before.
    """
    pattern = may_be_label(label_key(label) for e in extracts.values() for f in e.fields for label in f.labels)
    head = rows.filter(F.col("row_number") <= HEADER_SEARCH_ROWS).filter(F.exists("values", lambda v: v.rlike(pattern)))
    possible = F.transform("values", lambda v: F.when(v.rlike(pattern), v))
    keyed = head.select("source_kind", *SHEET, "row_number", label_keys(possible).alias("keys"))
    # The outer form keeps Spark from adding a not-empty filter that would run the label function twice.
    cells = keyed.select("source_kind", *SHEET, "row_number", F.posexplode_outer("keys").alias("position", "key"))
    hits = cells.join(F.broadcast(known_labels(rows.sparkSession, extracts)), ["source_kind", "key"])
    row = ["source_kind", *SHEET, "row_number"]
    first = hits.repartition(*SHEET).groupBy(*row, "field").agg(F.min("position").alias("position"))
    return first.groupBy(*row).agg(
        F.count("*").alias("n_fields"), F.map_from_entries(F.collect_list(F.struct("field", "position"))).alias("column_map")
    )


def best_header(candidates: DataFrame) -> DataFrame:
    """Most fields wins, the earlier row on equal counts."""
    return candidates.groupBy("source_kind", *SHEET).agg(
        F.max_by(F.struct("row_number", "column_map"), F.struct("n_fields", (-F.col("row_number")).alias("early"))).alias("best")
    )


def sheet_report(rows: DataFrame, extracts: Mapping[str, Extract] = EXTRACTS) -> DataFrame:
    """One row per non-empty sheet of ``measured`` rows: width, header row, column map, warnings, error."""
    sheets = (
        rows.groupBy("source_kind", *SHEET)
        .agg(
            F.max("n_cells").alias("width"),
            F.count("*").alias("n_rows"),
            F.bool_or("has_text").alias("has_text"),
        )
        .filter("has_text")
    )
    best = best_header(header_candidates(rows, extracts))
    report = sheets.join(best, ["source_kind", *SHEET], "left")

    names = _per_kind(extracts, lambda e: _text_array(e.field_names))
    needed = _per_kind(extracts, lambda e: _text_array(sorted(_needed(e))))
    optional = _per_kind(extracts, lambda e: _text_array(sorted(set(e.field_names) - _needed(e))))
    by_position = _per_kind(
        extracts,
        lambda e: F.array(*[F.lit(-1 if f.position is None else f.position) for f in e.fields])
        if _can_map_by_position(e)
        else F.lit(None).cast("array<int>"),
    )
    found_positions = F.transform(names, lambda name: F.coalesce(F.try_element_at("best.column_map", name), F.lit(-1)))
    report = (
        report.withColumn("found", F.coalesce(F.map_keys("best.column_map"), _text_array([])))
        .withColumn("missing", F.array_except(needed, "found"))
        .withColumn("has_header", F.size("missing") == 0)
        .withColumn("positions", F.when(F.col("has_header"), found_positions).otherwise(by_position))
    )
    no_warning = _text_array([])
    optional_missing = F.transform(
        F.array_except(optional, "found"),
        lambda field: F.concat(F.lit("optional column missing for "), "source_kind", F.lit(": "), field),
    )
    headerless = F.array(F.concat(F.lit("headerless positional mapping applied for "), "source_kind"))
    unusable = F.concat(
        F.lit("required columns missing for "), "source_kind", F.lit(": "), F.array_join("missing", ", ")
    )
    return report.select(
        "source_kind",
        *SHEET,
        "width",
        "n_rows",
        F.when(F.col("has_header"), F.col("best.row_number")).alias("header_row"),
        "positions",
        F.map_filter(F.map_from_arrays(names, "positions"), lambda _, p: p >= 0).alias("column_map"),
        F.when(F.col("has_header"), optional_missing)
        .when(F.col("positions").isNotNull(), headerless)
        .otherwise(no_warning)
        .alias("warnings"),
        F.when(F.col("positions").isNull(), unusable).alias("error"),
    )


def with_report(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Attach width, header row and positions. One report row per sheet; AQE splits a hot sheet."""
    return rows.join(report.select(*SHEET, "width", "header_row", "positions"), list(SHEET))


def generic_rows(reported: DataFrame, width: int = GENERIC_COLUMNS) -> DataFrame:
    """Every sheet row as a JSON payload plus ``width`` padded columns."""
    padded = reported.withColumn("cells", pad_cells("values", F.col("width")))
    return padded.select(
        *[c for c in reported.columns if c not in _WORK_COLUMNS],
        payload_json("cells").alias("row_payload_json"),
        *[cell_at("cells", i).alias(generic_column(i)) for i in range(width)],
    )


def mapped_rows(reported: DataFrame, field_names: list[str]) -> DataFrame:
    """The rows below the header, one column per field; rows with nothing in any field are dropped."""
    below = reported.filter(F.col("row_number") > F.coalesce("header_row", F.lit(0)))
    fields = [cell_at("values", F.get("positions", F.lit(i))).alias(name) for i, name in enumerate(field_names)]
    kept = [c for c in reported.columns if c not in _WORK_COLUMNS]
    mapped = below.select(*kept, *fields)
    return mapped.filter(F.exists(F.array(*field_names), lambda v: v != ""))
