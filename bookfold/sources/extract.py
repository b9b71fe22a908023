"""Turn file bytes into one row per sheet row: a distributed job, one file at a time per task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookfold.functions.cleanse import clean_cells
from bookfold.schemas import CELLS_SCHEMA
from bookfold.sources.workbooks import html_rows, xlsx_rows

_SNIFFED_BYTES = 512
_CELLS_PER_BATCH = 100_000
_ARROW_SCHEMA = pa.schema(
    [
        ("source_kind", pa.string()),
        ("file_id", pa.string()),
        ("file_name", pa.string()),
        ("sheet_name", pa.string()),
        ("row_number", pa.int64()),
        ("values", pa.list_(pa.string())),
        ("error", pa.string()),
    ]
)


def file_format(name: Column | str, content: Column | str) -> Column:
    """``xlsx`` by suffix, ``html`` by the first bytes, else ``other``."""
    name = F.col(name) if isinstance(name, str) else name
    content = F.col(content) if isinstance(content, str) else content
    head = F.lower(F.decode(F.substring(content, 1, _SNIFFED_BYTES), "ISO-8859-1"))
    html = F.ltrim(head, F.lit(" \t\n\r\u000b\f")).startswith("<html") | head.contains("<table")
    return F.when(F.lower(name).endswith(".xlsx"), "xlsx").when(html, "html").otherwise("other")


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, cells = [], 0
    for batch in batches:
        about = batch.select(["source_kind", "file_id", "file_name", "format"]).to_pylist()
        contents = batch.column("content")
        for index, file in enumerate(about):
            identity = (file["source_kind"], file["file_id"], file["file_name"])
            # Legacy binary spreadsheets have no reader here; like unknown bytes they are tried as HTML.
            reader = xlsx_rows if file["format"] == "xlsx" else html_rows
            try:
                for sheet, number, values in reader(contents[index].as_py()):
                    rows.append((*identity, sheet, number, values, None))
                    cells += len(values) + 1
                    if cells >= _CELLS_PER_BATCH:
                        yield _as_batch(rows)
                        rows, cells = [], 0
            except Exception as problem:  # reported as a row: a bad file must not be retried by Spark
                rows.append((*identity, None, None, [], f"{file['file_name']}: {problem or type(problem).__name__}"))
    if rows:
        yield _as_batch(rows)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, field.type) for column, field in zip(zip(*rows), _ARROW_SCHEMA)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW_SCHEMA)


def extract_cells(files: DataFrame) -> DataFrame:
    """``files``: source_kind, file_id, file_name, content. Cells come out cleaned; ``error`` marks a bad file."""
    tasks = files.select(
        "source_kind", "file_id", "file_name", file_format("file_name", "content").alias("format"), "content"
    )
    return tasks.mapInArrow(_read_files, CELLS_SCHEMA).withColumn("values", clean_cells("values"))


def empty_files(files: DataFrame, cells: DataFrame) -> DataFrame:
    """Files with no text in any sheet; ``cells`` are ``measured``."""
    return files.join(cells.filter("has_text").select("file_id").distinct(), "file_id", "left_anti")
