"""File choice on manifests derived from the driver tables, and reading files made from their rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookfold.operators.files import classify, latest_per_kind
from bookfold.operators.files import latest_month as max_month
from bookfold.operators.files import missing_kinds as kinds_without_file
from bookfold.operators.headers import measured
from bookfold.schemas import EXTRACTS
from bookfold.session import spread
from bookfold.showcase.frames import derived, table
from bookfold.showcase.make_files import xlsx_bytes
from bookfold.showcase.registry import query, sql_text
from bookfold.showcase.scalars import MONTH_NAMES
from bookfold.sources.extract import empty_files, extract_cells, file_format

_MONTH = "substr(CAST(ts AS STRING), 1, 4) || substr(CAST(ts AS STRING), 6, 2)"
# The events of even users arrive a month late by name, so both a match and the fallback occur.
_MANIFEST = (
    "SELECT event_type AS source_kind, CAST(event_id AS STRING) AS name, "
    f"CASE WHEN user_id % 2 = 0 THEN {_MONTH} ELSE '209912' END AS target_month, "
    "CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END AS modified_time FROM {events}"
)


def _sql_latest(month: str) -> str:
    return (
        f"SELECT source_kind, name, target_month FROM ({_MANIFEST}) QUALIFY rank() OVER (PARTITION BY source_kind "
        f"ORDER BY CASE WHEN target_month = '{month}' THEN 1 ELSE 0 END DESC, modified_time DESC NULLS LAST) = 1"
    )


@query(_sql_latest("202401"))
def latest_file_per_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_kind(derived(spark, sf_dir, _MANIFEST), "202401")
    return newest.select("source_kind", "name", "target_month")


@query(_sql_latest("190001"))
def latest_file_without_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_kind(derived(spark, sf_dir, _MANIFEST), "190001")
    return newest.select("source_kind", "name", "target_month")


@query(f"SELECT max(target_month) AS target_month FROM ({_MANIFEST})")
def latest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_month(derived(spark, sf_dir, _MANIFEST))


_CLASSIFIED = (
    "SELECT o_orderkey, name, CASE "
    + " ".join(f"WHEN regexp_full_match(name, {sql_text('(?i)' + e.name_pattern)}) THEN '{k}'" for k, e in EXTRACTS.items())
    + " END AS source_kind, nullif(regexp_extract(name, '(20[0-9]{2})年?(0[1-9]|1[0-2])', 1) "
    + f"|| regexp_extract(name, '(20[0-9]{{2}})年?(0[1-9]|1[0-2])', 2), '') AS target_month FROM ({MONTH_NAMES})"
)


@query(f"SELECT * FROM ({_CLASSIFIED}) WHERE source_kind IS NOT NULL")
def classified_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(derived(spark, sf_dir, MONTH_NAMES))


@query("SELECT CAST(doc_id AS VARCHAR) AS source_kind, lang AS label FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("source_kind"), F.col("lang").alias("label"))
    files = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("source_kind"))
    return kinds_without_file(files, kinds)


_SNIFFED = (
    "SELECT page_id, CASE WHEN page_id % 5 = 4 THEN 'r.XLSX' ELSE 'r.xls' END AS name, CASE page_id % 5 "
    "WHEN 0 THEN replace(html, '<!DOCTYPE html>', chr(10) || ' ') WHEN 1 THEN '<p>x <TABLE>' || html "
    "WHEN 2 THEN '﻿<html>' || html ELSE html END AS body FROM {pages}"
)


@query(
    "SELECT page_id, CASE WHEN lower(name) LIKE '%.xlsx' THEN 'xlsx' "
    "WHEN starts_with(lower(ltrim(substr(body, 1, 512), ' ' || chr(9) || chr(10) || chr(13))), '<html') "
    "OR contains(lower(substr(body, 1, 512)), '<table') THEN 'html' ELSE 'other' END AS format "
    f"FROM ({_SNIFFED})"
)
def format_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    sniffed = derived(spark, sf_dir, _SNIFFED)
    return sniffed.select("page_id", file_format("name", F.col("body").cast("binary")).alias("format"))


# One HTML file per order: a table with a spanned cell, an unused one, and one whose header names columns.
_HTML = (
    "SELECT CAST(o_orderkey AS STRING) AS file_id, "
    "'<html><body><table><tr><td rowspan=2>' || o_orderpriority || '</td><td> ' || o_orderstatus || ' &amp;  x</td></tr>"
    "<tr><td>' || CASE WHEN o_orderkey % 5 = 0 THEN 'NULL' ELSE 'Ab<br>C' END || '</td></tr></table><table><tr></tr></table>"
    "<table><thead><tr><th>key</th></tr></thead><tr><td>' || CAST(o_orderkey AS STRING) || '</td></tr></table></body></html>' AS body "
    "FROM {orders}"
)
_HTML_CELLS = " UNION ALL ".join(
    f"SELECT CAST(o_orderkey AS VARCHAR) AS file_id, '{sheet}' AS sheet_name, CAST({row} AS BIGINT) AS row_number, {cells} AS cells FROM orders"
    for sheet, row, cells in (
        ("html_table_1", 1, "o_orderpriority || '|' || o_orderstatus || ' & x'"),
        ("html_table_1", 2, "o_orderpriority || '|' || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'Ab C' END"),
        ("html_table_2", 1, "CAST(o_orderkey AS VARCHAR)"),
    )
)


_HTML_PER_TASK = 100_000


def _joined_cells(cells: DataFrame) -> DataFrame:
    return cells.select("file_id", "sheet_name", "row_number", F.array_join("values", "|").alias("cells"))


@query(_HTML_CELLS)
def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = derived(spark, sf_dir, _HTML, _HTML_PER_TASK).select(
        F.lit("product_master").alias("source_kind"),
        "file_id",
        F.concat("file_id", F.lit(".xls")).alias("file_name"),
        F.col("body").cast("binary").alias("content"),
    )
    return _joined_cells(extract_cells(files))


@F.arrow_udf(T.BinaryType())
def _customer_workbook(key: pa.Array, name: pa.Array, segment: pa.Array, balance: pa.Array) -> pa.Array:
    books = []
    for k, n, s, b in zip(*(column.to_pylist() for column in (key, name, segment, balance))):
        sheets = {"基本": [[n, None, k], [], ["　", s if k % 4 else "N/A", b]], "空": [], "別": [[f" {k}"], [s, s, None]]}
        books.append(xlsx_bytes(sheets, inline=k % 2 == 0))
    return pa.array(books, pa.binary())


_WHOLE_BALANCE = "CAST(round(c_acctbal) AS BIGINT)"
_XLSX_CELLS = " UNION ALL ".join(
    f"SELECT CAST(c_custkey AS VARCHAR) AS file_id, '{sheet}' AS sheet_name, CAST({row} AS BIGINT) AS row_number, {cells} AS cells FROM customer"
    for sheet, row, cells in (
        ("基本", 1, "c_name || '||' || CAST(c_custkey AS VARCHAR)"),
        ("基本", 2, "''"),
        (
            "基本",
            3,
            f"'|' || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END || '|' || CAST({_WHOLE_BALANCE} AS VARCHAR)",
        ),
        ("別", 1, "CAST(c_custkey AS VARCHAR)"),
        ("別", 2, "c_mktsegment || '|' || c_mktsegment"),
    )
)


#: Making and reading a workbook takes milliseconds.
_WORKBOOKS_PER_TASK = 20_000


def _workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spread(table(spark, sf_dir, "customer"), _WORKBOOKS_PER_TASK)
    book = _customer_workbook("c_custkey", "c_name", "c_mktsegment", F.expr(_WHOLE_BALANCE))
    return customers.select(
        F.lit("monthly_product_sales").alias("source_kind"),
        F.col("c_custkey").cast("string").alias("file_id"),
        F.concat("c_name", F.lit(".xlsx")).alias("file_name"),
        book.alias("content"),
    )


@query(_XLSX_CELLS)
def xlsx_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_cells(extract_cells(_workbooks(spark, sf_dir)))


# A third of the files hold blanks only and a third are no table at all.
_ODD_FILES = (
    "SELECT CAST(s_suppkey AS STRING) AS file_id, CASE s_suppkey % 3 WHEN 0 THEN '<table><tr><td>&#12288;</td><td>nan</td></tr></table>' "
    "WHEN 1 THEN 'plain ' || s_name ELSE '<table><tr><td>' || s_name || '</td></tr></table>' END AS body FROM {supplier}"
)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS file_id, CASE WHEN s_suppkey % 3 = 1 THEN s_suppkey || '.xls: no tables found' END AS error FROM supplier WHERE s_suppkey % 3 < 2")
def empty_or_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = derived(spark, sf_dir, _ODD_FILES).select(
        F.lit("product_master").alias("source_kind"),
        "file_id",
        F.concat("file_id", F.lit(".xls")).alias("file_name"),
        F.col("body").cast("binary").alias("content"),
    )
    cells = measured(extract_cells(files))
    errors = cells.filter("error IS NOT NULL").select("file_id", "error")
    return empty_files(files.select("file_id"), cells).join(errors, "file_id", "left")
