"""Header detection and row projections on sheets derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.functions.labels import IGNORED_IN_LABELS, label_key
from bookfold.operators.quality import all_rows
from bookfold.operators.headers import generic_rows, mapped_rows, measured, sheet_report, with_report
from bookfold.schemas import EXTRACTS, GENERIC_COLUMNS, HEADER_SEARCH_ROWS, generic_column
from bookfold.session import spread
from bookfold.showcase.frames import table
from bookfold.showcase.registry import ORACLE, query, sql_text

# Every document is a sheet: a line is a row, a word a cell. Two header rows are written in by document
# number, some past the search depth; even documents are of a kind that cannot do without a header.
_PART_HEADER = ["商品コード", "", "書 名"]
_FULL_HEADER = ["番号", "商品 コード", "（電子出版コード）", "タイトル", "ＩＳＢＮ", "プロダクトコード"]
_PART_ROW, _FULL_ROW = "doc_id % 7 + 1", "doc_id % 35 + 2"
_KINDS = {"product_master": "doc_id % 2 = 1", "monthly_product_sales": "doc_id % 2 = 0"}
_MAPPED = ["product_code", "electronic_publication_code", "title", "isbn"]


def _sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spread(table(spark, sf_dir, "documents")).select(
        "doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("line_number", "line")
    )
    numbered = lines.withColumn("row_number", F.col("line_number").cast("bigint") + 1)
    header = lambda words: F.array(*[F.lit(w) for w in words])
    cells = (
        F.when(F.expr(f"row_number = {_FULL_ROW}"), header(_FULL_HEADER))
        .when(F.expr(f"row_number = {_PART_ROW}"), header(_PART_HEADER))
        .otherwise(F.split("line", " "))
    )
    return measured(
        numbered.select(
            F.expr(f"CASE WHEN {_KINDS['product_master']} THEN 'product_master' ELSE 'monthly_product_sales' END").alias("source_kind"),
            F.col("doc_id").cast("string").alias("file_id"),
            F.col("lang").alias("sheet_name"),
            "row_number",
            cells.alias("values"),
        )
    )


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(sql_text(w) for w in words) + "]"


_WIDE, _NARROW = "ＩＳＢＮ", "isbn"
_SQL_KEY = (
    f"translate(lower(translate(cell, '{_WIDE}', '{_NARROW}')), {' || '.join(f'chr({ord(c)})' for c in IGNORED_IN_LABELS)}, '')"
)
_ALIASES = ", ".join(
    f"('{kind}', {sql_text(label_key(label))}, '{f.name}')" for kind in _KINDS for f in EXTRACTS[kind].fields for label in f.labels
)
_SQL_SHEETS = (
    "WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, "
    "generate_subscripts(string_split(text, chr(10)), 1) AS row_number FROM documents), "
    "sheet AS (SELECT doc_id, row_number, CASE WHEN doc_id % 2 = 1 THEN 'product_master' ELSE 'monthly_product_sales' END AS kind, "
    f"CASE WHEN row_number = {_FULL_ROW} THEN {_sql_list(_FULL_HEADER)} WHEN row_number = {_PART_ROW} THEN {_sql_list(_PART_HEADER)} "
    "ELSE string_split(line, ' ') END AS cells FROM lines), "
    "docs AS (SELECT doc_id, kind, max(len(cells)) AS width, count(*) AS n_rows FROM sheet GROUP BY ALL "
    "HAVING bool_or(len(list_filter(cells, lambda x: x <> '')) > 0)), "
    f"aliases AS (SELECT * FROM (VALUES {_ALIASES}) AS a(kind, key, field)), "
    "words AS (SELECT doc_id, kind, row_number, unnest(cells) AS cell, generate_subscripts(cells, 1) - 1 AS pos "
    f"FROM sheet WHERE row_number <= {HEADER_SEARCH_ROWS}), "
    "hits AS (SELECT w.doc_id, w.row_number, a.field, min(w.pos) AS pos FROM words w JOIN aliases a "
    f"ON a.kind = w.kind AND a.key = {_SQL_KEY} GROUP BY ALL), "
    "best AS (SELECT doc_id, row_number FROM hits GROUP BY doc_id, row_number "
    "QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, row_number) = 1), "
    "found AS (SELECT doc_id, best.row_number, "
    "count(*) FILTER (WHERE field IN ('product_code', 'electronic_publication_code', 'title')) = 3 AS complete, "
    "string_agg(field || ':' || pos, ',' ORDER BY field || ':' || pos) AS map_text, "
    + ", ".join(f"max(CASE WHEN field = '{f}' THEN pos END) AS {f}" for f in _MAPPED)
    + " FROM hits JOIN best USING (doc_id, row_number) GROUP BY ALL) "
)
_POSITIONS = {f.name: f.position for f in EXTRACTS["product_master"].fields}
_POSITION_TEXT = ",".join(sorted(f"{name}:{position}" for name, position in _POSITIONS.items()))


@query(
    f"{_SQL_SHEETS} SELECT doc_id, docs.width, docs.n_rows, CASE WHEN odd AND complete THEN row_number END AS header_row, "
    f"CASE WHEN NOT odd THEN NULL WHEN complete THEN map_text ELSE '{_POSITION_TEXT}' END AS column_map, "
    f"CASE WHEN NOT odd THEN 0 WHEN complete THEN {len(_POSITIONS)} - len(string_split(map_text, ',')) ELSE 1 END AS n_warnings, "
    "CASE WHEN odd AND NOT coalesce(complete, FALSE) THEN 'headerless positional mapping applied for product_master' END AS headerless, "
    "CASE WHEN NOT odd THEN 'required columns missing for monthly_product_sales: accounting_month' "
    "|| CASE WHEN coalesce(product_code, -1) < 0 THEN ', product_code' ELSE '' END END AS error "
    "FROM (SELECT *, doc_id % 2 = 1 AS odd FROM docs) docs LEFT JOIN found USING (doc_id)"
)
def header_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = sheet_report(_sheets(spark, sf_dir))
    entries = F.transform(F.map_entries("column_map"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return report.select(
        F.col("file_id").cast("bigint").alias("doc_id"),
        "width",
        "n_rows",
        "header_row",
        F.array_join(F.array_sort(entries), ",").alias("column_map"),
        F.size("warnings").alias("n_warnings"),
        F.when(F.get("warnings", F.lit(0)).startswith("headerless"), F.get("warnings", F.lit(0))).alias("headerless"),
        "error",
    )


@query(
    "SELECT CAST(count(*) AS BIGINT) AS n_sheets, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(n_warnings) AS BIGINT) AS n_warnings, "
    f"CAST(count(error) AS BIGINT) AS n_errors FROM ({ORACLE['header_detect']})"
)
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheet_report(_sheets(spark, sf_dir)).agg(
        F.count("*").alias("n_sheets"),
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.size("warnings")).alias("n_warnings"),
        F.count("error").alias("n_errors"),
    )


_ANY_FIELD = " OR ".join(
    f"coalesce(cells[coalesce(p_{f}, -1) + 1], '') <> ''" for f in _POSITIONS
)
_SQL_ALL_POSITIONS = ", ".join(
    f"CASE WHEN complete THEN {f if f in _MAPPED else 'CAST(NULL AS BIGINT)'} ELSE {p} END AS p_{f}" for f, p in _POSITIONS.items()
)


@query(
    f"{_SQL_SHEETS}, placed AS (SELECT sheet.*, {_SQL_ALL_POSITIONS}, CASE WHEN complete THEN found.row_number ELSE 0 END AS header_row "
    "FROM sheet JOIN docs USING (doc_id) LEFT JOIN found USING (doc_id) WHERE sheet.kind = 'product_master') "
    "SELECT doc_id, row_number, "
    + ", ".join(f"coalesce(cells[p_{f} + 1], '') AS {f}" for f in _MAPPED)
    + f" FROM placed WHERE row_number > header_row AND ({_ANY_FIELD})"
)
def mapped_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets = _sheets(spark, sf_dir)
    usable = with_report(sheets.filter("source_kind = 'product_master'"), sheet_report(sheets))
    mapped = mapped_rows(usable, EXTRACTS["product_master"].field_names)
    return mapped.select(F.col("file_id").cast("bigint").alias("doc_id"), "row_number", *_MAPPED)


# Every brand is a sheet of parts, with rows of unequal length and text that JSON has to escape.
_PART_CELLS = ["p_name", "'say \"' || p_type || '\"'", "CAST(p_size AS STRING)", "p_brand || chr(92) || chr(9) || '著者'", "''"]


def _part_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.array(*[F.expr(c) for c in _PART_CELLS])
    return measured(
        spread(table(spark, sf_dir, "part")).select(
            F.lit("product_master").alias("source_kind"),
            F.col("p_brand").alias("file_id"),
            F.concat("p_brand", F.lit("-1")).alias("sheet_name"),
            F.col("p_partkey").alias("row_number"),
            F.slice(cells, F.lit(1), F.expr("CAST(p_partkey % 5 AS INT) + 1")).alias("values"),
        )
    )


_SHOWN = [generic_column(i) for i in range(GENERIC_COLUMNS)]


@query(
    "WITH cut AS (SELECT p_brand, p_partkey, list_slice(["
    + ", ".join(_PART_CELLS)
    + "], 1, p_partkey % 5 + 1) AS cells FROM part), "
    "wide AS (SELECT p_brand AS file_id, p_partkey AS row_number, list_resize(cells, max(len(cells)) OVER (PARTITION BY p_brand), '') AS cells FROM cut) "
    "SELECT file_id, row_number, '[' || array_to_string(list_transform(cells, lambda x: CAST(to_json(x) AS VARCHAR)), ', ') || ']' AS row_payload_json, "
    + ", ".join(f"coalesce(cells[{int(c[4:])}], '') AS {c}" for c in _SHOWN)
    + " FROM wide"
)
def generic_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets = _part_sheets(spark, sf_dir)
    rows = generic_rows(with_report(sheets, sheet_report(sheets)))
    return rows.select("file_id", "row_number", "row_payload_json", *_SHOWN)


# Documents again, as sheets of all four kinds in turn: their labels, last field first, stand in a row by document
# number; documents of fewer lines have no header.
_FOUR = list(EXTRACTS)
_LABEL_ROW = "doc_id % 7 + 1"


def _headed_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spread(table(spark, sf_dir, "documents")).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_number", "line"))
    numbered = lines.withColumn("row_number", F.col("line_number").cast("bigint") + 1)
    kind = F.get(F.array(*[F.lit(k) for k in _FOUR]), (F.col("doc_id") % 4).cast("int"))
    cells = F.split("line", " ")
    for k in _FOUR:
        labels = F.array(*[F.lit(f.labels[0]) for f in reversed(EXTRACTS[k].fields)])
        cells = F.when((kind == k) & F.expr(f"row_number = {_LABEL_ROW}"), labels).otherwise(cells)
    return measured(numbered.select(kind.alias("source_kind"), F.col("doc_id").cast("string").alias("file_id"), F.lit("s1").alias("sheet_name"), "row_number", cells.alias("values")))


def _sql_mapped(place: int, kind: str) -> str:
    fields = EXTRACTS[kind].fields
    positional = all(f.position is not None for f in fields if f.needed)
    by_label = [f"coalesce(cells[{len(fields) - i}], '')" for i in range(len(fields))]
    by_place = [f"coalesce(cells[{f.position + 1}], '')" if f.position is not None else "''" for f in fields]
    plain = f"SELECT doc_id, row_number, [{', '.join(by_place)}] AS mapped FROM lines WHERE doc_id % 4 = {place} AND n_rows < {_LABEL_ROW}"
    return (
        f"SELECT doc_id, '{kind}' AS source_kind, row_number, array_to_string(mapped, '|') AS mapped FROM ("
        f"SELECT doc_id, row_number, [{', '.join(by_label)}] AS mapped FROM lines WHERE doc_id % 4 = {place} AND n_rows >= {_LABEL_ROW} AND row_number > {_LABEL_ROW}"
        + (f" UNION ALL {plain}" if positional else "")
        + ") WHERE len(list_filter(mapped, lambda x: x <> '')) > 0"
    )


@query(
    "WITH lines AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_rows FROM (SELECT doc_id, string_split(unnest(string_split(text, chr(10))), ' ') AS cells, "
    "generate_subscripts(string_split(text, chr(10)), 1) AS row_number FROM documents)) " + " UNION ALL ".join(_sql_mapped(i, k) for i, k in enumerate(_FOUR))
)
def mapped_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all four kinds with all their fields, by header or by position."""
    sheets = _headed_sheets(spark, sf_dir)
    report = sheet_report(sheets)
    parts = []
    for kind in _FOUR:
        mapped = mapped_rows(with_report(sheets.filter(F.col("source_kind") == kind), report), EXTRACTS[kind].field_names)
        fields = F.array_join(F.array(*EXTRACTS[kind].field_names), "|")
        parts.append(mapped.select(F.col("file_id").cast("bigint").alias("doc_id"), F.lit(kind).alias("source_kind"), "row_number", fields.alias("mapped")))
    return all_rows(parts)


@query(
    "WITH sized AS (SELECT doc_id, len(string_split(text, chr(10))) AS n_rows FROM documents WHERE len(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda x: x <> '')) > 0) "
    "SELECT doc_id, CASE "
    + " ".join(
        f"WHEN doc_id % 4 = {i} AND n_rows < {_LABEL_ROW} THEN '"
        + (f"headerless positional mapping applied for {k}" if all(f.position is not None for f in EXTRACTS[k].fields if f.needed) else "")
        + "'"
        for i, k in enumerate(_FOUR)
    )
    + " ELSE '' END AS warnings FROM sized"
)
def sheet_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of all warnings of each sheet."""
    report = sheet_report(_headed_sheets(spark, sf_dir))
    return report.select(F.col("file_id").cast("bigint").alias("doc_id"), F.array_join("warnings", "; ").alias("warnings"))
