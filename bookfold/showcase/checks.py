"""Quality checks, on the refined tables and on the driver tables as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.operators import quality as q
from bookfold.operators.key_counts import KeyCounts
from bookfold.operators.metadata import month_count as count_of_month
from bookfold.operators.metadata import total_month_count as total_of_month
from bookfold.plans.check_states import findings_from_states
from bookfold.plans.source_checks import (
    check_counts,
    raw_conversion_failures,
    sales_month_mismatch,
)
from bookfold.schemas import EXTRACTS
from bookfold.session import shared_folder
from bookfold.showcase.frames import MONTH, RAW_SQL, raw_frame, table
from bookfold.showcase.refined import refined_frames, sql_reference, sql_sales, written_tables
from bookfold.showcase.registry import SQL_REFINE, query, sql_blank_to_null
from bookfold.sources.layers import QUALITY_RESULTS, Layers

TABLES = (
    f"WITH source_product_master AS ({sql_reference('product_master')}), "
    f"source_author_conditions AS ({sql_reference('author_conditions')}), "
    f"source_ep_statement_detail AS ({sql_reference('ep_statement_detail')}), "
    f"source_monthly_product_sales AS ({sql_sales()}) "
)
_ROW = ["source_file_id", "source_sheet_name", "row_number"]


def _sample(rows: str, shown: list[str], order: list[str]) -> str:
    """``rows`` -> JSON of the first five in ``order``."""
    by = ", ".join(f"{c} NULLS FIRST" for c in order)
    packed = ", ".join(f"{c} := {c}" for c in shown)
    return f"(SELECT CAST(to_json(list(struct_pack({packed}) ORDER BY {by})) AS VARCHAR) FROM (SELECT * FROM ({rows}) ORDER BY {by} LIMIT 5))"


def _finding(name: str, table_name: str, count: str, sample: str = "NULL") -> str:
    return (
        f"SELECT '{name}' AS check_name, 'ERROR' AS severity, '{table_name}' AS table_name, "
        f"CAST(({count}) AS BIGINT) AS error_count, {sample} AS sample_json"
    )


def _null_finding(name: str, table_name: str, required: list[str], shown: list[str]) -> str:
    failing = " OR ".join(f"{c} IS NULL" for c in required)
    rows = f"SELECT *, CASE WHEN {failing} THEN 0 ELSE 1 END AS passes FROM {table_name}"
    count = f"SELECT count(*) FILTER (WHERE {failing}) FROM {table_name}"
    return _finding(name, table_name, count, _sample(rows, shown, ["passes", *_ROW]))


def _unmatched_finding(name: str, other: str, shown: list[str]) -> str:
    joined = (
        f"SELECT s.*, CASE WHEN o.product_code IS NULL THEN 0 ELSE 1 END AS passes FROM source_monthly_product_sales s "
        f"LEFT JOIN {other} o ON s.product_code = o.product_code AND s.target_month = o.target_month"
    )
    order = ["passes", "product_code", "target_month", *_ROW]
    return _finding(
        name, "source_monthly_product_sales", f"SELECT count(*) FROM ({joined}) WHERE passes = 0", _sample(joined, shown, order)
    )


def _duplicate_finding(table_name: str, keys: list[str]) -> str:
    groups = f"SELECT {', '.join(keys)}, count(*) AS duplicate_count FROM {table_name} GROUP BY ALL HAVING count(*) > 1"
    return _finding(
        f"{table_name}_duplicate_key", table_name, f"SELECT count(*) FROM ({groups})", _sample(groups, [*keys, "duplicate_count"], keys)
    )


ALL_CHECKS = " UNION ALL ".join(
    [
        _null_finding(
            "source_product_master_required_null",
            "source_product_master",
            ["product_code", "title", "target_month"],
            ["product_code", "title"],
        ),
        _null_finding(
            "source_author_conditions_required_null",
            "source_author_conditions",
            ["product_code", "author_name", "target_month"],
            ["product_code", "author_name"],
        ),
        _null_finding(
            "source_ep_statement_detail_required_null",
            "source_ep_statement_detail",
            ["electronic_publication_code", "store_name", "target_month"],
            ["electronic_publication_code", "store_name"],
        ),
        _null_finding(
            "source_monthly_product_sales_required_null",
            "source_monthly_product_sales",
            ["product_code", "target_month"],
            ["product_code", "product_name"],
        ),
        _null_finding(
            "electronic_publication_code_missing_after_completion",
            "source_monthly_product_sales",
            ["electronic_publication_code"],
            ["product_code", "product_name"],
        ),
        _unmatched_finding(
            "monthly_sales_product_master_unmatched", "source_product_master", ["product_code", "product_name"]
        ),
        _unmatched_finding(
            "monthly_sales_author_conditions_unmatched",
            "source_author_conditions",
            ["product_code", "electronic_publication_code"],
        ),
        _duplicate_finding("source_product_master", ["product_code"]),
        _duplicate_finding("source_author_conditions", ["product_code", "author_identifier_id"]),
        *(
            _finding(
                f"{e.source_table}_row_count_zero",
                e.source_table,
                f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {e.source_table}",
            )
            for e in EXTRACTS.values()
        ),
    ]
)
_FINDINGS = f"{TABLES} SELECT * FROM ({ALL_CHECKS}) WHERE error_count > 0"


@query(f"{TABLES} SELECT check_name, table_name, error_count FROM ({ALL_CHECKS})")
def source_check_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_counts(written_tables(spark, sf_dir), MONTH)


@query(_FINDINGS)
def source_quality_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings_from_states(written_tables(spark, sf_dir), MONTH)


@query(f"SELECT 'r1' AS run_id, '{MONTH}' AS target_month, * FROM ({_FINDINGS})")
def source_quality_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run stored twice keeps one set of results; a run without findings stores none."""
    layers = Layers(spark, shared_folder(spark, "findings"))
    stamp = {"checked_at": F.current_timestamp(), "target_month": F.lit(MONTH)}
    found = findings_from_states(written_tables(spark, sf_dir), MONTH).withColumns(stamp)
    layers.replace_run("r1", found.filter("table_name = 'source_product_master'"))
    layers.replace_run("r2", found)
    layers.replace_run("r2", found.filter("error_count < 0"))
    layers.replace_run("r1", found)
    return layers.read(QUALITY_RESULTS).drop("checked_at")


@query(f"SELECT CAST(coalesce(sum(error_count), 0) AS BIGINT) AS total_error_count FROM ({_FINDINGS})")
def source_quality_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = check_counts(written_tables(spark, sf_dir), MONTH).withColumn("severity", F.lit(q.SEVERITY))
    return q.total_errors(counted)


@query(
    f"{TABLES} SELECT 'monthly_sales_target_month_mismatch' AS check_name, 'source_monthly_product_sales' AS table_name, "
    "count(*) FILTER (WHERE regexp_replace(accounting_month, '[^0-9]', '', 'g') <> target_month) AS error_count "
    "FROM source_monthly_product_sales"
)
def month_mismatch_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_month_mismatch(refined_frames(spark, sf_dir)["source_monthly_product_sales"])


@query(
    " UNION ALL ".join(
        f"SELECT '{kind}' AS source_kind, '{f.name}' AS column_name, count(*) FILTER (WHERE "
        f"{sql_blank_to_null(f.name)} IS NOT NULL AND {SQL_REFINE[f.refined_type](f.name)} IS NULL) AS error_count "
        f"FROM ({RAW_SQL[kind]})"
        for kind, e in EXTRACTS.items()
        for f in e.fields
        if f.refined_type != "text"
    )
)
def conversion_failure_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.all_rows(
        [
            raw_conversion_failures(kind, raw_frame(spark, sf_dir, kind), MONTH).select(
                F.lit(kind).alias("source_kind"), "column_name", "error_count"
            )
            for kind in EXTRACTS
        ]
    )


# The same operators on the driver tables.

_ORDER_BLANKS = (
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS priority, "
    "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS status FROM orders"
)
_PRIORITY_FAILS = "priority IS NULL OR status IS NULL"


def _order_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END").alias("priority"),
        F.expr("CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END").alias("status"),
    )


@query(
    f"SELECT 'orders_required_null' AS check_name, 'orders' AS table_name, count(*) FILTER (WHERE {_PRIORITY_FAILS}) AS error_count "
    f"FROM ({_ORDER_BLANKS}) UNION ALL SELECT 'orders_status_missing', 'orders', count(*) FILTER (WHERE status IS NULL) FROM ({_ORDER_BLANKS})"
)
def required_null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = {"orders_required_null": q.any_null("priority", "status"), "orders_status_missing": q.any_null("status")}
    return q.predicate_counts(_order_blanks(spark, sf_dir), "orders", failing)


@query(
    "SELECT 'documents_unlabelled' AS check_name, 'documents' AS table_name, count(*) AS error_count "
    "FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)"
)
def unmatched_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return q.unmatched_count(documents, labels, ["doc_id"], "documents_unlabelled", "documents")


_LINE_KEYS = ["l_orderkey", "l_linenumber"]
_LINE_GROUPS = "SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem GROUP BY ALL HAVING count(*) > 1"


@query(f"SELECT 'lineitem_duplicate_key' AS check_name, 'lineitem' AS table_name, count(*) AS error_count FROM ({_LINE_GROUPS})")
def duplicate_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.duplicate_count(table(spark, sf_dir, "lineitem"), _LINE_KEYS, "lineitem_duplicate_key", "lineitem")


@query(_LINE_GROUPS)
def duplicates_across_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads merged into one state, the second of them twice."""
    lines = table(spark, sf_dir, "lineitem")
    state = KeyCounts(spark, shared_folder(spark, "key-counts"), lines.select(*_LINE_KEYS).schema)
    for load in (0, 1, 2, 1):
        state.merge(f"load-{load}", lines.filter(F.col("l_suppkey") % 3 == load))
    return state.duplicates()


@query(_LINE_GROUPS)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.duplicate_keys(table(spark, sf_dir, "lineitem"), _LINE_KEYS)


_ZERO = {"orders": "o_orderkey >= 0", "customer": "c_custkey < 0", "events": "ts < TIMESTAMP '1970-01-02 00:00:00'"}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}_row_count_zero' AS check_name, '{name}' AS table_name, "
        f"CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS error_count FROM {name} WHERE {condition}"
        for name, condition in _ZERO.items()
    )
)
def row_count_zero_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.all_rows(
        [
            q.predicate_counts(table(spark, sf_dir, name).filter(condition), name, {}, f"{name}_row_count_zero")
            for name, condition in _ZERO.items()
        ]
    )


_SAMPLED = f"SELECT *, CASE WHEN {_PRIORITY_FAILS} THEN 0 ELSE 1 END AS passes FROM ({_ORDER_BLANKS})"


@query(f"SELECT {_sample(_SAMPLED, ['priority', 'status'], ['passes', 'o_orderkey'])} AS sample_json")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanks = _order_blanks(spark, sf_dir)
    return q.row_sample(blanks, q.any_null("priority", "status"), ["priority", "status"], ["o_orderkey"])


_UNLABELLED = (
    "SELECT d.doc_id, d.lang, d.source, CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS passes "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)
_REPORT = " UNION ALL ".join(
    [
        _finding(
            "orders_required_null",
            "orders",
            f"SELECT count(*) FROM ({_ORDER_BLANKS}) WHERE {_PRIORITY_FAILS}",
            _sample(_SAMPLED, ["priority", "status"], ["passes", "o_orderkey"]),
        ),
        _finding("orders_row_count_zero", "orders", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM orders"),
        _finding(
            "documents_unlabelled",
            "documents",
            f"SELECT count(*) FROM ({_UNLABELLED}) WHERE passes = 0",
            _sample(_UNLABELLED, ["doc_id", "lang"], ["passes", "doc_id", "source"]),
        ),
        _finding(
            "lineitem_duplicate_key",
            "lineitem",
            f"SELECT count(*) FROM ({_LINE_GROUPS})",
            _sample(_LINE_GROUPS, [*_LINE_KEYS, "duplicate_count"], _LINE_KEYS),
        ),
    ]
)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanks, lines = _order_blanks(spark, sf_dir), table(spark, sf_dir, "lineitem")
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    failing = q.any_null("priority", "status")
    counts = q.all_rows(
        [
            q.predicate_counts(blanks, "orders", {"orders_required_null": failing}, "orders_row_count_zero"),
            q.unmatched_count(documents, labels, ["doc_id"], "documents_unlabelled", "documents"),
            q.duplicate_count(lines, _LINE_KEYS, "lineitem_duplicate_key", "lineitem"),
        ]
    )
    samples = [
        q.Check("orders_required_null", "orders", q.row_sample(blanks, failing, ["priority", "status"], ["o_orderkey"])),
        q.Check(
            "documents_unlabelled", "documents", q.unmatched_sample(documents, labels, ["doc_id"], ["doc_id", "lang"], ["source"])
        ),
        q.Check("lineitem_duplicate_key", "lineitem", q.duplicate_sample(lines, _LINE_KEYS)),
    ]
    return q.findings(counts, samples)


@query(f"SELECT * FROM ({_REPORT}) WHERE error_count > 0")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir)


@query(f"SELECT CAST(coalesce(sum(error_count), 0) AS BIGINT) AS total_error_count FROM ({_REPORT}) WHERE error_count > 0")
def quality_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.total_errors(_report(spark, sf_dir))


_ORDER_MONTH = "substr(CAST(o_orderdate AS STRING), 1, 4) || substr(CAST(o_orderdate AS STRING), 6, 2)"
_SHIP_MONTH = "substr(CAST(l_shipdate AS STRING), 1, 4) || substr(CAST(l_shipdate AS STRING), 6, 2)"
_COUNTED_MONTH = "199705"


def _with_month(df: DataFrame, stamp: str) -> DataFrame:
    return df.select(F.date_format(stamp, "yyyyMM").alias("target_month"))


@query(f"SELECT count(*) AS row_count FROM orders WHERE {_ORDER_MONTH} = '{_COUNTED_MONTH}'")
def month_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_of_month(_with_month(table(spark, sf_dir, "orders"), "o_orderdate"), _COUNTED_MONTH)


@query(
    f"SELECT CAST(sum(row_count) AS BIGINT) AS row_count FROM (SELECT count(*) AS row_count FROM orders WHERE {_ORDER_MONTH} = "
    f"'{_COUNTED_MONTH}' UNION ALL SELECT count(*) FROM lineitem WHERE {_SHIP_MONTH} = '{_COUNTED_MONTH}')"
)
def total_month_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = [
        _with_month(table(spark, sf_dir, "orders"), "o_orderdate"),
        _with_month(table(spark, sf_dir, "lineitem"), "l_shipdate"),
    ]
    return total_of_month(months, _COUNTED_MONTH)


