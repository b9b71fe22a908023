"""Raw-shaped input derived from the driver tables.

The tables hold no blanks, decorated numbers or reloads, so each frame writes some in by key. The text
of a frame is plain SQL that Spark and DuckDB both read, so both sides of a comparison start equal.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.schemas import EXTRACTS, LINEAGE
from bookfold.session import ROWS_PER_TASK, split_methods, spread

MONTH = "202506"
_PLACEHOLDER = re.compile(r"\{([a-z]+)\}")
#: What tells sales rows apart beside the sheet, which is the same for all.
_SALES_IDENTITY = {"row_number": "CAST(l_linenumber AS BIGINT)", "source_file_id": "'ms-' || CAST(l_orderkey AS STRING)"}
_METADATA = ("row_number", "target_month", *LINEAGE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _str(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def code(prefix: str, key: str, width: int = 9) -> str:
    return f"'{prefix}' || lpad({_str(key)}, {width}, '0')"


def cents(amount: str) -> str:
    return f"round({amount} * 100)"


def money_text(number: str, key: str) -> str:
    """Decorated by key: yen sign, full-width yen sign and commas, minus, exponent, junk."""
    n = f"CAST({number} AS BIGINT)"
    return (
        f"CASE {key} % 6 WHEN 0 THEN '¥' || {_str(n)} || '.5' WHEN 1 THEN '￥ 1,' || lpad({_str(f'{n} % 1000')}, 3, '0') || '.25' "
        f"WHEN 2 THEN {_str(n)} || ',000' WHEN 3 THEN '-' || {_str(n)} WHEN 4 THEN {_str(f'{n} % 9')} || 'e3' ELSE 'n/a' END"
    )


def quantity_text(number: str, key: str) -> str:
    """A comma, a decimal point, an exponent or a plain number by key; only the first and last are whole numbers."""
    n = f"CAST({number} AS BIGINT)"
    return (
        f"CASE {key} % 4 WHEN 0 THEN '1,' || lpad({_str(n)}, 3, '0') WHEN 1 THEN {_str(n)} || '.0' "
        f"WHEN 2 THEN {_str(n)} || 'e1' ELSE ' ' || {_str(n)} END"
    )


def rate_text(number: str, key: str) -> str:
    n = f"CAST({number} AS BIGINT)"
    return f"CASE {key} % 3 WHEN 0 THEN {_str(n)} || '%' WHEN 1 THEN {_str(n)} || '.25 ％' ELSE '' END"


def date_text(key: str) -> str:
    day = f"{key} % 28 + 1"
    return (
        f"CASE {key} % 6 WHEN 0 THEN '2025/6/' || {_str(day)} WHEN 1 THEN '2025-06-' || lpad({_str(day)}, 2, '0') "
        f"WHEN 2 THEN '202506' || lpad({_str(day)}, 2, '0') WHEN 3 THEN ' 2025/06/0' || {_str(f'{key} % 9 + 1')} || ' ' "
        f"WHEN 4 THEN '25/6/1' ELSE '2025/02/30' END"
    )


def _raw(kind: str, source: str, metadata: dict[str, str], fields: dict[str, str]) -> str:
    columns = {**metadata, **{name: "''" for name in EXTRACTS[kind].field_names}, **fields}
    columns.setdefault("target_month", f"'{MONTH}'")
    order = [*_METADATA, *EXTRACTS[kind].field_names]
    return "SELECT " + ", ".join(f"{columns[name]} AS {name}" for name in order) + f" FROM {{{source}}}"


def _products(load: int) -> str:
    title = "p_name" if load == 1 else "CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name || ' II' END"
    return _raw(
        "product_master",
        "part",
        {
            "row_number": "p_partkey",
            "loaded_at": f"CAST('2025-07-0{load} 00:00:00' AS TIMESTAMP)",
            "source_file_id": "'pm-' || p_brand",
            "source_file_name": "'【商品マスタ】report' || p_brand || '.xls'",
            "source_sheet_name": "'html_table_1'",
        },
        {
            "product_code": f"CASE WHEN p_partkey % 11 = 0 THEN '　 ' WHEN p_partkey % 13 = 0 THEN {code('P', 'p_partkey - 1')} "
            f"ELSE {code(' P', 'p_partkey')} || '　' END",
            "electronic_publication_code": f"CASE WHEN p_partkey % 5 = 0 THEN '' ELSE {code('E', 'p_partkey')} END",
            "planning_editor": "p_type",
            "sales_start_date": date_text("p_partkey"),
            "title": title,
            "price": money_text(cents(f"(p_retailprice + {load})"), "p_partkey"),
            "isbn": _str("p_size"),
            "author": "p_brand",
        },
    )


def _authors(load: int) -> str:
    name = "CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE ' Author ' || o_orderpriority END"
    if load == 2:
        name = "CASE WHEN o_orderkey % 9 = 0 THEN '　' ELSE o_orderpriority END"
    return _raw(
        "author_conditions",
        "orders",
        {
            "row_number": "o_orderkey",
            "loaded_at": f"CAST(o_orderdate + INTERVAL '{load}' DAY AS TIMESTAMP)",
            "source_file_id": "'ac-' || o_orderstatus",
            "source_file_name": "'【著者条件一覧】report' || o_orderstatus || '.xls'",
            "source_sheet_name": "'html_table_1'",
        },
        {
            "product_code": f"CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE {code('P', 'o_custkey')} END",
            "electronic_publication_code": code("E", "o_custkey"),
            "author_identifier_id": f"CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE 'A' || {_str('o_orderkey % 3')} END",
            "title": "o_orderstatus",
            "author_name": name,
            "payee_name": name,
            "initial_royalty_rate": rate_text("o_orderkey % 40", "o_orderkey"),
            "revised_rate_sales_quantity": quantity_text("o_orderkey % 500", "o_orderkey"),
            "revised_rate_sales_amount": money_text(cents("o_totalprice"), "o_orderkey"),
        },
    )


def _statements() -> str:
    return _raw(
        "ep_statement_detail",
        "events",
        {
            "row_number": "event_id % 4",
            "loaded_at": "CAST(ts AS TIMESTAMP)",
            "source_file_id": "'ep-' || CAST(user_id AS STRING)",
            "source_file_name": "'電子出版確報明細データICE_' || CAST(user_id AS STRING) || '反映版.xlsx'",
            "source_sheet_name": "event_type",
        },
        {
            "accounting_month": f"substr({_str('ts')}, 1, 4) || '/' || substr({_str('ts')}, 6, 2)",
            "electronic_publication_code": f"CASE WHEN event_id % 7 = 0 THEN '' ELSE {code('E', 'user_id')} END",
            "book_title": "props",
            "list_price": money_text(cents("value"), "event_id"),
            "store_name": "CASE WHEN event_id % 10 = 3 THEN '　' ELSE event_type || ' ' END",
            "sales_quantity": quantity_text("event_id % 900", "event_id"),
        },
    )


def _sales() -> str:
    return _raw(
        "monthly_product_sales",
        "lineitem",
        {
            **_SALES_IDENTITY,
            "loaded_at": "CAST(l_shipdate AS TIMESTAMP)",
            "source_file_name": "'月別' || CAST(l_orderkey AS STRING) || '反映版.xlsx'",
            "source_sheet_name": "'Datalizer1'",
        },
        {
            "accounting_month": f"CASE WHEN l_suppkey % 2 = 0 THEN '2025年06月' ELSE substr({_str('l_shipdate')}, 1, 7) END",
            "product_code": f"CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN ' 　' ELSE {code('P', 'l_partkey')} END",
            "product_name": "' ' || l_returnflag || l_linestatus",
            "sales_company_code": _str("l_suppkey"),
            "list_price": money_text(cents("l_extendedprice"), "l_partkey"),
            "sales_quantity": quantity_text("l_quantity", "l_partkey"),
            "sales_amount": money_text(cents("l_extendedprice"), "l_suppkey"),
            "tax_amount": money_text(cents("l_tax"), "l_orderkey"),
            "electronic_publication_code": f"CASE WHEN l_suppkey % 3 = 0 THEN {code('S', 'l_suppkey')} ELSE '' END",
        },
    )


RAW_SQL = {
    "product_master": f"{_products(1)} UNION ALL {_products(2)}",
    "author_conditions": f"{_authors(1)} UNION ALL {_authors(2)}",
    "ep_statement_detail": _statements(),
    "monthly_product_sales": _sales(),
}


def derived(spark: SparkSession, sf_dir: str, sql: str, rows_per_task: int = ROWS_PER_TASK, keys: Sequence[str] = ()) -> DataFrame:
    """Run frame SQL on Spark; ``{name}`` stands for a driver table. ``keys`` as in ``spread``."""
    names = set(_PLACEHOLDER.findall(sql))
    return split_methods(spark).sql(sql, **{name: spread(table(spark, sf_dir, name), rows_per_task, keys) for name in names})


def for_duckdb(sql: str) -> str:
    return _PLACEHOLDER.sub(r"\1", sql)


def raw_frame(spark: SparkSession, sf_dir: str, kind: str, by_identity: bool = False) -> DataFrame:
    """``by_identity``: for deduplication. Sales, whose rows are hardly ever loaded twice, are brought together by identity
    while they are narrow rows of the driver table."""
    keys = tuple(_SALES_IDENTITY.values()) if by_identity and kind == "monthly_product_sales" else ()
    frame = derived(spark, sf_dir, RAW_SQL[kind], keys=keys)
    return frame.withColumn("loaded_at", F.col("loaded_at").cast("timestamp"))
