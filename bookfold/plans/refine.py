"""The four refined tables, each built from one month of its raw table, or from a set of months.

A set of months is a frame with a column ``target_month``. It meets the raw table in a semi-join on the partition column,
so Spark prunes the other months at run time, when the set is known. Months are built as if one by one: a row that was
loaded for two months stays in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookfold.functions.cleanse import blank_to_null, own_or_master, product_key, refine
from bookfold.operators.dedupe import latest_rows
from bookfold.operators.enrich import with_master
from bookfold.schemas import EXTRACTS, ROW_IDENTITY, source_columns

SALES = "monthly_product_sales"


Months = str | DataFrame


def _of_months(raw: DataFrame, months: Months) -> DataFrame:
    if isinstance(months, str):
        return raw.filter(F.col("target_month") == months)
    # Six digits: however large the frame of months is, a million distinct ones can be broadcast at most.
    wanted = months.filter(F.col("target_month").rlike(r"^\d{6}$")).select("target_month").distinct()
    return raw.join(F.broadcast(wanted), "target_month", "left_semi")


def _identity(months: Months) -> tuple[str, ...]:
    return ROW_IDENTITY if isinstance(months, str) else (*ROW_IDENTITY, "target_month")


def _typed(kind: str, rows: DataFrame) -> DataFrame:
    fields = {f.name: refine(f.name, f.refined_type) for f in EXTRACTS[kind].fields}
    return rows.withColumns(fields)


def _has_keys(kind: str) -> Column:
    present = [blank_to_null(name).isNotNull() for name in EXTRACTS[kind].key_fields]
    return present[0] if len(present) == 1 else present[0] & present[1]


def _in_table_order(kind: str, df: DataFrame) -> DataFrame:
    return df.select([name for name, _ in source_columns(kind)])


def refine_reference(kind: str, raw: DataFrame, months: Months) -> DataFrame:
    """Product master, author conditions or statement detail: rows without a key go before deduplication."""
    usable = _of_months(raw, months).filter(_has_keys(kind))
    return _in_table_order(kind, _typed(kind, latest_rows(usable, _identity(months), "loaded_at")))


def refine_sales(raw: DataFrame, product_master: DataFrame, months: Months) -> DataFrame:
    """Monthly sales: the newest load decides first, rows without a key go afterwards."""
    latest = latest_rows(_of_months(raw, months), _identity(months), "loaded_at").filter(_has_keys(SALES))
    enriched = with_master(
        _typed(SALES, latest),
        product_master,
        ["product_code", "target_month"],
        {
            "electronic_publication_code": "_master_epub",
            "title": "matched_product_title",
            "author": "matched_author",
        },
    )
    completed = enriched.withColumns(
        {
            "product_key": product_key("product_code"),
            "electronic_publication_code": own_or_master("electronic_publication_code", "_master_epub"),
        }
    )
    return _in_table_order(SALES, completed)
