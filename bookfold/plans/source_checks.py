"""The quality suite over the four refined tables of one month."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookfold.functions.cleanse import refine
from bookfold.operators import quality as q
from bookfold.schemas import EXTRACTS, ROW_IDENTITY

PRODUCTS = "source_product_master"
AUTHORS = "source_author_conditions"
STATEMENTS = "source_ep_statement_detail"
SALES = "source_monthly_product_sales"
MATCH_KEYS = ["product_code", "target_month"]

# The required fields of each table with the two fields its samples show.
REQUIRED = {
    PRODUCTS: (("product_code", "title", "target_month"), ("product_code", "title")),
    AUTHORS: (("product_code", "author_name", "target_month"), ("product_code", "author_name")),
    STATEMENTS: (
        ("electronic_publication_code", "store_name", "target_month"),
        ("electronic_publication_code", "store_name"),
    ),
    SALES: (("product_code", "target_month"), ("product_code", "product_name")),
}
# The other checks. table, key of the duplicate / matched table, fields in the sample.
MISSING_CODE = "electronic_publication_code_missing_after_completion"
UNMATCHED = {
    "monthly_sales_product_master_unmatched": (PRODUCTS, ("product_code", "product_name")),
    "monthly_sales_author_conditions_unmatched": (AUTHORS, ("product_code", "electronic_publication_code")),
}
DUPLICATE = {
    PRODUCTS: ("product_code",),
    AUTHORS: ("product_code", "author_identifier_id"),
}


def _month_tables(tables: Mapping[str, DataFrame], target_month: str) -> dict[str, DataFrame]:
    return {name: df.filter(F.col("target_month") == target_month) for name, df in tables.items()}


def check_counts(tables: Mapping[str, DataFrame], target_month: str) -> DataFrame:
    """All 13 counts, zeros included."""
    month = _month_tables(tables, target_month)
    parts = []
    for table, (required, _) in REQUIRED.items():
        failing = {f"{table}_required_null": q.any_null(*required)}
        if table == SALES:
            failing[MISSING_CODE] = q.any_null("electronic_publication_code")
        parts.append(q.predicate_counts(month[table], table, failing, f"{table}_row_count_zero"))
    for name, (other, _) in UNMATCHED.items():
        parts.append(q.unmatched_count(month[SALES], month[other], MATCH_KEYS, name, SALES))
    for table, keys in DUPLICATE.items():
        parts.append(q.duplicate_count(month[table], keys, f"{table}_duplicate_key", table))
    return q.all_rows(parts)


def check_samples(tables: Mapping[str, DataFrame], target_month: str, only: Iterable[str] | None = None) -> list[q.Check]:
    """Samples of all checks, or of those named in ``only``. The empty-table checks have none."""
    month = _month_tables(tables, target_month)
    wanted = None if only is None else set(only)
    checks = []

    def add(name: str, table: str, sample: Callable[..., DataFrame], *arguments) -> None:
        if wanted is None or name in wanted:
            checks.append(q.Check(name, table, sample(*arguments)))

    for table, (required, shown) in REQUIRED.items():
        add(f"{table}_required_null", table, q.row_sample, month[table], q.any_null(*required), shown, ROW_IDENTITY)
    _, shown = REQUIRED[SALES]
    add(MISSING_CODE, SALES, q.row_sample, month[SALES], q.any_null("electronic_publication_code"), shown, ROW_IDENTITY)
    for name, (other, shown) in UNMATCHED.items():
        add(name, SALES, q.unmatched_sample, month[SALES], month[other], MATCH_KEYS, shown, ROW_IDENTITY)
    for table, keys in DUPLICATE.items():
        add(f"{table}_duplicate_key", table, q.duplicate_sample, month[table], keys)
    return checks


def source_findings(tables: Mapping[str, DataFrame], target_month: str) -> DataFrame:
    """The suite as one lazy frame."""
    return q.findings(check_counts(tables, target_month), check_samples(tables, target_month))


def sales_month_mismatch(sales: DataFrame) -> DataFrame:
    """Optional check: sales whose accounting month is not the month being built."""
    wrong = {"monthly_sales_target_month_mismatch": q.month_mismatch(F.col("accounting_month"), F.col("target_month"))}
    return q.predicate_counts(sales, SALES, wrong)


def raw_conversion_failures(kind: str, raw: DataFrame, target_month: str) -> DataFrame:
    """Optional check: non-blank numbers and dates of a raw table that have no typed value."""
    typed = {f.name: refine(f.name, f.refined_type) for f in EXTRACTS[kind].fields if f.refined_type != "text"}
    return q.conversion_failures(raw.filter(F.col("target_month") == target_month), typed)
