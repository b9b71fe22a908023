"""The refined tables built for a set of months, from raw tables that hold four."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.plans.monthly_run import build_source
from bookfold.plans.refine import SALES
from bookfold.schemas import EXTRACTS, LINEAGE
from bookfold.session import shared_folder, together
from bookfold.showcase.frames import RAW_SQL, derived
from bookfold.showcase.refined import newest_first, shown, sql_typed
from bookfold.showcase.registry import query, sql_blank_to_null
from bookfold.sources.layers import Layers

ALL_MONTHS = ("202504", "202505", "202506", "202507")
WANTED = ("202505", "202507")
#: Every tenth row changes its month with the day of the load, so that its loads fall into different months.
_MONTH_INDEX = "(row_number + CASE WHEN row_number % 10 = 3 THEN EXTRACT(DAY FROM loaded_at) ELSE 0 END) % 4"
_BY_INDEX = f"CASE {_MONTH_INDEX} " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(ALL_MONTHS)) + " END"
_IDENTITY = "source_file_id, source_sheet_name, row_number, target_month"
_SHOWN = "source_file_id, source_file_name, source_sheet_name, CAST(floor(epoch(loaded_at)) AS BIGINT) AS loaded_at"


def _spread_over_months(kind: str) -> str:
    columns = ", ".join(("row_number", *LINEAGE, *EXTRACTS[kind].field_names))
    return f"SELECT {_BY_INDEX} AS target_month, {columns} FROM ({RAW_SQL[kind]})"


MONTHS_SQL = {kind: _spread_over_months(kind) for kind in EXTRACTS}
_IN_SET = "target_month IN (" + ", ".join(f"'{m}'" for m in WANTED) + ")"


def _sql_reference(kind: str) -> str:
    keys = " AND ".join(f"{sql_blank_to_null(k)} IS NOT NULL" for k in EXTRACTS[kind].key_fields)
    return (
        f"SELECT target_month, row_number, {sql_typed(kind)}, {_SHOWN} "
        f"FROM (SELECT * FROM ({MONTHS_SQL[kind]}) WHERE {_IN_SET} AND {keys} QUALIFY {newest_first(kind, _IDENTITY)})"
    )


def _sql_sales() -> str:
    own = [f.name for f in EXTRACTS[SALES].fields if f.name != "electronic_publication_code"]
    return (
        f"WITH pm AS ({_sql_reference('product_master')}), latest AS (SELECT * FROM ({MONTHS_SQL[SALES]}) WHERE {_IN_SET} "
        f"QUALIFY {newest_first(SALES, _IDENTITY)}), typed AS (SELECT target_month, row_number, {sql_typed(SALES)}, {_SHOWN} FROM latest) "
        f"SELECT s.target_month, s.row_number, {', '.join('s.' + c for c in own)}, '01-' || s.product_code AS product_key, "
        "coalesce(s.electronic_publication_code, pm.electronic_publication_code) AS electronic_publication_code, "
        "pm.title AS matched_product_title, pm.author AS matched_author, "
        "s.source_file_id, s.source_file_name, s.source_sheet_name, s.loaded_at "
        "FROM typed s LEFT JOIN pm ON s.product_code = pm.product_code AND s.target_month = pm.target_month WHERE s.product_code IS NOT NULL"
    )


def months_table(spark: SparkSession) -> DataFrame:
    """The calendar of months, those to build marked."""
    return spark.createDataFrame([(m, m in WANTED) for m in ALL_MONTHS], "target_month string, wanted boolean")


def raw_layers(spark: SparkSession, sf_dir: str, kinds: list[str]) -> Layers:
    """Raw tables of all months, as the loads leave them; the tables of other kinds are empty."""
    layers = Layers(spark, shared_folder(spark, "months"))
    layers.ensure()

    def load(kind: str) -> None:
        rows = derived(spark, sf_dir, MONTHS_SQL[kind])
        layers.append(EXTRACTS[kind].raw_table, rows.withColumn("loaded_at", F.col("loaded_at").cast("timestamp")))

    together([lambda kind=kind: load(kind) for kind in kinds])
    return layers


def _built(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    layers = raw_layers(spark, sf_dir, [kind] if kind != SALES else ["product_master", SALES])
    build_source(layers, months_table(spark).filter("wanted"))
    return shown(layers.read(EXTRACTS[kind].source_table))


@query(_sql_reference("product_master"))
def months_product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, "product_master")


@query(_sql_reference("author_conditions"))
def months_author_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, "author_conditions")


@query(_sql_reference("ep_statement_detail"))
def months_ep_statement_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, "ep_statement_detail")


@query(_sql_sales())
def months_product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir, SALES)


@query(
    " UNION ALL ".join(
        f"SELECT '{e.raw_table}' AS table_name, target_month, count(*) AS row_count FROM ({MONTHS_SQL[kind]}) WHERE {_IN_SET} GROUP BY target_month"
        for kind, e in EXTRACTS.items()
    )
)
def months_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of the wanted months in all four tables."""
    layers, wanted = raw_layers(spark, sf_dir, list(EXTRACTS)), months_table(spark).filter("wanted")
    counted = None
    for extract in EXTRACTS.values():
        one = layers.read(extract.raw_table).join(wanted.select("target_month"), "target_month", "left_semi")
        one = one.groupBy("target_month").agg(F.count("*").alias("row_count")).select(F.lit(extract.raw_table).alias("table_name"), "target_month", "row_count")
        counted = one if counted is None else counted.unionByName(one)
    return counted
