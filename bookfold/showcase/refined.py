"""The four refined tables, the flagship join and the reload rules."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.operators.dedupe import latest_rows
from bookfold.operators.enrich import with_master
from bookfold.operators.metadata import staged, with_metadata
from bookfold.plans.refine import SALES, refine_reference, refine_sales
from bookfold.schemas import EXTRACTS
from bookfold.session import shared_folder, together
from bookfold.showcase.frames import MONTH, RAW_SQL, code, derived, raw_frame, table
from bookfold.showcase.registry import SQL_REFINE, comparable, query, sql_blank_to_null
from bookfold.sources.layers import Layers

_NEWEST = "source_file_id, source_sheet_name, row_number"
_STAMP = "CAST(floor(epoch(loaded_at)) AS BIGINT) AS loaded_at"


def shown(refined: DataFrame) -> DataFrame:
    """All columns, as any client compares them alike; the time of the load as seconds."""
    return comparable(refined.withColumn("loaded_at", F.unix_timestamp("loaded_at")))


def newest_first(kind: str, identity: str = _NEWEST) -> str:
    ties = ", ".join(f"{c} DESC" for c in ["source_file_name", *EXTRACTS[kind].field_names])
    return f"row_number() OVER (PARTITION BY {identity} ORDER BY loaded_at DESC, target_month DESC, {ties}) = 1"


def sql_typed(kind: str, alias: str = "") -> str:
    return ", ".join(f"{SQL_REFINE[f.refined_type](alias + f.name)} AS {f.name}" for f in EXTRACTS[kind].fields)


def sql_reference(kind: str) -> str:
    keys = " AND ".join(f"{sql_blank_to_null(k)} IS NOT NULL" for k in EXTRACTS[kind].key_fields)
    return (
        f"SELECT target_month, row_number, {sql_typed(kind)}, source_file_id, source_file_name, source_sheet_name, {_STAMP} "
        f"FROM (SELECT * FROM ({RAW_SQL[kind]}) WHERE target_month = '{MONTH}' AND {keys} QUALIFY {newest_first(kind)})"
    )


def sql_sales() -> str:
    own = [f.name for f in EXTRACTS[SALES].fields if f.name not in ("electronic_publication_code",)]
    return (
        f"WITH pm AS ({sql_reference('product_master')}), "
        f"latest AS (SELECT * FROM ({RAW_SQL[SALES]}) WHERE target_month = '{MONTH}' QUALIFY {newest_first(SALES)}), "
        f"typed AS (SELECT target_month, row_number, {sql_typed(SALES)}, source_file_id, source_file_name, "
        f"source_sheet_name, {_STAMP} FROM latest) "
        f"SELECT s.target_month, s.row_number, {', '.join('s.' + c for c in own)}, '01-' || s.product_code AS product_key, "
        "coalesce(s.electronic_publication_code, pm.electronic_publication_code) AS electronic_publication_code, "
        "pm.title AS matched_product_title, pm.author AS matched_author, "
        "s.source_file_id, s.source_file_name, s.source_sheet_name, s.loaded_at "
        "FROM typed s LEFT JOIN pm ON s.product_code = pm.product_code AND s.target_month = pm.target_month "
        "WHERE s.product_code IS NOT NULL"
    )


def refined_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The refined tables as lazy frames, by table name."""
    frames = {}
    for kind, extract in EXTRACTS.items():
        raw = raw_frame(spark, sf_dir, kind, by_identity=True)
        if kind == SALES:
            frames[extract.source_table] = refine_sales(raw, frames["source_product_master"], MONTH)
        else:
            frames[extract.source_table] = refine_reference(kind, raw, MONTH)
    return frames


def written_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The refined tables written as a run does: the master first, sales joining the written master."""
    layers = Layers(spark, shared_folder(spark, "refined"))

    def build(kind: str) -> None:
        raw = raw_frame(spark, sf_dir, kind, by_identity=True)
        if kind == SALES:
            refined = refine_sales(raw, layers.read("source_product_master"), MONTH)
        else:
            refined = refine_reference(kind, raw, MONTH)
        layers.replace(EXTRACTS[kind].source_table, refined)

    together([partial(build, kind) for kind in EXTRACTS if kind != SALES])
    build(SALES)
    return {e.source_table: layers.read(e.source_table) for e in EXTRACTS.values()}


@query(sql_reference("product_master"))
def source_product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_frame(spark, sf_dir, "product_master")
    return shown(refine_reference("product_master", raw, MONTH))


@query(sql_reference("author_conditions"))
def source_author_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_frame(spark, sf_dir, "author_conditions")
    return shown(refine_reference("author_conditions", raw, MONTH))


@query(sql_reference("ep_statement_detail"))
def source_ep_statement_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_frame(spark, sf_dir, "ep_statement_detail")
    return shown(refine_reference("ep_statement_detail", raw, MONTH))


@query(sql_sales())
def source_monthly_product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(refined_frames(spark, sf_dir)["source_monthly_product_sales"])


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    f"'01-' || {code('P', 'l_partkey')} AS product_key, p_name AS matched_name, "
    f"coalesce(CASE WHEN l_suppkey % 3 = 0 THEN {code('S', 'l_suppkey')} END, p_brand) AS code "
    "FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_partkey % 11 <> 0"
)
def enrich_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    master = table(spark, sf_dir, "part").filter("p_partkey % 11 <> 0").withColumnRenamed("p_partkey", "l_partkey")
    joined = with_master(sales, master, ["l_partkey"], {"p_name": "matched_name", "p_brand": "_brand"})
    own = F.expr(f"CASE WHEN l_suppkey % 3 = 0 THEN {code('S', 'l_suppkey')} END")
    return joined.select(
        *sales.columns,
        F.concat(F.lit("01-"), F.expr(code("P", "l_partkey"))).alias("product_key"),
        "matched_name",
        F.coalesce(own, "_brand").alias("code"),
    )


_EVENT_VALUE = "CASE WHEN event_id % 7 = 0 THEN '' ELSE props END"
_EVENT_RANK = "row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id", "ts", F.expr(_EVENT_VALUE).alias("payload")
    )


@query(
    "SELECT user_id, event_type, event_id, payload FROM "
    f"(SELECT user_id, event_type, event_id, ts, {_EVENT_VALUE} AS payload FROM events) WHERE payload <> '' QUALIFY {_EVENT_RANK}"
)
def latest_row_filter_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = _events(spark, sf_dir).filter("payload <> ''")
    return latest_rows(usable, ["user_id", "event_type"], "ts", ["event_id"]).drop("ts")


@query(
    "SELECT user_id, event_type, event_id, payload FROM "
    f"(SELECT * FROM (SELECT user_id, event_type, event_id, ts, {_EVENT_VALUE} AS payload FROM events) QUALIFY {_EVENT_RANK}) "
    "WHERE payload <> ''"
)
def latest_row_dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_rows(_events(spark, sf_dir), ["user_id", "event_type"], "ts", ["event_id"])
    return newest.filter("payload <> ''").drop("ts")


_SHEET_ROWS = (
    "SELECT o_orderkey AS row_number, o_orderstatus AS file_id, o_orderstatus || '.xls' AS file_name, 's1' AS sheet_name, "
    "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS title, o_orderstatus AS raw_code FROM {orders}"
)


@query(
    f"SELECT row_number, '{MONTH}' AS target_month, 1751328000 AS loaded_at, file_id AS source_file_id, file_name AS source_file_name, "
    f"sheet_name AS source_sheet_name, coalesce(title, '') AS raw_title, raw_code FROM ({_SHEET_ROWS})"
)
def staged_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived(spark, sf_dir, _SHEET_ROWS)
    return shown(staged(with_metadata(rows, MONTH, datetime(2025, 7, 1, tzinfo=timezone.utc))))


@query(sql_reference("product_master"))
def reloaded_product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended loads in the raw layer, read back by month, refined, and swapped in twice."""
    layers = Layers(spark, shared_folder(spark, "reload"))
    raw = raw_frame(spark, sf_dir, "product_master")
    for day in ("2025-07-01", "2025-07-02"):
        layers.append("raw_product_master", raw.filter(F.to_date("loaded_at") == day))
    for _ in range(2):
        refined = refine_reference("product_master", layers.read_month("raw_product_master", MONTH), MONTH)
        layers.replace("source_product_master", refined)
    return shown(layers.read("source_product_master"))


_TWO_VERSIONS = (
    f"SELECT 'before' AS seen, * FROM ({sql_reference('product_master')}) WHERE row_number % 2 = 0 "
    f"UNION ALL SELECT 'after', * FROM ({sql_reference('product_master')})"
)


@query(_TWO_VERSIONS)
def replaced_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build that fails half way is not seen; the next one is, and the version before it can still be read."""
    layers = Layers(spark, shared_folder(spark, "versions"))
    table_name = "source_product_master"
    refined = refine_reference("product_master", raw_frame(spark, sf_dir, "product_master"), MONTH)
    layers.replace(table_name, refined.filter("row_number % 2 = 0"))
    broken = refined.withColumn("title", F.when(F.col("row_number") > 1, F.raise_error(F.lit("the build broke"))).otherwise(F.col("title")))
    try:
        layers.replace(table_name, broken)
    except Exception as problem:
        if "the build broke" not in str(problem):
            raise
    before = layers.read(table_name)
    layers.replace(table_name, refined)
    seen = before.withColumn("seen", F.lit("before")).unionByName(layers.read(table_name).withColumn("seen", F.lit("after")))
    return shown(seen)
