"""Audit, gate, scripts and bucketed joins on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.operators import audit, quality
from bookfold.operators.assertions import gated, one_file_per_kind, raised_message
from bookfold.operators.files import latest_per_kind
from bookfold.plans import scripts
from bookfold.plans.source_checks import check_counts
from bookfold.schemas import EXTRACTS
from bookfold.session import shared_folder
from bookfold.showcase.checks import ALL_CHECKS, TABLES
from bookfold.showcase.frames import MONTH, RAW_SQL, derived, raw_frame, table
from bookfold.showcase.refined import shown, sql_reference, written_tables
from bookfold.showcase.registry import SQL_REFINE, query, sql_blank_to_null
from bookfold.sources.bucketed import enriched_and_unmatched, write_bucketed

# Every user is a run. What a run was last heard of decides: some end well, some fail, and the others are cut off.
_NOW, _PATIENCE = "2024-03-01 00:00:00", 45 * 86400
_EVENTS = (
    "SELECT CAST(user_id AS STRING) AS run_id, CASE event_id % 4 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'LOADED' WHEN 2 THEN 'FAILED' ELSE 'SUCCESS' END AS status, "
    "CAST(ts AS TIMESTAMP) AS happened_at, CASE WHEN event_id % 4 = 1 THEN event_id % 100 ELSE 0 END AS n_rows, "
    "CASE WHEN event_id % 4 = 2 THEN 'stopped at ' || CAST(event_id AS STRING) ELSE '' END AS error_message FROM {events}"
)


@query(
    f"WITH heard AS (SELECT *, CASE status WHEN 'RUNNING' THEN 1 WHEN 'LOADED' THEN 2 WHEN 'FAILED' THEN 3 ELSE 4 END AS place FROM ({_EVENTS})) "
    "SELECT run_id, CASE WHEN max((happened_at, place, status))[3] IN ('FAILED', 'SUCCESS') THEN max((happened_at, place, status))[3] "
    f"WHEN epoch(TIMESTAMP '{_NOW}') - floor(epoch(max(happened_at))) > {_PATIENCE} THEN 'LOST' ELSE max((happened_at, place, status))[3] END AS status, "
    "CAST(floor(epoch(min(happened_at))) AS BIGINT) AS began_at, CAST(floor(epoch(max(happened_at))) AS BIGINT) AS heard_at, "
    "count(*) AS n_events, CAST(sum(n_rows) AS BIGINT) AS n_rows, (max((happened_at, error_message)) FILTER (WHERE error_message <> ''))[2] AS error_message "
    "FROM heard GROUP BY run_id"
)
def audit_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = derived(spark, sf_dir, _EVENTS).withColumn("happened_at", F.col("happened_at").cast("timestamp"))
    states = audit.last_states(events, ["run_id"], F.lit(_NOW).cast("timestamp"), _PATIENCE)
    return states.withColumns({c: F.unix_timestamp(c) for c in ("began_at", "heard_at")})


def _sql_rejected(kind: str) -> str:
    extract = EXTRACTS[kind]
    blank = [f"CASE WHEN {sql_blank_to_null(k)} IS NULL THEN '{k} is blank' END" for k in extract.key_fields]
    unread = [
        f"CASE WHEN {sql_blank_to_null(f.name)} IS NOT NULL AND {SQL_REFINE[f.refined_type](f.name)} IS NULL THEN '{f.name} is no {f.refined_type}: ' || {f.name} END"
        for f in extract.fields
        if f.refined_type != "text"
    ]
    return (
        f"SELECT '{kind}' AS source_kind, source_file_id, source_sheet_name, row_number, CAST(floor(epoch(loaded_at)) AS BIGINT) AS loaded_at, "
        f"{' OR '.join(f'{sql_blank_to_null(k)} IS NULL' for k in extract.key_fields)} AS left_out, "
        f"list_filter([{', '.join([*blank, *unread])}], lambda x: x IS NOT NULL) AS reasons FROM ({RAW_SQL[kind]})"
    )


@query(
    "SELECT * REPLACE (array_to_string(reasons, '; ') AS reasons) FROM ("
    + " UNION ALL ".join(_sql_rejected(kind) for kind in EXTRACTS)
    + ") WHERE len(reasons) > 0"
)
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.all_rows([audit.rejected_rows(kind, raw_frame(spark, sf_dir, kind), MONTH) for kind in EXTRACTS])
    return found.withColumns({"reasons": F.array_join("reasons", "; "), "loaded_at": F.unix_timestamp("loaded_at")})


_KINDS = "SELECT event_type AS source_kind, min(event_id) AS place, 'the ' || event_type AS label FROM {events} GROUP BY event_type"
_FILES = "SELECT event_type AS source_kind, CAST(event_id AS STRING) AS name, '202401' AS target_month, CAST(CAST(ts AS TIMESTAMP) AS {unit}) AS modified_time FROM {{events}}"


def _newest(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    files = derived(spark, sf_dir, _FILES.format(unit=unit))
    return latest_per_kind(files, "202401").select("source_kind", "name", "target_month")


@query(f"SELECT place, source_kind, name, target_month FROM ({_KINDS}) JOIN ({_FILES.format(unit='TIMESTAMP')}) USING (source_kind) QUALIFY rank() OVER (PARTITION BY source_kind ORDER BY modified_time DESC) = 1")
def asserted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One newest file per kind: the plan gives its rows as the condition holds."""
    return one_file_per_kind(_newest(spark, sf_dir, "TIMESTAMP"), derived(spark, sf_dir, _KINDS)).select("place", "source_kind", "name", "target_month")


def _message(spark: SparkSession, outcome: str, asserted: DataFrame) -> DataFrame:
    """What the plan fails with, or that it passed."""
    try:
        asserted.write.format("noop").mode("overwrite").save()
        message = "passed"
    except Exception as problem:
        message = raised_message(problem)
        if message is None:
            raise
    return spark.createDataFrame([(outcome, message)], "outcome string, message string")


_ERRORS = f"{TABLES} SELECT CAST(coalesce(sum(error_count), 0) AS BIGINT) AS e FROM ({ALL_CHECKS})"
_DAY = f"SELECT source_kind, name, label, min(place) OVER (PARTITION BY source_kind) AS place FROM ({_FILES.format(unit='DATE')}) JOIN ({_KINDS}) USING (source_kind) QUALIFY rank() OVER (PARTITION BY source_kind ORDER BY modified_time DESC) = 1"


@query(
    f"SELECT 'missing' AS outcome, 'required source file not found: ' || string_agg(label, ', ' ORDER BY place) AS message FROM ({_KINDS}) WHERE source_kind <> 'click' "
    f"UNION ALL SELECT 'tied', 'multiple latest files for ' || label || ': ' || string_agg(name, ', ' ORDER BY name DESC) FROM ({_DAY}) GROUP BY label, place "
    "HAVING count(*) > 1 QUALIFY row_number() OVER (ORDER BY place) = 1 "
    f"UNION ALL SELECT 'errors', 'quality checks found ' || CAST(e AS VARCHAR) || ' errors' FROM ({_ERRORS}) "
    "UNION ALL SELECT 'ignored', 'passed' UNION ALL SELECT 'empty', 'the number of refined rows is 0'"
)
def assertion_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What plans fail with: kinds without a file, files tied by day, a gate with findings, ignored ones, and no rows."""
    kinds, by_day = derived(spark, sf_dir, _KINDS), _newest(spark, sf_dir, "DATE")
    only_clicks = _newest(spark, sf_dir, "TIMESTAMP").filter("source_kind = 'click'")
    tables = written_tables(spark, sf_dir)
    counts = check_counts(tables, MONTH)
    rows = quality.all_rows([t.agg(F.count("*").alias("row_count")) for t in tables.values()])
    outcomes = {
        "missing": one_file_per_kind(only_clicks, kinds),
        "tied": one_file_per_kind(by_day, kinds),
        "errors": gated(counts, rows),
        "ignored": gated(counts, rows, fail_on_findings=False),
        "empty": gated(counts, rows.withColumn("row_count", F.lit(0).cast("long")), fail_on_findings=False),
    }
    return quality.all_rows([_message(spark, name, asserted) for name, asserted in outcomes.items()])


def _view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


@query(sql_reference("product_master"))
def scripted_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product master built by a script with bound parameters."""
    return shown(scripts.build_master(spark, _view(raw_frame(spark, sf_dir, "product_master"), "scripted_raw"), MONTH))


@query(f"{TABLES} SELECT check_name, error_count FROM ({ALL_CHECKS}) WHERE table_name = 'source_product_master'")
def scripted_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = scripts.build_master(spark, _view(raw_frame(spark, sf_dir, "product_master"), "scripted_raw"), MONTH)
    return scripts.check_master(spark, _view(built, "scripted_master"), MONTH)


_BUCKETS = 16


def _bucketed_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sales lines, parts and parts that have a label document, all bucketed by part."""
    folder = shared_folder(spark, "bucketed")
    sales = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("partkey"), "l_orderkey", "l_linenumber", "l_quantity")
    parts = table(spark, sf_dir, "part").filter("p_partkey % 11 <> 0").select(F.col("p_partkey").alias("partkey"), "p_name", "p_brand")
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("partkey"), "quality")
    return tuple(write_bucketed(df, f"{folder}/{i}", ["partkey"], _BUCKETS) for i, df in enumerate((sales, parts, labelled)))


@query("SELECT l_orderkey, l_linenumber, l_partkey AS partkey, l_quantity, p_name AS name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_partkey % 11 <> 0")
def bucketed_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, parts, labelled = _bucketed_tables(spark, sf_dir)
    return enriched_and_unmatched(sales, parts, {"part": parts, "labels": labelled}, ["partkey"], {"p_name": "name"})[0]


@query(
    "SELECT 'part' AS table_name, count(*) AS error_count FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_partkey % 11 <> 0) "
    "UNION ALL SELECT 'labels', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = l_partkey)"
)
def bucketed_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, parts, labelled = _bucketed_tables(spark, sf_dir)
    return enriched_and_unmatched(sales, parts, {"part": parts, "labels": labelled}, ["partkey"], {"p_name": "name"})[1]
