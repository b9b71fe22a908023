"""What the physical plans have to keep at scale."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from bookfold.operators.dedupe import latest_rows
from bookfold.operators.enrich import with_master
from bookfold.operators.files import latest_per_kind
from bookfold.operators.quality import unmatched_sample
from bookfold.showcase import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_group_limit_runs_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    text = plan(latest_rows(events, ["user_id"], "ts", ["event_id"]))
    assert re.search(r"WindowGroupLimit.*Final.*Exchange.*WindowGroupLimit.*Partial", text, re.DOTALL)
    manifest = events.select(F.col("event_type").alias("source_kind"), F.lit("x").alias("target_month"), F.col("ts").alias("modified_time"))
    assert plan(latest_per_kind(manifest, "202401")).count("WindowGroupLimit") == 2


def test_sample_joins_five_keys_without_shuffling_the_facts(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    text = plan(unmatched_sample(documents, labels, ["doc_id"], ["doc_id"], ["source"]))
    assert "TakeOrderedAndProject(limit=5" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_hot_key_of_the_enrichment_join_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
        )
        master = spark.createDataFrame([("hot", "name"), ("1", "one")], "k string, name string")
        joined = with_master(facts, master, ["k"], {"name": "matched"})
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.groupBy("matched").count()
        assert {r["matched"]: r["count"] for r in rows.collect()} == {"name": 20_000, "one": 1, None: 39_999}
        collected = with_master(facts, master, ["k"], {"name": "matched"})
        collected.collect()
        assert "skew=true" in plan(collected)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_scans_read_only_what_they_need(spark):
    text = plan(queries()["unmatched_check"](spark, SF))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == ["doc_id:bigint", "doc_id:bigint"]


@pytest.mark.parametrize("name", ["enrich_sales", "source_monthly_product_sales", "header_detect", "mapped_row", "quality_report"])
def test_no_cross_joins(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_only_the_chosen_files_are_opened(spark, folder):
    from test_monthly_run import write_landing

    from bookfold.sources.landing import choose_files, file_contents, manifest

    landing = write_landing(folder)
    for i in range(3):
        with open(f"{landing}/other{i}.bin", "wb") as out:
            out.write(b"x" * 50_000)
    contents = file_contents(spark, landing, choose_files(manifest(spark, landing)))
    assert contents.count() == 4
    contents.collect()
    scan = contents._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 4
