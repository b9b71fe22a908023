"""Assertions in the plan, run states, rejected rows, scripts and bucketed joins."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from bookfold.operators.assertions import gated, one_file_per_kind, raised_message
from bookfold.operators.audit import last_states, rejected_rows
from bookfold.plans import scripts
from bookfold.schemas import raw_schema, source_schema
from bookfold.sources.bucketed import enriched_and_unmatched, write_bucketed

NOW = datetime(2025, 7, 1, tzinfo=timezone.utc)


def message_of(df):
    with pytest.raises(Exception) as caught:
        df.collect()
    return raised_message(caught.value)


def test_one_file_per_kind(spark):
    kinds = spark.createDataFrame([(0, "pm", "Master"), (1, "ac", "Authors"), (2, "ep", "Statements")], "place int, source_kind string, label string")
    newest = lambda *rows: spark.createDataFrame(rows, "source_kind string, name string, n int")
    good = one_file_per_kind(newest(("ep", "e.xlsx", 3), ("pm", "p.xls", 1), ("ac", "a.xls", 2), ("other", "x", 9)), kinds)
    assert sorted(tuple(r) for r in good.collect()) == [(0, "pm", "p.xls", 1), (1, "ac", "a.xls", 2), (2, "ep", "e.xlsx", 3)]
    assert message_of(one_file_per_kind(newest(("ac", "a.xls", 2), ("ac", "b.xls", 2)), kinds)) == "required source file not found: Master, Statements"
    tied = newest(("ep", "e.xlsx", 3), ("pm", "p.xls", 1), ("ac", "a.xls", 2), ("ac", "b.xls", 2))
    assert message_of(one_file_per_kind(tied, kinds)) == "multiple latest files for Authors: b.xls, a.xls"
    assert message_of(one_file_per_kind(newest(("zz", "z", 1)), kinds)) == "required source file not found: Master, Authors, Statements"


def test_the_gate(spark):
    findings = spark.createDataFrame([("a", 2), ("b", 3)], "check_name string, error_count long")
    rows = lambda *counts: spark.createDataFrame([(c,) for c in counts], "row_count long")
    assert tuple(gated(findings, rows(0, 4), fail_on_findings=False).first()) == (4, 5)
    assert tuple(gated(findings.limit(0), rows(1)).first()) == (1, 0)
    assert message_of(gated(findings, rows(1))) == "quality checks found 5 errors"
    assert message_of(gated(findings, rows(0, 0), fail_on_findings=False)) == "the number of refined rows is 0"
    # Kept when only the other column is asked for.
    assert message_of(gated(findings, rows(1)).select("source_rows")) == "quality checks found 5 errors"


def test_states_of_good_failed_running_and_lost_runs(spark):
    at = lambda minutes: NOW - timedelta(minutes=minutes)
    events = [
        ("good", "RUNNING", at(90), 0, ""), ("good", "LOADED", at(80), 7, ""), ("good", "LOADED", at(79), 5, ""), ("good", "SUCCESS", at(70), 0, ""),
        ("bad", "RUNNING", at(90), 0, ""), ("bad", "FAILED", at(85), 0, "disk full"),
        ("cut", "RUNNING", at(200), 0, ""), ("cut", "LOADED", at(190), 3, ""),
        ("busy", "RUNNING", at(5), 0, None),
        ("instant", "SUCCESS", at(90), 0, ""), ("instant", "RUNNING", at(90), 0, ""),
        (None, "RUNNING", at(1), None, None),
    ]
    frame = spark.createDataFrame(events, "run_id string, status string, happened_at timestamp, n_rows long, error_message string")
    states = {r.run_id: r for r in last_states(frame, ["run_id"], F.lit(NOW), 3600).collect()}
    assert {k: r.status for k, r in states.items()} == {"good": "SUCCESS", "bad": "FAILED", "cut": "LOST", "busy": "RUNNING", "instant": "SUCCESS", None: "RUNNING"}
    assert (states["good"].n_rows, states["good"].n_events, states["bad"].error_message, states["cut"].error_message) == (12, 4, "disk full", None)
    assert states[None].n_rows == 0
    assert last_states(frame.limit(0), ["run_id"], F.lit(NOW), 1).count() == 0


def raw_rows(spark, *rows):
    schema = raw_schema("product_master")
    full = [tuple({**{f.name: "" for f in schema}, "row_number": i, "target_month": "202506", "loaded_at": NOW, "source_file_id": "f", "source_sheet_name": "s", **row}[f.name] for f in schema) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, schema)


def test_rejected_rows_tell_why(spark):
    raw = raw_rows(spark, {"product_code": "P1", "title": "t", "price": "12"}, {"product_code": " ", "title": "", "price": "abc"}, {"product_code": "P2", "title": "t", "sales_start_date": "2025/13/01"}, {"target_month": "202505"})
    found = {r.row_number: (r.left_out, r.reasons) for r in rejected_rows("product_master", raw, "202506").collect()}
    assert found == {1: (True, ["product_code is blank", "title is blank", "price is no money: abc"]), 2: (False, ["sales_start_date is no date: 2025/13/01"])}


def test_scripts_take_parameters(spark):
    raw_rows(spark, {"product_code": "　P1 ", "title": "t", "price": "￥1,200"}, {"product_code": "P1", "title": "u"}, {"product_code": "", "title": "x"}, {"target_month": "202505", "product_code": "Q", "title": "q"}).createOrReplaceTempView("test_raw")
    built = scripts.build_master(spark, "test_raw", "202506")
    assert [f.name for f in built.schema] == source_schema("product_master").fieldNames()
    assert sorted((r.product_code, r.title, None if r.price is None else float(r.price)) for r in built.collect()) == [("P1", "t", 1200.0), ("P1", "u", None)]
    built.createOrReplaceTempView("test_master")
    assert sorted(tuple(r) for r in scripts.check_master(spark, "test_master", "202506").collect()) == [
        ("source_product_master_duplicate_key", 1), ("source_product_master_required_null", 0), ("source_product_master_row_count_zero", 0),
    ]
    # A value is a value: it does not become part of the script.
    assert scripts.build_master(spark, "test_raw", "202506' OR '1'='1").count() == 0
    assert sorted(scripts.check_master(spark, "test_master", "190001").collect())[-1].error_count == 1


def test_scripted_rows_stay_off_the_driver(spark):
    raw_rows(spark, {"product_code": "P1", "title": "t"}).createOrReplaceTempView("test_raw")
    for month in ("202506", "190001"):
        built = scripts.build_master(spark, "test_raw", month)
        plan = built._jdf.queryExecution().executedPlan().toString()
        assert "LocalTableScan" not in plan and "Scan parquet" in plan
        assert built.count() == (month == "202506")


def test_bucketed_joins_do_not_shuffle(spark, folder):
    facts = spark.range(0, 5000, 1, 8).select((F.col("id") % 300).alias("k"), F.col("id").alias("v"))
    master = spark.range(0, 200).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    other = spark.range(100, 400).select(F.col("id").alias("k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [write_bucketed(df, f"{folder}/{i}", ["k"], 8) for i, df in enumerate((facts, master, other))]
        enriched, unmatched = enriched_and_unmatched(tables[0], tables[1], {"master": tables[1], "other": tables[2]}, ["k"], {"name": "found"})
        text = enriched._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
        counts = unmatched._jdf.queryExecution().executedPlan().toString()
        # Only the totals of the two counts are exchanged, above the joins.
        assert counts.count("Exchange") == 2 and counts.count("Exchange SinglePartition") == 2
        assert {r.table_name: r.error_count for r in unmatched.collect()} == {"master": facts.filter("k >= 200").count(), "other": facts.filter("k < 100").count()}
        assert enriched.filter("found is not null").count() == facts.filter("k < 200").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
