"""Counts and samples from grouped states: equal to the plain ones, and one scan a table."""

import random
import re

from pyspark.sql import functions as F

from bookfold.operators import quality as q
from bookfold.operators.key_counts import KeyCounts
from bookfold.operators.samples import Sampled, first_rows
from bookfold.plans.check_states import STATE_KEYS, findings_from_states, matched_keys, table_samples, table_state
from bookfold.plans.source_checks import MISSING_CODE, SALES, UNMATCHED, source_findings
from bookfold.schemas import EXTRACTS, source_schema

MONTH = "202506"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made_tables(spark, seed, n):
    """Few keys and many nulls, so that every check finds something."""
    rng = random.Random(seed)
    tables = {}
    for kind, extract in EXTRACTS.items():
        schema = source_schema(kind)
        rows = []
        for i in range(n):
            row = {f.name: None for f in schema}
            row.update(target_month=MONTH if rng.random() < 0.9 else "202505", row_number=i, source_file_id=rng.choice("ab"), source_sheet_name="s")
            for name in ("product_code", "title", "author_name", "author_identifier_id", "store_name", "electronic_publication_code", "product_name"):
                if name in row:
                    row[name] = rng.choice([None, "x", "y", "z" if kind.startswith("monthly") else "x", str(rng.randrange(6))])
            rows.append(tuple(row[f.name] for f in schema))
        tables[extract.source_table] = spark.createDataFrame(rows, schema).repartition(3)
    return tables


def found(df):
    return sorted(tuple(r) for r in df.select("check_name", "severity", "table_name", "error_count", "sample_json").collect())


def test_findings_equal_the_plain_ones(spark):
    for seed, n in ((1, 60), (2, 7), (3, 0)):
        tables = made_tables(spark, seed, n)
        assert found(findings_from_states(tables, MONTH)) == found(source_findings(tables, MONTH))


def test_one_scan_counts_and_one_samples(spark, folder):
    tables = made_tables(spark, 4, 40)
    stored = {}
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
        stored[name] = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    states = {name: table_state(name, stored[name]) for name in STATE_KEYS}
    assert all(plan(state).count("FileScan") == 1 for state in states.values())
    matched_keys({name: table_state(name, df) for name, df in stored.items()}).write.parquet(f"{folder}/matched")
    matched = spark.read.parquet(f"{folder}/matched")
    failed = {f"{SALES}_required_null", MISSING_CODE, *UNMATCHED}
    text = plan(table_samples(SALES, stored[SALES], failed, matched))
    # One scan of the table, and one of the narrow keys for each of the two unmatched checks.
    assert text.count("FileScan") == 3
    assert "WindowGroupLimit" in text and "CartesianProduct" not in text


def test_first_rows_merge_over_tasks(spark):
    rows = spark.range(0, 5000, 1, 16).select(F.col("id").alias("k"), (F.col("id") % 977).alias("v"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("n"))
    checks = [Sampled("rare", F.when(F.col("k") % 2500 == 2499, 0).otherwise(1), ("k", "n")), Sampled("some", F.when(F.col("v") > 970, 0), ("v",)), Sampled("none", F.when(F.col("k") < 0, 0), ("v",))]
    sampled = {r.check_name: r.sample_json for r in first_rows(rows, checks, ["v", "k"]).collect()}
    assert set(sampled) == {"rare", "some"}
    pairs = sorted((0 if k % 2500 == 2499 else 1, k % 977, k) for k in range(5000))[:5]
    assert re.findall(r'"k":(\d+)', sampled["rare"]) == [str(k) for *_, k in pairs]
    assert sampled["rare"].count("null") == sum(k % 2 for *_, k in pairs)
    assert sampled["some"] == "[" + ",".join(['{"v":971}'] * 5) + "]"


def test_rows_stand_as_often_as_they_match(spark):
    rows = spark.createDataFrame([(1, 3), (2, 1), (3, 9)], "k long, t long")
    (only,) = first_rows(rows, [Sampled("c", F.lit(0), ("k",), F.col("t"))], ["k"]).collect()
    assert only.sample_json == '[{"k":1},{"k":1},{"k":1},{"k":2},{"k":3}]'


def test_key_counts_over_loads(spark, folder):
    rows = lambda *keys: spark.createDataFrame([(k, "x") for k in keys], "k string, v string")
    state = KeyCounts(spark, f"{folder}/state", rows("a").select("k").schema)
    assert state.counts().count() == 0
    assert state.merge("1", rows("a", None, "b")) and state.merge("2", rows("a", None, "c"))
    assert not state.merge("2", rows("a"))
    assert state.merge("3", rows()) and not state.merge("3", rows("z"))
    assert sorted((r.k or "", r.n_rows) for r in state.counts().collect()) == [("", 2), ("a", 2), ("b", 1), ("c", 1)]
    assert sorted((r.k or "", r.duplicate_count) for r in state.duplicates().collect()) == [("", 2), ("a", 2)]
    # The state of earlier loads is all that a further one reads.
    text = plan(state.counts())
    assert text.count("FileScan") == 1
