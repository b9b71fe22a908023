"""Replaced tables: what readers see before, during and after."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookfold.sources.snapshots import LOG_SCHEMA, Snapshots

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
RUNS = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("v", T.StringType())])


def frame(spark, n, v):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(v).alias("v"))


def held(df):
    return sorted(tuple(r) for r in df.collect())


def test_readers_follow_the_newest_committed_version(spark, folder):
    table = Snapshots(spark, f"{folder}/t", SCHEMA)
    assert table.read().count() == 0 and table.read().schema == SCHEMA
    assert table.replace(frame(spark, 2, "a")) == 2
    old = table.read()
    assert table.replace(frame(spark, 3, "b")) == 3
    assert held(table.read()) == [(0, "b"), (1, "b"), (2, "b")]
    assert held(old) == held(table.read(number=0)) == [(0, "a"), (1, "a")]
    # The new content may come from the table itself.
    assert table.replace(table.read().filter("k > 0")) == 2
    assert held(table.read()) == [(1, "b"), (2, "b")]
    assert [r["n_rows"] for r in table.log().orderBy("number").collect()] == [2, 3, 2]


def test_a_failed_build_changes_nothing_and_a_rerun_succeeds(spark, folder):
    table = Snapshots(spark, f"{folder}/t", SCHEMA)
    table.replace(frame(spark, 2, "a"))
    broken = frame(spark, 100, "b").repartition(4).withColumn("v", F.when(F.col("k") == 99, F.raise_error(F.lit("boom"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="boom"):
        table.replace(broken)
    assert held(table.read()) == [(0, "a"), (1, "a")]
    # Lost after its data was written and before it was committed.
    frame(spark, 5, "lost").write.parquet(f"{folder}/t/data/version=00000001-lost")
    assert held(table.read()) == [(0, "a"), (1, "a")]
    table.replace(frame(spark, 1, "c"))
    assert held(table.read()) == [(0, "c")]


def test_writers_of_one_number_are_told_apart(spark, folder):
    table = Snapshots(spark, f"{folder}/t", SCHEMA)
    table.replace(frame(spark, 1, "a"))
    first = table.log().first()
    frame(spark, 1, "twin").write.parquet(f"{folder}/t/data/version=zz")
    spark.createDataFrame([("", 0, "zz", 1, first["committed_at"], "")], LOG_SCHEMA).write.mode("append").parquet(f"{folder}/t/log")
    assert held(table.read()) == [(0, "twin")]


def test_parts_have_versions_of_their_own_and_prune(spark, folder):
    table = Snapshots(spark, f"{folder}/t", RUNS, "run_id")
    assert table.read().count() == 0
    result = lambda *values: spark.createDataFrame([(v,) for v in values], "v string")
    table.replace(result("x", "y"), "r1")
    table.replace(result("z"), "r2")
    table.replace(result("w"), "r1")
    table.replace(result(), "r2")
    assert held(table.read()) == [("r1", "w")]
    read = table.read()
    read.collect()
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert table.expire(keep=1) == 2
    assert held(table.read()) == [("r1", "w")]


def test_expired_versions_go_and_the_newest_stay(spark, folder):
    table = Snapshots(spark, f"{folder}/t", SCHEMA)
    for v in "abcd":
        table.replace(frame(spark, 1, v))
    assert table.expire(keep=2) == 2
    assert held(table.read()) == [(0, "d")] and held(table.read(number=2)) == [(0, "c")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        table.read(number=0)
