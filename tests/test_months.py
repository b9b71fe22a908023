"""Builds for a set of months."""

import pytest
from pyspark.sql import functions as F

from bookfold.plans.monthly_run import build_source
from bookfold.plans.refine import refine_reference, refine_sales
from bookfold.schemas import EXTRACTS, KINDS
from bookfold.showcase.months import ALL_MONTHS, WANTED, months_table, raw_layers

SF = "/root/testdata/sf0.001"
SALES = "monthly_product_sales"


@pytest.fixture(scope="module")
def layers(spark):
    return raw_layers(spark, SF, list(KINDS))


def scans(df):
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [leaves.apply(i) for i in range(leaves.size())]


def test_other_months_are_not_read(spark, layers):
    raw = layers.read("raw_author_conditions")
    built = refine_reference("author_conditions", raw, months_table(spark).filter("wanted"))
    assert "dynamicpruning" in built._jdf.queryExecution().executedPlan().toString().lower()
    counted = raw.filter(F.col("target_month").isin(*WANTED))
    counted.collect(), raw.collect(), built.collect()
    read = lambda df: max(s.metrics().apply("numFiles").value() for s in all_scans(df) if s.metrics().contains("numFiles"))
    assert read(built) == read(counted) < read(raw)


def all_scans(df):
    """Scans of an adaptive plan, those inside finished stages too."""
    plan = df._jdf.queryExecution().executedPlan()
    found, waiting = [], [plan]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            waiting.append(node.plan())
        elif name == "FileSourceScanExec":
            found.append(node)
        waiting += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.mark.parametrize("kind", [k for k in KINDS if k != SALES])
def test_a_set_of_months_is_the_months_one_by_one(spark, layers, kind):
    raw = layers.read(EXTRACTS[kind].raw_table)
    together = refine_reference(kind, raw, months_table(spark).filter("wanted"))
    single = refine_reference(kind, raw, WANTED[0]).unionByName(refine_reference(kind, raw, WANTED[1]))
    assert together.count() == single.count() > 0
    assert together.exceptAll(single).isEmpty()


def test_sales_meet_the_master_of_their_month(spark, layers):
    months = months_table(spark).filter("wanted")
    build_source(layers, months)
    master, sales = layers.read("source_product_master"), layers.read("source_monthly_product_sales")
    assert {r[0] for r in sales.select("target_month").distinct().collect()} == set(WANTED)
    raw = layers.read(EXTRACTS[SALES].raw_table)
    single = [refine_sales(raw, master.filter(F.col("target_month") == m), m) for m in WANTED]
    assert sales.exceptAll(single[0].unionByName(single[1])).isEmpty()
    assert sales.count() == sum(s.count() for s in single)


def test_no_month_and_unknown_months_build_nothing(spark, layers):
    raw = layers.read("raw_product_master")
    calendar = months_table(spark)
    assert refine_reference("product_master", raw, calendar.filter("target_month > '209901'")).count() == 0
    repeated = calendar.filter("wanted").union(calendar.filter("wanted"))
    assert refine_reference("product_master", raw, repeated).count() == refine_reference("product_master", raw, calendar.filter("wanted")).count()
    assert len(ALL_MONTHS) >= 3
