"""Work that grows with its input: tasks sized by rows, files sized by rows, reasons made once, plain HTML read alike."""

from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from bookfold.functions.cleanse import money, whole_number
from bookfold.operators.audit import rejected_rows
from bookfold.schemas import raw_schema
from bookfold.session import SETTINGS, split_methods, spread
from bookfold.sources import layers as stored
from bookfold.sources.workbooks import _plain_tables, _Tables


def raw_rows(spark, kind, n, **given):
    columns = {f.name: F.lit("").cast(f.dataType) for f in raw_schema(kind)}
    columns |= {"row_number": F.col("id"), "target_month": F.lit("202506"), "loaded_at": F.lit(datetime(2025, 7, 1)), "source_file_id": F.lit("f"), "product_code": F.concat(F.lit("P"), F.col("id").cast("string")), **given}
    return spark.range(n).select([columns[f.name].alias(f.name) for f in raw_schema(kind)])


def test_tasks_are_sized_by_rows(spark):
    rows = spark.range(0, 2000, 1, 8)
    dealt = spread(rows, 100)
    sizes = [len(part) for part in dealt.rdd.glom().collect()]
    assert len(sizes) == 20 and max(sizes) < 200
    assert sorted(r.id for r in dealt.collect()) == list(range(2000))
    assert spread(rows, 1000).rdd.getNumPartitions() == 8


def test_reasons_are_made_once(spark):
    found = rejected_rows("product_master", raw_rows(spark, "product_master", 3, price=F.concat(F.lit("x"), F.col("id").cast("string"))).repartition(3), "202506")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("price is no money: ") == 1
    assert sorted(tuple(r.reasons) for r in found.collect()) == [("title is blank", f"price is no money: x{i}") for i in range(3)]


@pytest.mark.parametrize("text", ["12", " 12 ", "+1,200", "-3", "1.0", "3e1", "", "n/a", "+", "1-", "１２", "1 ", "\t7\n", "9" * 30, "0x1", "1\x00"])
def test_guarded_casts_read_as_before(spark, text):
    cell = spark.createDataFrame([(text,)], "v string")
    plain = cell.select(F.translate("v", ", ", "").try_cast("bigint").alias("n"))
    assert cell.select(whole_number("v").alias("n")).first() == plain.first()
    digits = F.translate("v", ",￥¥ ", "")
    plain = cell.select(F.when(F.octet_length(digits) == F.length(digits), digits.try_cast("decimal(38,9)")).alias("n"))
    assert cell.select(money("v").alias("n")).first() == plain.first()


def test_methods_are_split_in_any_session(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    try:
        spark.conf.set(name, "65535")
        assert split_methods(spark).conf.get(name) == SETTINGS[name]
        spark.conf.set(name, "4000")
        assert split_methods(spark).conf.get(name) == "4000"
    finally:
        spark.conf.set(name, SETTINGS[name])


def test_clustered_files_grow_in_number(spark, folder, monkeypatch):
    monkeypatch.setattr(stored, "ROWS_PER_TASK", 10)
    layers = stored.Layers(spark, folder)
    assert layers.append("raw_monthly_product_sales", raw_rows(spark, "monthly_product_sales", 200), files=2) == 200
    per_file = layers.read("raw_monthly_product_sales").groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 10 and max(r["count"] for r in per_file) < 100
    found = layers.look_up("raw_monthly_product_sales", "202506", {"product_code": "P77", "electronic_publication_code": ""})
    assert [r.row_number for r in found.collect()] == [77]


PLAIN = [
    "<html><body><table><tr><td rowspan=2>a</td><td> b &amp;  c</td></tr><tr><td>x<br>y</td></tr></table></body></html>",
    "<TABLE border=\"0\"><thead><TH>k</thead><tr><TD ColSpan='2'>v &#12288; &lt;</td><td>w<table><td>in</table></td></table> tail &am",
    "<table><tr><td colspan=2 colspan=3>p<td rowspan>q</table>",
    "no table at all & more",
]
ODD = ["<table><!-- x --><td>a</td></table>", "<table><td>a<br/>b</td></table>", "<table><td>1 < 2</td></table>", "<table><td><script>'<td>'</script></td></table>", "<table><td>a</td x=1></table>", "<table><td>a</td", "<!DOCTYPE html><table><td>a</table>"]


@pytest.mark.parametrize("text", PLAIN + ODD)
def test_plain_html_reads_as_by_the_full_parser(text):
    full = _Tables()
    full.feed(text)
    full.close()
    assert _plain_tables(text) == (full.tables if text in PLAIN else None)


def test_a_batch_is_sorted_once(spark, folder, monkeypatch):
    plans = []
    plain = DataFrameWriter.parquet

    def noted(writer, path, *args, **kwargs):
        plans.append(writer._df._jdf.queryExecution().optimizedPlan().toString())
        return plain(writer, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    layers = stored.Layers(spark, folder)
    rows = raw_rows(spark, "product_master", 50, target_month=F.when(F.col("id") % 2 == 0, "202505").otherwise("202506"))
    assert layers.append("raw_product_master", rows.repartition(3), "b", [("f", "")]) == 50
    # The writer sorts by the partition columns what does not come sorted so, and holds all rows of the task twice.
    assert plans[0].startswith("Sort ") and plans[0].count("Sort ") == 1
    assert layers.read_month("raw_product_master", "202505").count() == 25
    assert sorted((r.source_file_id or "", r.n_rows) for r in layers.landed(["raw_product_master"]).collect()) == [("", 50), ("f", 50)]
