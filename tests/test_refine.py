"""Reload order, fan-out and fallback on raw rows."""

from datetime import datetime

from bookfold.operators.dedupe import latest_rows
from bookfold.plans.refine import refine_reference, refine_sales
from bookfold.schemas import raw_schema, source_schema

MONTH = "202506"


def raw(spark, kind, rows):
    """rows: (file, row number, day of load, fields)"""
    schema = raw_schema(kind)
    full = []
    for file, number, day, fields in rows:
        blank = {n: "" for n in schema.fieldNames()}
        meta = {"row_number": number, "target_month": MONTH, "loaded_at": datetime(2025, 7, day)}
        meta |= {"source_file_id": file, "source_file_name": file, "source_sheet_name": "s"}
        full.append(tuple({**blank, **meta, **fields}[n] for n in schema.fieldNames()))
    return spark.createDataFrame(full, schema)


def master(spark, rows):
    return refine_reference("product_master", raw(spark, "product_master", rows), MONTH)


def product(code="P1", title="t", **other):
    return {"product_code": code, "title": title, **other}


def test_schemas(spark):
    pm = master(spark, [])
    assert pm.schema.simpleString() == source_schema("product_master").simpleString()
    sales = refine_sales(raw(spark, "monthly_product_sales", []), pm, MONTH)
    assert sales.schema.simpleString() == source_schema("monthly_product_sales").simpleString()


def test_older_row_reappears_when_the_newest_lacks_a_key(spark):
    pm = master(spark, [("f", 1, 1, product(title="old")), ("f", 1, 2, product(title="　"))])
    assert [r["title"] for r in pm.collect()] == ["old"]


def test_sale_disappears_when_the_newest_lacks_a_key(spark):
    sales = raw(spark, "monthly_product_sales", [("f", 1, 1, {"product_code": "P1"}), ("f", 1, 2, {"product_code": " "})])
    assert refine_sales(sales, master(spark, []), MONTH).count() == 0


def test_shorter_reload_keeps_tail_and_new_file_keeps_both(spark):
    rows = [("f", 1, 1, product("A")), ("f", 2, 1, product("B")), ("f", 1, 2, product("A2")), ("g", 1, 2, product("A2"))]
    assert sorted(r["product_code"] for r in master(spark, rows).collect()) == ["A2", "A2", "B"]


def test_other_months_are_left_out(spark):
    rows = [("f", 1, 1, product("A")), ("f", 2, 1, {**product("B"), "target_month": "202505"})]
    assert [r["product_code"] for r in master(spark, rows).collect()] == ["A"]


def test_sales_join_fans_out_and_falls_back(spark):
    pm = master(spark, [("f", 1, 1, product(electronic_publication_code="E1", author="a")), ("f", 2, 1, product(title="u"))])
    sales = [
        ("m", 1, 1, {"product_code": " P1 "}),
        ("m", 2, 1, {"product_code": "P1", "electronic_publication_code": "own"}),
        ("m", 3, 1, {"product_code": "P8"}),
    ]
    refined = refine_sales(raw(spark, "monthly_product_sales", sales), pm, MONTH)
    columns = ("row_number", "product_key", "electronic_publication_code", "matched_product_title", "matched_author")
    assert sorted((tuple(r) for r in refined.select(*columns).collect()), key=str) == [
        (1, "01-P1", "E1", "t", "a"),
        (1, "01-P1", None, "u", None),
        (2, "01-P1", "own", "t", "a"),
        (2, "01-P1", "own", "u", None),
        (3, "01-P8", None, None, None),
    ]


def test_equal_stamps_pick_the_same_row_whatever_the_partitioning(spark):
    rows = [(1, 5, f"v{i:02d}") for i in range(50)]
    picks = {
        latest_rows(spark.createDataFrame(rows, "k int, t int, v string").repartition(n), ["k"], "t").first()["v"] for n in (1, 3, 7)
    }
    assert picks == {"v49"}
