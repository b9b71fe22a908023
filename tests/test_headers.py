"""Header detection and row mapping on hand-made sheets."""

import pytest

from bookfold.operators.headers import generic_rows, mapped_rows, measured, sheet_report, with_report
from bookfold.schemas import CELLS_SCHEMA, EXTRACTS

HEADER = ["計上年月", "プロダクトコード", "売上数"]


def sheet(spark, kind, rows, file_id="f"):
    data = [(kind, file_id, "n", "s", i, values, None) for i, values in enumerate(rows, start=1)]
    return measured(spark.createDataFrame(data, CELLS_SCHEMA))


def report_of(spark, kind, rows):
    found = sheet_report(sheet(spark, kind, rows)).collect()
    return found[0] if found else None


@pytest.mark.parametrize("row", [1, 2, 30])
def test_header_found_down_to_row_30(spark, row):
    report = report_of(spark, "monthly_product_sales", [["x"]] * (row - 1) + [HEADER, ["2025", "P", "1"]])
    assert (report["header_row"], report["error"], report["width"]) == (row, None, 3)
    assert report["column_map"] == {"accounting_month": 0, "product_code": 1, "sales_quantity": 2}
    assert len(report["warnings"]) == 18 and report["warnings"] == sorted(report["warnings"])


def test_header_in_row_31_is_not_found(spark):
    report = report_of(spark, "monthly_product_sales", [["x"]] * 30 + [HEADER])
    assert report["error"] == "required columns missing for monthly_product_sales: accounting_month, product_code"


def test_first_of_tied_rows_and_first_of_repeated_labels(spark):
    rows = [["商品コード", "商品 コード", "電子出版コード", "（書名）"], ["書名", "電子出版コード", "商品コード"], ["a", "b", "c", "d"]]
    report = report_of(spark, "product_master", rows)
    assert report["header_row"] == 1
    assert report["column_map"] == {"product_code": 0, "electronic_publication_code": 2, "title": 3}


def test_positions_when_a_needed_label_is_missing(spark):
    rows = [["商品コード", "電子出版コード"], ["P1", "i", "E1", "", "", "T"]]
    report = report_of(spark, "product_master", rows)
    assert report["header_row"] is None and report["error"] is None
    assert report["warnings"] == ["headerless positional mapping applied for product_master"]
    mapped = mapped_rows(with_report(sheet(spark, "product_master", rows), sheet_report(sheet(spark, "product_master", rows))), EXTRACTS["product_master"].field_names)
    assert [(r["row_number"], r["product_code"], r["title"], r["author"]) for r in mapped.orderBy("row_number").collect()] == [
        (1, "商品コード", "", ""),
        (2, "P1", "T", ""),
    ]


def test_partly_found_required_labels_name_the_rest(spark):
    report = report_of(spark, "ep_statement_detail", [["計上年月", "書店名"]])
    assert report["error"] == "required columns missing for ep_statement_detail: electronic_publication_code"


def test_header_without_data_and_rows_without_values(spark):
    for rows, expected in (([HEADER], 0), ([HEADER, ["", "", "", "beyond"], ["", "P"]], 1)):
        rows_df = sheet(spark, "monthly_product_sales", rows)
        mapped = mapped_rows(with_report(rows_df, sheet_report(rows_df)), EXTRACTS["monthly_product_sales"].field_names)
        assert mapped.count() == expected


def test_empty_sheets_have_no_report_and_generic_rows_are_padded(spark):
    assert report_of(spark, "product_master", [["", ""], []]) is None
    rows = sheet(spark, "product_master", [["a"], [], ["b", "c,d"]])
    generic = generic_rows(with_report(rows, sheet_report(rows)), 3).orderBy("row_number").collect()
    assert [(r["row_payload_json"], r["col_001"], r["col_002"], r["col_003"]) for r in generic] == [
        ('["a", ""]', "a", "", ""),
        ('["", ""]', "", "", ""),
        ('["b", "c,d"]', "b", "c,d", ""),
    ]
    assert "col_004" not in generic[0]
