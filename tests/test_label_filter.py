"""Cells that cannot hold a known label are kept from Python, and no label is missed."""

from pyspark.sql import functions as F

from bookfold.functions.labels import label_key, may_be_label
from bookfold.operators.headers import header_candidates, measured

_CELLS = ["isbn", "ISBN", " I-S(b)\tN. ", "ＩＳＢＮ", "iſbn", "i\xa0s\x85b　n", "\n_isbn\r", "商品 コード", "（電子出版コード）", "タイトル", "ISBNX", "is bn!", "café", "Straße", "", "-", "é", "x" * 50]


def test_no_label_is_missed(spark):
    cells = spark.createDataFrame([(c,) for c in _CELLS], "v string")
    for keys in (["isbn"], ["isbn", "straße", "x.y"], ["商品コード"], []):
        kept = {r.v for r in cells.filter(F.col("v").rlike(may_be_label(keys))).collect()}
        assert {c for c in _CELLS if label_key(c) in keys} <= kept
        assert not {"ISBNX", "is bn!", "café", "x" * 50} & kept


def test_rows_without_possible_labels_stay_out_of_python(spark):
    rows = [("product_master", "a", "s", i + 1, values) for i, values in enumerate((["plain", "café"], ["x", "I S-B N", "", "書 名"], [], [None, "ＩＳＢＮ", "isbn"]))]
    found = header_candidates(measured(spark.createDataFrame(rows, "source_kind string, file_id string, sheet_name string, row_number long, values array<string>")))
    below = found._jdf.queryExecution().optimizedPlan().toString().split("ArrowEvalPython", 1)[1]
    assert "RLIKE" in below or "rlike" in below
    assert {r.row_number: r.column_map for r in found.collect()} == {2: {"isbn": 1, "title": 3}, 4: {"isbn": 1}}
