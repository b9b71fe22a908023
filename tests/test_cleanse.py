"""Column functions on edge rows."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bookfold.functions.cleanse import (
    blank_to_null,
    calendar_date,
    clean_cell,
    clean_cells,
    money,
    month_in_name,
    own_or_master,
    pad_cells,
    payload_json,
    product_key,
    rate,
    rows_json,
    whole_number,
)
from bookfold.functions.labels import label_key, label_keys
from bookfold.operators.files import kind_of


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function("v")).collect()]


CELLS = [None, "", "　x　", "\t\na b\r\n", " y ", "NaN", " nan ", "a　b", "\u001fz\u001c", "nano"]
CLEANED = ["", "", "x", "a b", "y", "", "", "a b", "z", "nano"]


def test_clean_cell(spark):
    assert apply(spark, clean_cell, CELLS) == CLEANED
    df = spark.createDataFrame([(CELLS,)], "v array<string>")
    assert df.select(clean_cells("v")).first()[0] == CLEANED


def test_blank_to_null(spark):
    assert apply(spark, blank_to_null, [None, "", "　 ", " x ", "\u001fx"]) == [None, None, None, "x", "\u001fx"]


def test_money(spark):
    values = ["￥1,234", "¥1 234", "1,234.5", "-5", "1e3", "abc", "", None, "9" * 30, "0.0000000005", "１０", "NaN"]
    assert apply(spark, money, values) == [
        Decimal(1234),
        Decimal(1234),
        Decimal("1234.5"),
        Decimal(-5),
        Decimal(1000),
        None,
        None,
        None,
        None,
        Decimal("0.000000001"),
        None,
        None,
    ]


def test_rate_and_whole_number(spark):
    assert apply(spark, rate, ["10%", "１０％", "8.5 %", "", "5％"]) == [Decimal(10), None, Decimal("8.5"), None, Decimal(5)]
    assert apply(spark, whole_number, ["1,234", "12.0", "+5", "1e3", "12a", "１", " 7 ", ""]) == [
        1234,
        None,
        5,
        None,
        None,
        None,
        7,
        None,
    ]


def test_calendar_date(spark):
    values = ["2025/06/01", "2025-06-01", "20250601", "2025/6/1", " 2025-6-1　", "2025/02/30", "25/6/1", "", None]
    values += ["2025/6-1", "2025-06-01 00:00:00", "2025", "2025/06", "202561", "2025061"]
    found = [None if d is None else d.isoformat() for d in apply(spark, calendar_date, values)]
    assert found == ["2025-06-01"] * 5 + [None] * 10


def test_keys_and_fallback(spark):
    df = spark.createDataFrame([("A", None, "m"), (None, "own", "m")], "c string, o string, m string")
    assert [tuple(r) for r in df.select(product_key("c"), own_or_master("o", "m")).collect()] == [("01-A", "m"), (None, "own")]


def test_names(spark):
    names = ["ICE_2025年06月.xlsx", "x202506", "report1752025061", "2025年13月 202407", "201912-202001", "none"]
    assert apply(spark, month_in_name, names) == ["202506", "202506", "202506", "202407", "201912", None]
    files = [
        "【商品マスタ】report1.xls",
        "【商品マスタ】REPORT.XLS",
        "【商品マスタ】report1.xls.bak",
        "x【著者条件一覧】report.xls",
        "【著者条件一覧】report a\nb.xls",
        "電子出版確報明細データICE_反映版.xlsx",
        "電子出版確報明細データice_2025反映版.XLSX",
        "月別電子出版プロダクト別売上一覧(ICE印税用)_2025年06月反映版.xlsx",
    ]
    assert apply(spark, kind_of, files) == [
        "product_master",
        "product_master",
        None,
        None,
        None,
        "ep_statement_detail",
        "ep_statement_detail",
        "monthly_product_sales",
    ]


def test_label_keys(spark):
    labels = ["（商品）コード", "Ｉ Ｓ-Ｂ_Ｎ", "ｶﾞ・.", "EP_確報コード", "", "バリューコード"]
    df = spark.createDataFrame([(labels,), ([],)], "v array<string>")
    found = [r[0] for r in df.select(label_keys("v")).collect()]
    assert found == [["商品コード", "isbn", "ガ", "ep確報コード", "", "バリューコード"], []]
    assert [label_key(v) for v in labels] == found[0]


@pytest.mark.parametrize(
    "cells",
    [[], ["a", "b"], ["", ""], [","], ['say "x"', "back\\slash"], ["tab\t", "nl\n", "\u0001\u001f\u007f", "é著"], ['","', "a"]],
)
def test_payload_json(spark, cells):
    df = spark.createDataFrame([(cells,)], "v array<string>")
    assert df.select(payload_json("v")).first()[0] == json.dumps(cells, ensure_ascii=False)


def test_pad_and_rows_json(spark):
    df = spark.createDataFrame([(["a"],)], "v array<string>")
    assert df.select(pad_cells("v", F.lit(3)), pad_cells("v", F.lit(0))).first()[:] == (["a", "", ""], ["a"])
    rows = spark.sql("SELECT array(named_struct('a', CAST(NULL AS STRING), 'n', 1L)) AS r")
    assert rows.select(rows_json("r")).first()[0] == '[{"a":null,"n":1}]'
