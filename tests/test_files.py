"""Which file of each kind is chosen."""

from datetime import datetime, timedelta

import pytest

from bookfold.sources.landing import SourceFileError, choose_files, run_month

PM, AC = "【商品マスタ】report{}.xls", "【著者条件一覧】report{}.xls"
EP, MS = "電子出版確報明細データICE_{}反映版.xlsx", "月別電子出版プロダクト別売上一覧(ICE印税用)_{}反映版.xlsx"
ONE_EACH = [(PM.format("1751950998814"), 1), (AC.format("x"), 1), (EP.format("2025年06月"), 1), (MS.format("202505"), 1)]


def manifest(spark, files):
    rows = [(f"id{i}", name, None if day is None else datetime(2025, 7, 1) + timedelta(days=day)) for i, (name, day) in enumerate(files)]
    return spark.createDataFrame(rows, "file_id string, name string, modified_time timestamp")


def chosen(spark, files, month=None):
    return {f["source_kind"]: f["name"] for f in choose_files(manifest(spark, files), month)}


def test_one_file_per_kind_in_order_and_month(spark):
    found = choose_files(manifest(spark, [*ONE_EACH, ("notes.xls", 9)]))
    assert [f["name"] for f in found] == [name for name, _ in ONE_EACH]
    assert run_month(found, None) == "202506" and run_month(found, "202401") == "202401"
    with pytest.raises(SourceFileError, match="could not be extracted"):
        run_month([{"target_month": None}], None)


def test_newest_file_wins_and_a_match_for_the_month_beats_it(spark):
    files = [*ONE_EACH, (EP.format("2025年07月"), 5), (MS.format("2025年05月 copy"), 0)]
    assert chosen(spark, files)["ep_statement_detail"] == EP.format("2025年07月")
    assert chosen(spark, files, "202506")["ep_statement_detail"] == EP.format("2025年06月")
    assert chosen(spark, files, "202505")["monthly_product_sales"] == MS.format("202505")
    # No file of the month: the newest of all.
    assert chosen(spark, files, "203001")["ep_statement_detail"] == EP.format("2025年07月")
    # Digits inside an id count as a month.
    with_id = [*ONE_EACH, (PM.format("17202506993"), 0)]
    assert chosen(spark, with_id, "202506")["product_master"] == PM.format("17202506993")


def test_ties_and_missing_kinds_are_errors(spark):
    with pytest.raises(SourceFileError, match="multiple latest files for 電子出版確報明細: .*b反映版.xlsx, .*a反映版.xlsx"):
        chosen(spark, [*ONE_EACH, (EP.format("a"), 5), (EP.format("b"), 5)])
    # A tie among files of other months does not matter once a file matches.
    assert chosen(spark, [*ONE_EACH, (EP.format("a"), 5), (EP.format("b"), 5)], "202506")
    with pytest.raises(SourceFileError, match="multiple latest"):
        chosen(spark, [*ONE_EACH[:2], *ONE_EACH[3:], (EP.format("a"), None), (EP.format("b"), None)])
    assert chosen(spark, [*ONE_EACH, (EP.format("a"), None)])["ep_statement_detail"] == EP.format("2025年06月")
    with pytest.raises(SourceFileError, match="not found: 著者条件一覧, 月別電子出版プロダクト別売上$"):
        chosen(spark, [ONE_EACH[0], ONE_EACH[2]])
