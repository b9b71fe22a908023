"""The whole run on generated files: load, refine, check, audit, reload."""

import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from bookfold.plans.monthly_run import PATIENCE_SECONDS, ExtractError, QualityGateError, run_refinery, run_states
from bookfold.showcase.make_files import html_bytes, xlsx_bytes
from bookfold.sources.layers import AUDIT_LOG, QUALITY_RESULTS, REJECTED_ROWS, Layers
from bookfold.sources.landing import SourceFileError

PM = "【商品マスタ】report1751950998814.xls"
AC = "【著者条件一覧】report1751951026780.xls"
EP = "電子出版確報明細データICE_2025年06月反映版.xlsx"
MS = "月別電子出版プロダクト別売上一覧(ICE印税用)_2025年06月反映版.xlsx"

PM_ROWS = [
    ["P1", "978", "E1", "編集", "2025/06/01", "本の題", "副題", "￥1,200", "-", "4-1", "著者A"],
    ["P2", "", "", "", "2025-6-2", "NaN", "", "800", "", "", ""],
    ["P3", "", "E3", "", "", "第三", "", "abc", "", "", "著者C"],
]
AC_ROWS = [
    ["P1", "E1", "A1", "本の題", "", "x", "主", "S1", "著者A", "", "", "", "", "10%", "12.5%", "1,000", "￥5,000", "", "源泉"],
    ["P1", "E1", "A2", "本の題", "", "x", "副", "S2", "著者B", "", "", "", "", "5", "", "", "", "", ""],
]
EP_ROWS = [
    ["帳票"],
    ["計上年月", "請求先コード", "請求先名", "電子出版コード", "書名", "基準価格", "書店名", "販売数量", "バリューコード"],
    ["2025/06", "B1", "請求", "E1", "本の題", "1,200", "書店X", 3, "V"],
    ["2025/06", "B1", "請求", "", "本の題", "1,200", "書店X", 3, "V"],
]
MS_ROWS = [
    ["帳票"],
    ["計上年月", "プロダクトコード", "プロダクト名", "売上数", "売上額", "消費税額", "電子出版コード"],
    ["2025/06", "P1", "商品1", "2", "2,400", "240", ""],
    ["2025/06", "P9", "商品9", "1", "100", "10", "E9"],
    ["", "", "", "", "", "", ""],
    ["2025/06", "P3", "商品3", "12.0", "1e2", "", "E3x"],
]


def write_landing(folder, pm=PM_ROWS, ac=AC_ROWS, ep=EP_ROWS, ms=MS_ROWS):
    landing = os.path.join(folder, "landing")
    os.makedirs(landing, exist_ok=True)
    files = {
        PM: html_bytes([pm]),
        AC: html_bytes([ac], "utf-8" if ac and all(ord(c) < 128 for r in ac for v in r for c in v) else "cp932"),
        EP: xlsx_bytes({"Datalizer1": ep, "空": []}),
        MS: xlsx_bytes({"Datalizer1": ms}, inline=True),
        "memo.txt": b"ignored",
    }
    for name, payload in files.items():
        with open(os.path.join(landing, name), "wb") as out:
            out.write(payload)
    os.makedirs(os.path.join(landing, "old"), exist_ok=True)
    with open(os.path.join(landing, "old", PM), "wb") as out:
        out.write(b"<table><tr><td>older</td></tr></table>")
    return landing


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_month_end_to_end(spark, folder):
    landing, root = write_landing(folder), os.path.join(folder, "lake")
    stats = run_refinery(spark, landing, root, fail_on_quality_errors=False, run_id="r1")
    layers = Layers(spark, root)

    assert (stats.target_month, stats.status) == ("202506", "SUCCESS")
    assert layers.read("raw_ingest").count() == layers.read("staging_ingest").count() == 3 + 2 + 4 + 6
    assert layers.read("raw_product_master").count() == 3
    assert layers.read("staging_monthly_product_sales").columns[6:8] == ["raw_accounting_month", "raw_product_code"]
    assert stats.staging_rows_loaded == stats.raw_rows_loaded == (3 + 3) + (2 + 2) + (4 + 2) + (6 + 3)
    assert stats.source_rows_created == 2 + 2 + 1 + 3

    master = layers.read("source_product_master")
    assert rows(master, "product_code", F.col("sales_start_date").cast("string"), F.col("price").cast("string")) == [
        ("P1", "2025-06-01", "1200.000000000"),
        ("P3", None, None),
    ]
    authors = layers.read("source_author_conditions")
    assert rows(authors, "author_name", "payee_name", F.col("initial_royalty_rate").cast("int")) == [
        ("著者A", "著者A", 10),
        ("著者B", "著者B", 5),
    ]
    sales = layers.read("source_monthly_product_sales")
    assert rows(sales, "product_key", "electronic_publication_code", "matched_product_title", "sales_quantity", "row_number") == [
        ("01-P1", "E1", "本の題", 2, 3),
        ("01-P3", "E3x", "第三", None, 6),
        ("01-P9", "E9", None, 1, 4),
    ]
    found = layers.read(QUALITY_RESULTS).filter("run_id = 'r1'")
    assert rows(found, "check_name", "error_count", "sample_json") == [
        (
            "monthly_sales_author_conditions_unmatched",
            2,
            '[{"product_code":"P3","electronic_publication_code":"E3x"},'
            '{"product_code":"P9","electronic_publication_code":"E9"},'
            '{"product_code":"P1","electronic_publication_code":"E1"},'
            '{"product_code":"P1","electronic_publication_code":"E1"}]',
        ),
        (
            "monthly_sales_product_master_unmatched",
            1,
            '[{"product_code":"P9","product_name":"商品9"},{"product_code":"P1","product_name":"商品1"},'
            '{"product_code":"P3","product_name":"商品3"}]',
        ),
    ]
    assert stats.source_quality_error_count == 3
    log = layers.read(AUDIT_LOG).filter("run_id = 'r1'")
    assert rows(log, "status", "source_kind", "raw_rows_loaded", "warning_count") == [
        ("LOADED", "author_conditions", 4, 1),
        ("LOADED", "ep_statement_detail", 6, 0),
        ("LOADED", "monthly_product_sales", 9, 14),
        ("LOADED", "product_master", 6, 1),
        ("SUCCESS", None, 25, 16),
    ]
    rejected = layers.read(REJECTED_ROWS)
    assert rows(rejected, "source_kind", "row_number", "left_out", "reasons") == [
        ("ep_statement_detail", 4, True, ["electronic_publication_code is blank"]),
        ("monthly_product_sales", 6, False, ["sales_quantity is no int: 12.0"]),
        ("product_master", 2, True, ["title is blank"]),
        ("product_master", 3, False, ["price is no money: abc"]),
    ]
    assert {(r["run_id"], r["target_month"]) for r in rejected.collect()} == {("r1", "202506")}
    assert rows(run_states(layers), "run_id", "status", "n_events", "n_rows", "error_message") == [("r1", "SUCCESS", 3, 25, None)]
    payload = layers.read("raw_ingest").filter(F.col("source_file_name") == EP).orderBy("row_number").first()
    assert payload["row_payload_json"] == '["帳票", "", "", "", "", "", "", "", ""]'
    assert (payload["col_001"], payload["col_002"], payload["col_040"]) == ("帳票", "", "")


def test_reload_is_idempotent_and_rerun_replaces_its_findings(spark, folder):
    landing, root = write_landing(folder), os.path.join(folder, "lake")
    run_refinery(spark, landing, root, fail_on_quality_errors=False, run_id="a")
    layers = Layers(spark, root)
    business = [c for c in layers.read("source_monthly_product_sales").columns if c != "loaded_at"]
    before = rows(layers.read("source_monthly_product_sales"), *business)
    # The newest load blanks a title and a sales code: the title reappears, the sale is gone.
    blank_title = [PM_ROWS[0][:5] + [""] + PM_ROWS[0][6:], *PM_ROWS[1:]]
    blank_code = [*MS_ROWS[:3], ["2025/06", "", "商品9", "1", "100", "10", "E9"], *MS_ROWS[4:]]
    run_refinery(spark, landing, root, fail_on_quality_errors=False, run_id="a")
    assert rows(layers.read("source_monthly_product_sales"), *business) == before
    assert layers.read(QUALITY_RESULTS).count() == 2
    assert layers.read("raw_product_master").count() == 6
    # Only the rows of the run's last load, under the run that was repeated.
    assert rows(layers.read(REJECTED_ROWS), "run_id") == [("a",)] * 4

    write_landing(folder, pm=blank_title, ms=blank_code)
    stats = run_refinery(spark, landing, root, target_month="202506", fail_on_quality_errors=False, run_id="b")
    assert rows(layers.read("source_product_master"), "product_code", "title") == [("P1", "本の題"), ("P3", "第三")]
    assert rows(layers.read("source_monthly_product_sales"), "product_code") == [("P1",), ("P3",)]
    assert stats.source_quality_error_count == 1
    layers.replace_run("b", layers.read(QUALITY_RESULTS).limit(0))
    assert rows(layers.read(QUALITY_RESULTS), "run_id") == [("a",), ("a",)]


def test_gate_and_failed_runs_leave_an_audit_row(spark, folder):
    landing, root = write_landing(folder), os.path.join(folder, "lake")
    with pytest.raises(QualityGateError, match="3 errors"):
        run_refinery(spark, landing, root, run_id="gate")
    headless = [EP_ROWS[0], ["x", *EP_ROWS[1][1:]], *EP_ROWS[2:]]
    write_landing(folder, ep=headless)
    with pytest.raises(ExtractError, match="required columns missing for ep_statement_detail: accounting_month"):
        run_refinery(spark, landing, root, run_id="header")
    write_landing(folder, ac=[])
    with pytest.raises(ExtractError, match="no tables found"):
        run_refinery(spark, landing, root, run_id="empty")
    write_landing(folder, ep=[[" ", "　"]])
    with pytest.raises(ExtractError, match="no non-empty sheets found: 電子出版"):
        run_refinery(spark, landing, root, run_id="blank")
    empty = os.path.join(folder, "nothing")
    os.makedirs(empty)
    with pytest.raises(SourceFileError, match="商品マスタ, 著者条件一覧"):
        run_refinery(spark, empty, root, run_id="missing")
    log = Layers(spark, root).read(AUDIT_LOG)
    failed = {r["run_id"]: r for r in log.filter("status = 'FAILED'").collect()}
    assert set(failed) == {"gate", "header", "empty", "blank", "missing"}
    assert failed["gate"]["source_quality_error_count"] == 3
    assert failed["missing"]["target_month"] is None and failed["missing"]["error_count"] == 1
    layers = Layers(spark, root)
    # The driver of this run was lost after its load.
    layers.append_event("cut", "RUNNING")
    layers.append_event("cut", "LOADED", 5)
    assert rows(run_states(layers).filter("run_id = 'cut'"), "status", "n_events", "n_rows") == [("LOADED", 2, 5)]
    later = datetime.now(timezone.utc) + timedelta(seconds=PATIENCE_SECONDS + 60)
    states = {r["run_id"]: r for r in run_states(layers, later).collect()}
    assert {k: r["status"] for k, r in states.items()} == {**dict.fromkeys(failed, "FAILED"), "cut": "LOST"}
    assert states["gate"]["n_events"] == 3 and states["missing"]["n_events"] == 2
    assert states["gate"]["error_message"] == "quality checks found 3 errors"
    assert layers.read_events(later.date() + timedelta(days=1)).count() == 0
    # Kinds before the bad file were loaded.
    assert rows(log.filter("run_id = 'header' AND status = 'LOADED'"), "source_kind") == [
        ("author_conditions",),
        ("product_master",),
    ]


def test_a_failing_append_is_audited_with_what_has_landed(spark, folder, monkeypatch):
    landing, root = write_landing(folder), os.path.join(folder, "lake")
    append = Layers.append

    def failing(self, table, batch, *more):
        if table == "raw_monthly_product_sales":
            raise OSError("disk full")
        append(self, table, batch, *more)

    monkeypatch.setattr(Layers, "append", failing)
    with pytest.raises(OSError, match="disk full"):
        run_refinery(spark, landing, root, run_id="torn")
    log = Layers(spark, root).read(AUDIT_LOG)
    assert rows(log, "status", "source_kind", "staging_rows_loaded", "raw_rows_loaded") == [
        ("FAILED", "monthly_product_sales", 9, 6),
        ("FAILED", None, 25, 22),
        ("LOADED", "author_conditions", 4, 4),
        ("LOADED", "ep_statement_detail", 6, 6),
        ("LOADED", "product_master", 6, 6),
    ]


def test_zero_source_rows_fail_even_without_the_flag(spark, folder):
    landing = write_landing(
        folder, pm=[["", "x"] + [""] * 9], ac=[["", "x"] + [""] * 17], ep=EP_ROWS[:2], ms=MS_ROWS[:2]
    )
    with pytest.raises(QualityGateError, match="is 0"):
        run_refinery(spark, landing, os.path.join(folder, "lake"), fail_on_quality_errors=False, run_id="zero")
    layers = Layers(spark, os.path.join(folder, "lake"))
    assert layers.read(AUDIT_LOG).filter("status = 'FAILED'").first()["source_quality_error_count"] == 5
    assert rows(layers.read(QUALITY_RESULTS), "error_count", "sample_json") == [(1, None)] * 4
