"""Record layouts of the four monthly extracts and the schemas of every stored table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

HEADER_SEARCH_ROWS = 30
GENERIC_COLUMNS = 40

# One line per field, in the order the columns are stored.
# field | refined type | must be found as a column | 0-based position without header | header labels
_PRODUCT_MASTER = """
product_code                | text  | yes | 0  | 商品コード, プロダクトコード
base_isbn                   | text  | no  | 1  | 基幹ISBN, 基準ISBN
electronic_publication_code | text  | yes | 2  | 電子出版コード, 電子書籍コード
planning_editor             | text  | no  | 3  | 企画編集者, 編集担当
sales_start_date            | date  | no  | 4  | 販売開始日, 発売日
title                       | text  | yes | 5  | 書名, 商品名, タイトル
subtitle                    | text  | no  | 6  | 副書名, サブタイトル
price                       | money | no  | 7  | 価格, 本体価格, 定価, 基準価格
isbn                        | text  | no  | 9  | ISBN
author                      | text  | no  | 10 | 著者, 著者名
"""
_AUTHOR_CONDITIONS = """
product_code                | text  | yes | 0  | 商品コード, プロダクトコード
electronic_publication_code | text  | yes | 1  | 電子出版コード, 電子書籍コード
author_identifier_id        | text  | yes | 2  | 著者識別ID, 著者ID
title                       | text  | yes | 3  | 書名, 商品名, タイトル
planning_editor             | text  | no  | 4  | 企画編集者, 編集担当
author_category             | text  | yes | 6  | 著者区分, 著者種別
payee_code                  | text  | no  | 7  | 支払先コード, 支払先CD
author_name                 | text  | yes | 8  | 著者名, 権利者名
payee_name                  | text  | no  | 8  | 支払先名
initial_royalty_rate        | rate  | no  | 13 | 初回印税率, 印税率
revised_royalty_rate        | rate  | no  | 14 | 改定印税率
revised_rate_sales_quantity | int   | no  | 15 | 改定部数, 改定販売数
revised_rate_sales_amount   | money | no  | 16 | 改定金額, 改定売上額
payment_hold_limit_amount   | money | no  | 17 | 支払保留限度額, 支払保留額
withholding_tax_type        | text  | no  | 18 | 源泉税区分, 税区分
"""
_EP_STATEMENT_DETAIL = """
accounting_month            | text  | yes | -  | 計上年月, 売上年月
billing_code                | text  | no  | -  | 請求先コード, 請求先CD
billing_name                | text  | no  | -  | 請求先名
electronic_publication_code | text  | yes | -  | 電子出版コード, 電子書籍コード
book_title                  | text  | no  | -  | 書名, タイトル
list_price                  | money | no  | -  | 定価, 本体価格, 基準価格
store_name                  | text  | yes | -  | 書店名, 販売店名
sales_quantity              | int   | no  | -  | 売上数, 販売数量, 数量, 販売数
value_code                  | text  | no  | -  | 値コード, バリューコード
"""
_MONTHLY_PRODUCT_SALES = """
accounting_month            | text  | yes | -  | 計上年月, 売上年月
product_code                | text  | yes | -  | 商品コード, プロダクトコード
product_name                | text  | no  | -  | 商品名, プロダクト名
sales_company_code          | text  | no  | -  | 販売会社コード, 売上計上会社コード
sales_company_name          | text  | no  | -  | 販売会社名, 売上計上会社名
sales_department_code       | text  | no  | -  | 販売部署コード, 売上計上部門コード
sales_department_name       | text  | no  | -  | 販売部署名, 売上計上部門名
product_type_code           | text  | no  | -  | 商品区分コード, プロダクト種別コード
product_type_name           | text  | no  | -  | 商品区分名, プロダクト種別名
bibliographic_title         | text  | no  | -  | 書誌名, 書誌タイトル, 書名
billing_code                | text  | no  | -  | 請求先コード, 請求先CD
billing_name                | text  | no  | -  | 請求先名
ep_statement_code           | text  | no  | -  | 確報コード, EP_確報コード
list_price                  | money | no  | -  | 定価, 本体価格, 基準価格
sales_quantity              | int   | no  | -  | 売上数, 数量, 販売数
sales_amount                | money | no  | -  | 売上額, 金額
tax_amount                  | money | no  | -  | 税額, 消費税額
tax_type                    | text  | no  | -  | 税区分, 消費税種別
electronic_publication_code | text  | no  | -  | 電子出版コード, 電子書籍コード
partner_company_code        | text  | no  | -  | 取引先会社コード, パートナー会社コード
partner_company_name        | text  | no  | -  | 取引先会社名, パートナー会社名
"""


@dataclass(frozen=True)
class Field:
    name: str
    refined_type: str
    needed: bool
    position: int | None
    labels: tuple[str, ...]


@dataclass(frozen=True)
class Extract:
    """One kind of monthly file: how it is named, laid out and clustered."""

    kind: str
    label: str
    name_pattern: str
    fields: tuple[Field, ...]
    key_fields: tuple[str, ...]
    cluster: tuple[str, ...]

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def staging_table(self) -> str:
        return f"staging_{self.kind}"

    @property
    def raw_table(self) -> str:
        return f"raw_{self.kind}"

    @property
    def source_table(self) -> str:
        return f"source_{self.kind}"


def _fields(layout: str) -> tuple[Field, ...]:
    parsed = []
    for line in layout.strip().splitlines():
        name, refined_type, needed, position, labels = (part.strip() for part in line.split("|"))
        parsed.append(
            Field(name, refined_type, needed == "yes", None if position == "-" else int(position), tuple(labels.split(", ")))
        )
    return tuple(parsed)


# File-name patterns (matched against the whole name, any letter case), display labels,
# the fields a refined row cannot do without, and the clustering fields of the raw tables.
EXTRACTS: dict[str, Extract] = {
    e.kind: e
    for e in (
        Extract(
            "product_master",
            "商品マスタ",
            r"【商品マスタ】report.*\.xls",
            _fields(_PRODUCT_MASTER),
            ("product_code", "title"),
            ("product_code",),
        ),
        Extract(
            "author_conditions",
            "著者条件一覧",
            r"【著者条件一覧】report.*\.xls",
            _fields(_AUTHOR_CONDITIONS),
            ("product_code", "author_name"),
            ("product_code", "electronic_publication_code"),
        ),
        Extract(
            "ep_statement_detail",
            "電子出版確報明細",
            r"電子出版確報明細データICE_.*反映版\.xlsx",
            _fields(_EP_STATEMENT_DETAIL),
            ("electronic_publication_code", "store_name"),
            ("electronic_publication_code", "store_name"),
        ),
        Extract(
            "monthly_product_sales",
            "月別電子出版プロダクト別売上",
            r"月別電子出版プロダクト別売上一覧\(ICE印税用\)_.*反映版\.xlsx",
            _fields(_MONTHLY_PRODUCT_SALES),
            ("product_code",),
            ("product_code", "electronic_publication_code"),
        ),
    )
}
KINDS = tuple(EXTRACTS)

ROW_IDENTITY = ("source_file_id", "source_sheet_name", "row_number")
LINEAGE = ("source_file_id", "source_file_name", "source_sheet_name", "loaded_at")

_REFINED_TYPES = {
    "text": T.StringType(),
    "money": T.DecimalType(38, 9),
    "rate": T.DecimalType(38, 9),
    "int": T.LongType(),
    "date": T.DateType(),
}


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns])


_METADATA = (
    ("row_number", T.LongType()),
    ("target_month", T.StringType()),
    ("loaded_at", T.TimestampType()),
    ("source_file_id", T.StringType()),
    ("source_file_name", T.StringType()),
    ("source_sheet_name", T.StringType()),
)


def generic_column(index: int) -> str:
    return f"col_{index + 1:03d}"


def ingest_schema(width: int = GENERIC_COLUMNS) -> T.StructType:
    cells = [(generic_column(i), T.StringType()) for i in range(width)]
    return _struct(*_METADATA, ("row_payload_json", T.StringType()), *cells)


def raw_schema(kind: str) -> T.StructType:
    return _struct(*_METADATA, *((name, T.StringType()) for name in EXTRACTS[kind].field_names))


def staging_schema(kind: str) -> T.StructType:
    return _struct(*_METADATA, *((staged_name(name), T.StringType()) for name in EXTRACTS[kind].field_names))


def staged_name(name: str) -> str:
    """Business columns carry a ``raw_`` prefix in the staging layer, once."""
    return name if name == "row_number" or name.startswith("raw_") else f"raw_{name}"


def source_columns(kind: str) -> list[tuple[str, T.DataType]]:
    columns: list[tuple[str, T.DataType]] = [("target_month", T.StringType()), ("row_number", T.LongType())]
    for f in EXTRACTS[kind].fields:
        columns.append((f.name, _REFINED_TYPES[f.refined_type]))
        if kind == "monthly_product_sales" and f.name == "product_code":
            columns.append(("product_key", T.StringType()))
    if kind == "monthly_product_sales":
        columns += [("matched_product_title", T.StringType()), ("matched_author", T.StringType())]
    columns += [(name, T.StringType()) for name in LINEAGE[:3]] + [("loaded_at", T.TimestampType())]
    return columns


def source_schema(kind: str) -> T.StructType:
    return _struct(*source_columns(kind))


AUDIT_LOG_SCHEMA = _struct(
    ("run_id", T.StringType()),
    ("started_at", T.TimestampType()),
    ("finished_at", T.TimestampType()),
    ("target_month", T.StringType()),
    ("source_kind", T.StringType()),
    ("source_file_id", T.StringType()),
    ("source_file_name", T.StringType()),
    ("source_sheet_name", T.StringType()),
    ("staging_rows_loaded", T.LongType()),
    ("raw_rows_loaded", T.LongType()),
    ("source_rows_created", T.LongType()),
    ("source_quality_error_count", T.LongType()),
    ("warning_count", T.LongType()),
    ("error_count", T.LongType()),
    ("status", T.StringType()),
    ("error_message", T.StringType()),
)

#: What a run has been through, one row per event.
RUN_EVENTS_SCHEMA = _struct(
    ("run_id", T.StringType()),
    ("status", T.StringType()),
    ("happened_at", T.TimestampType()),
    ("n_rows", T.LongType()),
    ("error_message", T.StringType()),
)

#: Loaded rows that a build leaves out or reads in part.
REJECTED_ROWS_SCHEMA = _struct(
    ("run_id", T.StringType()),
    ("target_month", T.StringType()),
    ("source_kind", T.StringType()),
    ("source_file_id", T.StringType()),
    ("source_sheet_name", T.StringType()),
    ("row_number", T.LongType()),
    ("loaded_at", T.TimestampType()),
    ("left_out", T.BooleanType()),
    ("reasons", T.ArrayType(T.StringType())),
)

QUALITY_RESULTS_SCHEMA = _struct(
    ("run_id", T.StringType()),
    ("checked_at", T.TimestampType()),
    ("target_month", T.StringType()),
    ("check_name", T.StringType()),
    ("severity", T.StringType()),
    ("table_name", T.StringType()),
    ("error_count", T.LongType()),
    ("sample_json", T.StringType()),
)

# One row per sheet row, before any header is known.
CELLS_SCHEMA = _struct(
    ("source_kind", T.StringType()),
    ("file_id", T.StringType()),
    ("file_name", T.StringType()),
    ("sheet_name", T.StringType()),
    ("row_number", T.LongType()),
    ("values", T.ArrayType(T.StringType())),
    ("error", T.StringType()),
)
MEASURED_SCHEMA = T.StructType(
    [*CELLS_SCHEMA, T.StructField("n_cells", T.IntegerType()), T.StructField("has_text", T.BooleanType())]
)
