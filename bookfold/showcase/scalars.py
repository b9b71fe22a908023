"""Cell cleaning and typing on decorated text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.functions.cleanse import (
    blank_to_null,
    calendar_date,
    clean_cell,
    money,
    month_in_name,
    product_key,
    rate,
    whole_number,
)
from bookfold.functions.labels import IGNORED_IN_LABELS, label_keys
from bookfold.operators.files import kind_of
from bookfold.schemas import EXTRACTS
from bookfold.showcase.frames import cents, code, date_text, derived, money_text, quantity_text, rate_text
from bookfold.showcase.registry import (
    comparable,
    query,
    sql_blank_to_null,
    sql_clean,
    sql_date,
    sql_int,
    sql_money,
    sql_rate,
    sql_text,
)

_ID = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
_MONEY = f"SELECT {_ID}, {money_text(cents('l_extendedprice'), 'l_partkey')} AS price_text FROM {{lineitem}}"
_RATE = f"SELECT {_ID}, {rate_text('l_discount * 100', 'l_partkey')} AS rate_text FROM {{lineitem}}"
_INT = f"SELECT {_ID}, {quantity_text('l_quantity', 'l_partkey')} AS quantity_text FROM {{lineitem}}"
_DATE = f"SELECT o_orderkey, {date_text('o_orderkey')} AS date_text FROM {{orders}}"
_BLANKS = (
    "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '　 ' WHEN 2 THEN ' ' || c_name || '　' "
    "WHEN 3 THEN chr(9) || c_mktsegment || chr(10) ELSE c_name END AS name FROM {customer}"
)
_CODES = f"SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE {code(' P', 'p_partkey')} END AS code FROM {{part}}"
_CELLS = (
    "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '　' || text || '　 ' WHEN 1 THEN CASE WHEN doc_id % 8 = 1 THEN ' NaN ' END "
    "WHEN 2 THEN chr(10) || replace(text, ' ', '　') || chr(9) ELSE text END AS cell FROM {documents}"
)
_NARROW = "abcdefghijklmnopqrstuvwxyz0123456789#"
_WIDE = "ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ０１２３４５６７８９＃"
_LABELS = (
    "SELECT p_partkey, CASE p_partkey % 3 "
    f"WHEN 0 THEN '（' || translate(p_name, '{_NARROW}', '{_WIDE}') || '）' "
    "WHEN 1 THEN upper(p_name) || '_' || p_type ELSE p_brand || ' - (' || p_type || ')・' END AS label FROM {part}"
)
MONTH_NAMES = (
    "SELECT o_orderkey, CASE o_orderkey % 6 "
    "WHEN 0 THEN '電子出版確報明細データICE_' || substr(CAST(o_orderdate AS STRING), 1, 4) || '年' "
    "|| substr(CAST(o_orderdate AS STRING), 6, 2) || '月反映版.xlsx' "
    "WHEN 1 THEN '【商品マスタ】report' || CAST(o_orderkey AS STRING) || '.XLS' "
    "WHEN 2 THEN '【著者条件一覧】REPORT_' || substr(CAST(o_orderdate AS STRING), 1, 4) || '13.xls' "
    "WHEN 3 THEN '月別電子出版プロダクト別売上一覧(ICE印税用)_' || substr(CAST(o_orderdate AS STRING), 1, 4) "
    "|| substr(CAST(o_orderdate AS STRING), 6, 2) || '反映版.xlsx' "
    "WHEN 4 THEN 'copy of 【商品マスタ】report' || CAST(o_orderkey AS STRING) || '.xls' "
    "ELSE '【商品マスタ】report17' || '20' || lpad(CAST(o_orderkey % 90 + 10 AS STRING), 2, '0') "
    "|| lpad(CAST(o_orderkey % 12 + 1 AS STRING), 2, '0') || '99.xls' END AS name FROM {orders}"
)


@query(f"SELECT {_ID}, {sql_money('price_text')} AS price FROM ({_MONEY})")
def money_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(derived(spark, sf_dir, _MONEY).select(*_ID.split(", "), money("price_text").alias("price")))


@query(f"SELECT {_ID}, {sql_rate('rate_text')} AS rate FROM ({_RATE})")
def rate_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(derived(spark, sf_dir, _RATE).select(*_ID.split(", "), rate("rate_text").alias("rate")))


@query(f"SELECT {_ID}, {sql_int('quantity_text')} AS quantity FROM ({_INT})")
def int_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _INT).select(*_ID.split(", "), whole_number("quantity_text").alias("quantity"))


@query(f"SELECT o_orderkey, {sql_date('date_text')} AS parsed FROM ({_DATE})")
def multi_format_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(derived(spark, sf_dir, _DATE).select("o_orderkey", calendar_date("date_text").alias("parsed")))


@query(f"SELECT c_custkey, {sql_blank_to_null('name')} AS name FROM ({_BLANKS})")
def blank_to_null_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _BLANKS).select("c_custkey", blank_to_null("name").alias("name"))


@query(f"SELECT p_partkey, '01-' || {sql_blank_to_null('code')} AS product_key FROM ({_CODES})")
def key_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _CODES).select("p_partkey", product_key(blank_to_null("code")).alias("product_key"))


@query(f"SELECT doc_id, {sql_clean('cell')} AS cell FROM ({_CELLS})")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _CELLS).select("doc_id", clean_cell("cell").alias("cell"))


@query(
    f"SELECT p_partkey, translate(lower(translate(label, '{_WIDE}', '{_NARROW}')), "
    f"{' || '.join(f'chr({ord(c)})' for c in IGNORED_IN_LABELS)}, '') AS label FROM ({_LABELS})"
)
def normalize_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = derived(spark, sf_dir, _LABELS).select("p_partkey", label_keys(F.array("label")).alias("keys"))
    return keyed.select("p_partkey", F.get("keys", F.lit(0)).alias("label"))


@query(
    "SELECT o_orderkey, nullif(regexp_extract(name, '(20[0-9]{2})年?(0[1-9]|1[0-2])', 1) "
    f"|| regexp_extract(name, '(20[0-9]{{2}})年?(0[1-9]|1[0-2])', 2), '') AS month FROM ({MONTH_NAMES})"
)
def month_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, MONTH_NAMES).select("o_orderkey", month_in_name("name").alias("month"))


@query(
    "SELECT o_orderkey, CASE "
    + " ".join(f"WHEN regexp_full_match(name, {sql_text('(?i)' + e.name_pattern)}) THEN '{k}'" for k, e in EXTRACTS.items())
    + f" END AS source_kind FROM ({MONTH_NAMES})"
)
def classify_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, MONTH_NAMES).select("o_orderkey", kind_of("name").alias("source_kind"))
