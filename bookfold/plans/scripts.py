"""A build and its checks as Spark SQL scripts: variables are declared, values and table names are bound parameters.

What a script selects comes back through the driver, so a script that builds a table writes it, and only counts are selected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bookfold.functions.cleanse import DATE_PATTERN, MONEY_NOISE, WHITE_SPACE
from bookfold.schemas import source_schema
from bookfold.session import shared_folder

#: The product master of one month: rows without a key go, then the newest load of each row stays, then cells get types.
BUILD_MASTER = r"""
BEGIN
  DECLARE v_target_month STRING DEFAULT :target_month;
  DECLARE v_space STRING DEFAULT :space;
  DECLARE v_noise STRING DEFAULT :money_noise;
  DECLARE v_date STRING DEFAULT :date_pattern;
  INSERT OVERWRITE DIRECTORY USING parquet OPTIONS (path :folder)
  SELECT
    target_month, row_number,
    nullif(btrim(product_code, v_space), '') AS product_code,
    nullif(btrim(base_isbn, v_space), '') AS base_isbn,
    nullif(btrim(electronic_publication_code, v_space), '') AS electronic_publication_code,
    nullif(btrim(planning_editor, v_space), '') AS planning_editor,
    CASE WHEN btrim(sales_start_date, v_space) RLIKE v_date AND NOT startswith(btrim(sales_start_date, v_space), '0000')
      THEN try_cast(regexp_replace(btrim(sales_start_date, v_space), v_date, '$1-$3$5-$4$6') AS DATE) END AS sales_start_date,
    nullif(btrim(title, v_space), '') AS title,
    nullif(btrim(subtitle, v_space), '') AS subtitle,
    CASE WHEN octet_length(translate(price, v_noise, '')) = length(translate(price, v_noise, ''))
      THEN try_cast(translate(price, v_noise, '') AS DECIMAL(38, 9)) END AS price,
    nullif(btrim(isbn, v_space), '') AS isbn,
    nullif(btrim(author, v_space), '') AS author,
    source_file_id, source_file_name, source_sheet_name, loaded_at
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY source_file_id, source_sheet_name, row_number
      ORDER BY loaded_at DESC, struct(*) DESC) AS newest
    FROM IDENTIFIER(:raw_table)
    WHERE target_month = v_target_month
      AND btrim(product_code, v_space) <> '' AND btrim(title, v_space) <> '')
  WHERE newest = 1;
END
"""

#: Three checks of a product master of one month, zeros included.
CHECK_MASTER = """
BEGIN
  DECLARE v_target_month STRING DEFAULT :target_month;
  DECLARE v_rows BIGINT;
  SET v_rows = (SELECT count(*) FROM IDENTIFIER(:source_table) WHERE target_month = v_target_month);
  SELECT 'source_product_master_required_null' AS check_name, count_if(product_code IS NULL OR title IS NULL) AS error_count
  FROM IDENTIFIER(:source_table) WHERE target_month = v_target_month
  UNION ALL
  SELECT 'source_product_master_duplicate_key', count(*) FROM (
    SELECT product_code FROM IDENTIFIER(:source_table) WHERE target_month = v_target_month GROUP BY product_code HAVING count(*) > 1)
  UNION ALL
  SELECT 'source_product_master_row_count_zero', CAST(if(v_rows = 0, 1, 0) AS BIGINT);
END
"""


def build_master(spark: SparkSession, raw_table: str, target_month: str) -> DataFrame:
    """``raw_table``: name of a table or view. The script writes the master to the shared folder, from which it is read."""
    folder = shared_folder(spark, "scripted")
    fixed = {"space": WHITE_SPACE, "money_noise": MONEY_NOISE, "date_pattern": DATE_PATTERN}
    spark.sql(BUILD_MASTER, args={"target_month": target_month, "raw_table": raw_table, "folder": folder, **fixed})
    return spark.read.schema(source_schema("product_master")).parquet(folder)


def check_master(spark: SparkSession, source_table: str, target_month: str) -> DataFrame:
    return spark.sql(CHECK_MASTER, args={"target_month": target_month, "source_table": source_table})
