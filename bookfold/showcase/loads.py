"""Loads of the stored layers: counts from the write, batches that come twice, look-ups by cluster keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.schemas import EXTRACTS
from bookfold.session import shared_folder
from bookfold.showcase.frames import MONTH, RAW_SQL, raw_frame
from bookfold.showcase.registry import query
from bookfold.sources.layers import Layers


@query(
    " UNION ALL ".join(
        f"SELECT '{e.raw_table}' AS table_name, source_file_id, source_sheet_name, count(*) AS n_rows FROM ({RAW_SQL[kind]}) GROUP BY ALL "
        f"UNION ALL SELECT '{e.raw_table}', NULL, NULL, count(*) FROM ({RAW_SQL[kind]})"
        for kind, e in EXTRACTS.items()
    )
)
def landed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table as counted by the write, and of each sheet of all tables as found in the files it left."""
    layers = Layers(spark, shared_folder(spark, "loads"))
    for kind, extract in EXTRACTS.items():
        layers.append(extract.raw_table, raw_frame(spark, sf_dir, kind), "load-1", sheets=None)
    return layers.landed([e.raw_table for e in EXTRACTS.values()]).select("table_name", "source_file_id", "source_sheet_name", "n_rows")


@query(f"SELECT row_number, source_file_id, source_sheet_name, product_code, title, price FROM ({RAW_SQL['product_master']})")
def repeated_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second of them twice, and the first once more: each lands once."""
    layers = Layers(spark, shared_folder(spark, "batches"))
    raw = raw_frame(spark, sf_dir, "product_master")
    for day in (1, 2, 2, 1):
        layers.append("raw_product_master", raw.filter(F.dayofmonth("loaded_at") == day), f"day-{day}")
    return layers.read("raw_product_master").select("row_number", "source_file_id", "source_sheet_name", "product_code", "title", "price")


_KEY = "P000000077"
_SHOWN = "row_number, source_file_id, product_code, electronic_publication_code, sales_amount"


@query(f"SELECT {_SHOWN} FROM ({RAW_SQL['monthly_product_sales']}) WHERE product_code = '{_KEY}' AND electronic_publication_code = ''")
def clustered_look_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of one product without a code of their own, from files that are ranges on the curve of both keys."""
    layers = Layers(spark, shared_folder(spark, "clustered"))
    layers.append("raw_monthly_product_sales", raw_frame(spark, sf_dir, "monthly_product_sales"), files=32)
    found = layers.look_up("raw_monthly_product_sales", MONTH, {"product_code": _KEY, "electronic_publication_code": ""})
    return found.select(*_SHOWN.split(", "))
