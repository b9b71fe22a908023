"""Batches: counted, landed once, clustered."""

import random
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from bookfold.schemas import EXTRACTS, raw_schema
from bookfold.showcase import ORACLE, QUERIES
from bookfold.showcase.frames import raw_frame
from bookfold.sources.clustering import z_order
from bookfold.sources.layers import Layers

TABLE = "raw_monthly_product_sales"


def sales(spark, n, month="202506", seed=1):
    rng = random.Random(seed)
    schema = raw_schema("monthly_product_sales")
    rows = []
    for i in range(n):
        row = {f.name: "" for f in schema}
        row.update(row_number=i, target_month=month, loaded_at=None, source_file_id=f"f{i % 3}", source_sheet_name="s")
        row.update(product_code=rng.choice([None, f"P{rng.randrange(200):04d}"]) if i % 50 == 0 else f"P{rng.randrange(200):04d}", electronic_publication_code=f"E{rng.randrange(200):04d}")
        rows.append(tuple(row[f.name] for f in schema))
    return spark.createDataFrame(rows, schema)


def test_counts_come_from_the_write(spark, folder):
    layers = Layers(spark, folder)
    assert layers.append(TABLE, sales(spark, 100), "a", [("f0", "s"), ("f2", "s"), ("none", "s")]) == 100
    found = {(r.source_file_id, r.source_sheet_name): r.n_rows for r in layers.landed([TABLE]).collect()}
    assert found == {(None, None): 100, ("f0", "s"): 34, ("f2", "s"): 33, ("none", "s"): 0}
    assert layers.append(TABLE, sales(spark, 0), "empty") == 0
    assert layers.append(TABLE, sales(spark, 5)) == 5


def test_every_sheet_is_counted(spark, folder):
    layers = Layers(spark, folder)
    unnamed = sales(spark, 12, seed=3).withColumns({"source_file_id": F.lit(None).cast("string"), "source_sheet_name": F.when(F.col("row_number") < 5, "s")})
    rows = sales(spark, 100).unionByName(unnamed)
    # Counted, and the driver lost before the batch was entered: not told, and replaced by the next attempt.
    lost = spark.createDataFrame([("f0", "gone", 7)], "source_file_id string, source_sheet_name string, n_rows long")
    lost.withColumn("committed_at", F.lit(datetime(2025, 7, 1))).write.parquet(f"{layers.path('sheet_ledger')}/table_name={TABLE}/batch_id=a")
    assert layers.append(TABLE, sales(spark, 30, "202507"), "b", [("f1", "s")]) == 30
    found = {(r.batch_id, r.source_file_id, r.source_sheet_name): r.n_rows for r in layers.landed([TABLE]).collect()}
    assert found == {("b", None, None): 30, ("b", "f1", "s"): 10}
    # A null file is a sheet of its own, not the batch: the next attempt still finds the rows of the whole.
    assert [layers.append(TABLE, rows, "a", sheets=None) for _ in range(2)] == [112, 112]
    assert layers.append(TABLE, sales(spark, 0), "empty", sheets=None) == 0
    found = sorted(((r.source_file_id or "", r.source_sheet_name or "", r.n_rows) for r in layers.landed([TABLE]).filter("batch_id = 'a'").collect()))
    assert found == [("", "", 7), ("", "", 112), ("", "s", 5), ("f0", "s", 34), ("f1", "s", 33), ("f2", "s", 33)]
    assert [r.n_rows for r in layers.landed([TABLE]).filter("batch_id = 'empty'").collect()] == [0]


def test_landed_counts_tells_the_sheets_of_all_kinds(spark, folder):
    day = datetime(2025, 6, 1)
    tables = {
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [(i, "n", ("a", "b", None)[i % 3], "t", 1, 2.0) for i in range(9)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string", [(i, 1, "OF"[i % 2], 3.0, day, "p") for i in range(5)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp", [(i % 4 or None, 1, 2, i, 3.0, 10.5, 0.1, "A", "F", day) for i in range(14)]),
        "events": ("event_id long, ts timestamp, user_id long, event_type string, value double, props string", [(i, day, (7, 8, None)[i % 3], ("click", "view", None)[i // 6], 1.0, "{}") for i in range(18)]),
    }
    con = duckdb.connect()
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    counted = QUERIES["landed_counts"](spark, folder).select("table_name", "source_file_id", "source_sheet_name", "n_rows")
    found = [tuple(r) for r in counted.collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, con.execute(ORACLE["landed_counts"]).fetchall()))
    for kind, extract in EXTRACTS.items():
        told = [f[1:] for f in found if f[0] == extract.raw_table]
        sheets = [tuple(r) for r in raw_frame(spark, folder, kind).groupBy("source_file_id", "source_sheet_name").count().collect()]
        assert sorted(map(repr, told)) == sorted(map(repr, [*sheets, (None, None, sum(n for *_, n in sheets))]))
    assert {f[1:] for f in found if f[0] == TABLE} == {(None, "Datalizer1", 4), ("ms-1", "Datalizer1", 4), ("ms-2", "Datalizer1", 3), ("ms-3", "Datalizer1", 3), (None, None, 14)}
    assert ("raw_ep_statement_detail", "ep-7", "click", 2) in found and ("raw_ep_statement_detail", None, None, 2) in found


def test_a_batch_lands_once(spark, folder, monkeypatch):
    layers = Layers(spark, folder)
    layers.append(TABLE, sales(spark, 50), "a")
    assert layers.append(TABLE, sales(spark, 50), "a") == 50
    assert layers.append(TABLE, sales(spark, 20, "202507", 2), "b") == 20
    assert layers.read(TABLE).count() == 70
    # Written, and the driver lost before the ledger was: the next attempt replaces what had landed.
    lost = sales(spark, 30).withColumn("batch_id", F.lit("c"))
    lost.write.mode("append").partitionBy("target_month", "batch_id").parquet(layers.path(TABLE))
    assert layers.read(TABLE).count() == 100
    assert layers.append(TABLE, sales(spark, 40), "c") == 40
    assert layers.read(TABLE).count() == 110
    assert layers.read_month(TABLE, "202507").count() == 20
    with pytest.raises(ValueError, match="cannot name a partition"):
        layers.append(TABLE, sales(spark, 1), "a/b")


def opened(df):
    df.collect()
    plan, total, waiting = df._jdf.queryExecution().executedPlan(), 0, []
    waiting.append(plan)
    while waiting:
        node = waiting.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif node.getClass().getSimpleName() == "FileSourceScanExec":
            total += node.metrics().apply("numFiles").value()
        waiting += [node.children().apply(i) for i in range(node.children().size())]
    return total


@pytest.mark.parametrize("wanted", [{"product_code": "P0077"}, {"electronic_publication_code": "E0123"}, {"product_code": "P0005", "electronic_publication_code": "E0005"}, {"product_code": None}, {"product_code": "absent"}])
def test_a_look_up_opens_few_files(spark, folder, wanted):
    layers, rows = Layers(spark, folder), sales(spark, 6000)
    layers.append(TABLE, rows, files=64)
    same = F.lit(True)
    for key, value in wanted.items():
        same &= F.col(key).eqNullSafe(F.lit(value))
    found = layers.look_up(TABLE, "202506", wanted)
    assert sorted(r.row_number for r in found.collect()) == sorted(r.row_number for r in rows.filter(same).collect())
    assert opened(layers.read(TABLE)) >= 60
    assert opened(found) <= 16
    # Batches without ranges are read as well.
    layers.append(TABLE, sales(spark, 300, seed=5))
    further = sales(spark, 300, seed=5).filter(same).count()
    assert layers.look_up(TABLE, "202506", wanted).count() == rows.filter(same).count() + further


def test_places_interleave(spark):
    rows = spark.createDataFrame([(f"{a:02d}", f"{b:02d}") for a in range(64) for b in range(64)], "a string, b string")
    curved = rows.withColumn("z", z_order(rows, ["a", "b"], ["a", "b"])).collect()
    assert len({r.z for r in curved}) > 3000
    quarter = [r for r in curved if r.z < 1024]
    assert max(int(r.a) for r in quarter) <= 33 and max(int(r.b) for r in quarter) <= 33
