"""Sales are brought together by identity while they are narrow: the dedupe shuffles no wide rows."""

from datetime import datetime

from bookfold.operators.dedupe import latest_rows
from bookfold.schemas import ROW_IDENTITY
from bookfold.session import spread
from bookfold.showcase.frames import raw_frame

_LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"


def _line(order, number, part=1, day=1):
    return (order, part, 2, number, 3.0, 10.5, 0.1, "A", "F", datetime(2025, 6, day))


def test_one_shuffle_of_scanned_columns(spark, tmp_path):
    lines = [_line(o, n) for o in range(40) for n in range(3)] + [_line(1, 1, part=5, day=9), _line(1, 1, part=6, day=9), _line(2, 2), _line(None, 1), _line(None, 1, day=2), _line(3, None)]
    spark.createDataFrame(lines, _LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    dealt, plain = (latest_rows(raw_frame(spark, str(tmp_path), "monthly_product_sales", by_identity=b), ROW_IDENTITY, "loaded_at") for b in (True, False))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    assert plan.index("Window ") < plan.index("Exchange ") and "月別" not in plan[plan.index("Exchange ") :].split("FileScan")[0]
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, plain.collect()))
    assert dealt.count() == 122


def test_equal_keys_come_together(spark):
    rows = spark.range(0, 2000, 1, 8).selectExpr("id", "id % 50 as k")
    parts = spread(rows, 100, ["k + 1"]).rdd.glom().collect()
    assert len(parts) == 20 and sum(len({r.k for r in p}) for p in parts) == 50
