"""The suite against brute force, and a month in which every check fires."""

import json
from collections import Counter
from datetime import datetime

import pytest

from bookfold.operators import quality as q
from bookfold.plans.check_states import findings_from_states
from bookfold.plans.source_checks import check_counts, source_findings
from bookfold.schemas import EXTRACTS, source_schema

MONTH = "202506"


def table(spark, kind, rows):
    schema = source_schema(kind)
    base = {
        "target_month": MONTH,
        "source_file_id": "f",
        "source_file_name": "n",
        "source_sheet_name": "s",
        "loaded_at": datetime(2025, 7, 1),
    }
    full = [{**dict.fromkeys(schema.fieldNames()), **base, "row_number": i, **row} for i, row in enumerate(rows, start=1)]
    return spark.createDataFrame([tuple(r[n] for n in schema.fieldNames()) for r in full], schema)


def tables(spark, pm=(), ac=(), ep=(), ms=()):
    rows = dict(zip(EXTRACTS, (pm, ac, ep, ms)))
    return {EXTRACTS[kind].source_table: table(spark, kind, list(r)) for kind, r in rows.items()}


P = {"product_code": "P1", "title": "t"}
A = {"product_code": "P1", "author_name": "a", "author_identifier_id": "1"}
E = {"electronic_publication_code": "E1", "store_name": "s"}
S = {"product_code": "P1", "product_name": "n", "electronic_publication_code": "E1"}


def found(df):
    return {r["check_name"]: (r["error_count"], r["sample_json"]) for r in df.collect()}


def test_clean_month_has_no_findings(spark):
    clean = tables(spark, [P], [A], [E], [S])
    assert found(source_findings(clean, MONTH)) == {}
    assert {r["error_count"] for r in check_counts(clean, MONTH).collect()} == {0}
    assert q.total_errors(source_findings(clean, MONTH)).first()[0] == 0


def test_every_row_check_fires(spark):
    broken = tables(
        spark,
        [P, P, {"product_code": "P2"}, {"title": "no code"}, {**P, "product_code": "P9", "target_month": "202505"}],
        [A, A, {"product_code": "P2", "author_identifier_id": None}, {"product_code": "P2", "author_name": "b"}],
        [{"store_name": "x"}, E],
        [S, {"product_code": "P3"}, {"product_name": "no code"}, {"product_code": "P9", "electronic_publication_code": "x"}],
    )
    lazy = found(source_findings(broken, MONTH))
    assert lazy == found(findings_from_states(broken, MONTH))
    assert {name: count for name, (count, _) in lazy.items()} == {
        "source_product_master_required_null": 2,
        "source_author_conditions_required_null": 1,
        "source_ep_statement_detail_required_null": 1,
        "source_monthly_product_sales_required_null": 1,
        "monthly_sales_product_master_unmatched": 3,
        "monthly_sales_author_conditions_unmatched": 3,
        "electronic_publication_code_missing_after_completion": 2,
        "source_product_master_duplicate_key": 1,
        "source_author_conditions_duplicate_key": 2,
    }
    assert json.loads(lazy["source_product_master_required_null"][1]) == [
        {"product_code": "P2", "title": None},
        {"product_code": None, "title": "no code"},
        {"product_code": "P1", "title": "t"},
        {"product_code": "P1", "title": "t"},
    ]
    assert lazy["source_author_conditions_duplicate_key"][1] == (
        '[{"product_code":"P1","author_identifier_id":"1","duplicate_count":2},'
        '{"product_code":"P2","author_identifier_id":null,"duplicate_count":2}]'
    )
    # The matched row counts once per master row, as in the left join.
    assert [r["product_code"] for r in json.loads(lazy["monthly_sales_product_master_unmatched"][1])] == [
        None,
        "P3",
        "P9",
        "P1",
        "P1",
    ]


def test_empty_month(spark):
    rows = found(source_findings(tables(spark, [P], [A], [E], [S]), "190001"))
    assert rows == {f"{e.source_table}_row_count_zero": (1, None) for e in EXTRACTS.values()}


@pytest.mark.parametrize("hot", [0, 40])
def test_unmatched_against_brute_force(spark, hot):
    facts = [(i, f"k{i % 7}" if i % 5 else None, i % 3) for i in range(60)] + [(100 + i, "k0", 0) for i in range(hot)]
    master = [("k1",), ("k2",), ("k2",), ("k5",), (None,)]
    facts_df = spark.createDataFrame(facts, "id long, k string, v long")
    master_df = spark.createDataFrame(master, "k string")
    copies = Counter(k for (k,) in master if k is not None)
    joined = [(f, 1) for f in facts if copies[f[1]] for _ in range(copies[f[1]])] + [(f, 0) for f in facts if not copies[f[1]]]
    count = q.unmatched_count(facts_df, master_df, ["k"], "c", "t").first()["error_count"]
    assert count == sum(1 for _, matched in joined if not matched)
    first = sorted(joined, key=lambda j: (j[1], j[0][1] is not None, j[0][1] or "", j[0][0]))[:5]
    sample = q.unmatched_sample(facts_df, master_df, ["k"], ["k", "v"], ["id"]).first()[0]
    assert json.loads(sample) == [{"k": k, "v": v} for (_, k, v), _ in first]


def test_sample_of_a_table_smaller_than_the_fan_out(spark):
    facts = spark.createDataFrame([(1, "a")], "id long, k string")
    master = spark.createDataFrame([("a",)] * 8, "k string")
    assert json.loads(q.unmatched_sample(facts, master, ["k"], ["k"], ["id"]).first()[0]) == [{"k": "a"}] * 5
