"""The weighted hash tree: shares, movement, and the written shards."""

import collections
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from bookfold.llm import shard_tree
from bookfold.llm.queries import GROWN_SHARDS, SHARDS

SF = "/root/testdata/sf0.001"


def plain_shard(tree, key):
    node = ""
    for level in (1, 2, 3):
        node = min(
            (-math.log((int(hashlib.md5(f"{key} {child}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / weight, child)
            for child, weight in tree.children(level)[node]
        )[1]
    return int(node.rsplit("shard", 1)[1])


def placed(spark, tree, keys=4000):
    return dict(spark.range(keys).select("id", shard_tree.shard_of(tree, "id")).collect())


def test_descent_agrees_with_a_plain_one(spark):
    tree = SHARDS.reweighted(3, 2.5).with_shard(0, 1, 0.5).reweighted(9, 0.25)
    assert placed(spark, tree, 1500) == {k: plain_shard(tree, k) for k in range(1500)}
    names = spark.createDataFrame([("b",), ("",), (None,)], "name string").select(shard_tree.shard_of(tree, "name")).collect()
    assert [r[0] for r in names] == [plain_shard(tree, k) for k in ("b", "", "")]


def test_rows_follow_the_weights(spark):
    tree = SHARDS.reweighted(5, 4.0).reweighted(2, 0.5)
    total, counts = 18.5, collections.Counter(placed(spark, tree, 40_000).values())
    weights = {s: 1.0 for s in range(16)} | {5: 4.0, 2: 0.5}
    for shard, weight in weights.items():
        assert counts[shard] == pytest.approx(40_000 * weight / total, rel=0.12)


def test_new_weight_takes_rows_into_itself_only(spark):
    tree, before = SHARDS, placed(spark, SHARDS)
    for grow in (lambda t: t.with_shard(1, 3), lambda t: t.with_shard(0, 0, 2.0), lambda t: t.with_shard(2, 4), lambda t: t.reweighted(17, 3.0), lambda t: t.reweighted(4, 1.5)):
        tree = grow(tree)
        after = placed(spark, tree)
        moved = {after[k] for k in before if before[k] != after[k]}
        assert len(moved) == 1
        before = after
    assert placed(spark, GROWN_SHARDS) == placed(spark, SHARDS.with_shard(1, 3))


def test_less_weight_moves_nothing_between_other_regions(spark):
    before, after = placed(spark, SHARDS), placed(spark, SHARDS.reweighted(5, 0.5))
    assert all(before[k] < 8 for k in before if before[k] != after[k])
    assert any(before[k] != after[k] for k in before)
    assert 5 not in placed(spark, SHARDS.reweighted(5, 0)).values()


def test_written_shards_have_gapless_slots(spark, folder):
    rows = [(k, f"text {k}") for k in range(500)] + [(7, None), (7, ""), (7, "text 7"), (None, "none"), (None, None)] + [(77, "again")] * 300
    docs = spark.createDataFrame([(i, t, "s", 1, "p") for i, t in rows], "doc_id long, text string, shard string, slot int, place string").repartition(5)
    shard_tree.write_shards(docs, SHARDS, f"{folder}/shards")
    read = shard_tree.read_shards(spark, f"{folder}/shards").collect()
    assert collections.Counter((r.doc_id, r.text) for r in read) == collections.Counter(rows)
    slots = collections.defaultdict(list)
    for r in read:
        assert r.shard == plain_shard(SHARDS, "" if r.doc_id is None else r.doc_id)
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id))
    for held in slots.values():
        held.sort()
        assert [slot for slot, *_ in held] == list(range(len(held)))
        assert held == sorted(held, key=lambda x: (x[1], x[2] or 0))


def test_a_hot_id_is_dealt_to_many_tasks(spark, folder):
    docs = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shard_tree.write_shards(docs, SHARDS, f"{folder}/shards")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    tasks = spark.read.parquet(f"{folder}/shards/index").groupBy("task").agg(F.sum("n_rows").alias("n"))
    assert tasks.agg(F.max("n")).first()[0] < 15_000
    slots = shard_tree.read_shards(spark, f"{folder}/shards").groupBy("shard").agg(F.count_distinct("slot").alias("d"), F.count("*").alias("n"), F.max("slot").alias("m"))
    assert all(r.d == r.n == r.m + 1 for r in slots.collect())


def test_empty_table(spark, folder):
    docs = spark.createDataFrame([], "doc_id long, text string")
    shard_tree.write_shards(docs, SHARDS, f"{folder}/shards")
    assert shard_tree.read_shards(spark, f"{folder}/shards").count() == 0
