"""Sharding by a weighted hash tree: region, rack, shard.

A row descends the tree by its key. On each level every child draws ``-ln(u) / weight``, u being a hash of key and
child in (0, 1); the smallest draw wins, so a child gets rows in proportion to its weight. A draw depends on the child
and its weight alone: where weights change, rows move only into or out of the subtrees that hold the change.

Weight that comes later forms a layer of its own (``Grant.epoch``). A layer has its own draws on each level, and a row
that follows it stays in it down to the shard. So a new shard, or more weight for one, takes rows into itself only: a
rack that grew does not hand rows to the shards it had before. Less weight for a shard moves rows out of it and of the
nodes above it.

Written shards: ``path/rows/shard=K`` holds the documents of shard K; ``path/index`` holds for each run of rows of one
writing task how many rows of the shard stand before it, and its least id. Rows are range-partitioned by (shard, id), so no task gets a
whole shard; slot = rows before the run + place in the run. The index has one row for each task and shard that the
task holds, at most tasks + shards rows.

Edge cases: the key is the id as text; a null id has the empty key. A null text counts as no bytes. Equal ids go to the
same shard; slots follow the id, then a hash of the text, then the place in the input, so repeated rows get slots of their own and a hot
id is dealt to many tasks. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookfold.llm.common import only

#: Index rows up to which the index is broadcast; beyond, the planner chooses.
BROADCAST_RUNS = 1_000_000
_ROOT = ""


@dataclass(frozen=True)
class Grant:
    """Weight of one shard, given at one time."""

    epoch: int
    region: int
    rack: int
    shard: int
    weight: float

    def path(self, level: int) -> str:
        """Name of the node above or at this grant: level 1 region, 2 rack, 3 shard."""
        return "/".join([str(self.epoch), f"region{self.region}", f"rack{self.rack}", f"shard{self.shard}"][: level + 1])


@dataclass(frozen=True)
class ShardTree:
    grants: tuple[Grant, ...]

    @classmethod
    def uniform(cls, regions: int, racks: int, shards: int, weight: float = 1.0) -> ShardTree:
        """``shards`` shards in each of ``racks`` racks in each of ``regions`` regions, numbered from 0."""
        return cls(tuple(Grant(0, n // (racks * shards), n // shards, n, weight) for n in range(regions * racks * shards)))

    def shards(self) -> list[int]:
        return sorted({g.shard for g in self.grants})

    def with_shard(self, region: int, rack: int, weight: float = 1.0) -> ShardTree:
        """One more shard, numbered after the last. Rows move into it only."""
        epoch = max(g.epoch for g in self.grants) + 1
        return ShardTree((*self.grants, Grant(epoch, region, rack, self.shards()[-1] + 1, weight)))

    def reweighted(self, shard: int, weight: float) -> ShardTree:
        """More weight comes as a layer of its own; less weight shrinks the shard's grants in proportion."""
        own = [g for g in self.grants if g.shard == shard]
        had = sum(g.weight for g in own)
        if weight > had:
            return ShardTree((*self.grants, replace(own[0], epoch=max(g.epoch for g in self.grants) + 1, weight=weight - had)))
        shrunk = (replace(g, weight=g.weight * weight / had) if g.shard == shard else g for g in self.grants)
        return ShardTree(tuple(g for g in shrunk if g.weight > 0))

    def children(self, level: int) -> dict[str, list[tuple[str, float]]]:
        """Parent name -> its children of ``level`` with their weights."""
        weights: dict[tuple[str, str], float] = {}
        for g in self.grants:
            edge = (g.path(level - 1) if level > 1 else _ROOT, g.path(level))
            weights[edge] = weights.get(edge, 0.0) + g.weight
        edges = sorted((parent, child, weight) for (parent, child), weight in weights.items())
        return {parent: [(child, weight) for _, child, weight in held] for parent, held in groupby(edges, key=lambda e: e[0])}


def draw(key: Column, child: Column, weight: Column) -> Column:
    """The child's draw: exponential with its weight as rate. 52 bits of MD5 over "key child"."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(" "), child).cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.ln((bits + 0.5) / float(1 << 52)) / weight


def shard_of(tree: ShardTree, id_column: str | Column) -> Column:
    """The shard of an id: three descents, each over the children of the node reached so far."""
    column = F.col(f"`{id_column}`") if isinstance(id_column, str) else id_column
    key = F.coalesce(column.cast("string"), F.lit(""))
    node = F.lit(_ROOT)
    for level in (1, 2, 3):
        entries = []
        for parent, held in tree.children(level).items():
            entries += [F.lit(parent), F.array(*[F.struct(F.lit(child).alias("child"), F.lit(weight).alias("weight")) for child, weight in held])]
        options = F.element_at(F.create_map(*entries), node)
        drawn = F.transform(options, lambda c: F.struct(draw(key, c["child"], c["weight"]).alias("draw"), c["child"].alias("child")))
        node = F.array_min(drawn)["child"]
    return F.regexp_extract(node, r"(\d+)$", 1).cast("int")


def write_shards(docs: DataFrame, tree: ShardTree, path: str, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Writes ``path/rows`` (a folder for each shard) and ``path/index``."""
    rows = only(docs, doc_id=id_column, text=text_column).withColumns({"tie": F.xxhash64("text"), "arrival": F.monotonically_increasing_id()})
    order = ["shard", "doc_id", "tie", "arrival"]
    ordered = rows.withColumn("shard", shard_of(tree, "doc_id")).repartitionByRange(*order).sortWithinPartitions(*order)
    # The number of the writing task in the upper bits, the row's place in it in the lower 33.
    ordered.select("doc_id", "text", F.monotonically_increasing_id().alias("place"), "shard").write.partitionBy("shard").parquet(f"{path}/rows")
    runs = _rows(docs.sparkSession, path, rows.schema["doc_id"].dataType.simpleString()).groupBy("shard", F.shiftright("place", 33).alias("task")).agg(F.min("place").alias("first"), F.min("doc_id").alias("least_id"), F.count("*").alias("n_rows"))
    before = F.sum("n_rows").over(Window.partitionBy("shard").orderBy("task")) - F.col("n_rows")
    runs.withColumn("before", before).write.parquet(f"{path}/index")


def _rows(spark: SparkSession, path: str, id_kind: str) -> DataFrame:
    return spark.read.schema(f"doc_id {id_kind}, text string, place long, shard int").parquet(f"{path}/rows")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, text, shard, and its slot in the shard, gapless from 0."""
    index = spark.read.parquet(f"{path}/index")
    id_kind = index.schema["least_id"].dataType.simpleString()
    index = index.select("shard", "task", "first", "before")
    if index.count() <= BROADCAST_RUNS:
        index = F.broadcast(index)
    rows = _rows(spark, path, id_kind).withColumn("task", F.shiftright("place", 33))
    return rows.join(index, ["shard", "task"]).select("doc_id", "text", "shard", (F.col("before") + F.col("place") - F.col("first")).alias("slot"))
