"""Connected components by contraction: every node points to its smallest neighbour, pointers are followed to their
ends, and links are drawn anew between the ends, until no links are left.

All steps are joins and grouped minima, so a node with very many links is a partial minimum per map task. Each round
at least halves the nodes that still have links, and each is written to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookfold.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``links``: columns a and b. Returns node and component, the smallest node reachable; only nodes with links."""
    left = stored(links.select("a", "b").filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct(), "links")
    found: DataFrame | None = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        # Smaller or equal than the node itself, so pointers have no cycles.
        pointers = _followed(stored(near.select("node", F.least("node", "least").alias("to")), "pointers"))
        found = pointers if found is None else stored(_repointed(found, pointers), "components")
        ends = left.join(pointers.select(F.col("node").alias("a"), F.col("to").alias("end_a")), "a")
        ends = ends.join(pointers.select(F.col("node").alias("b"), F.col("to").alias("end_b")), "b")
        drawn = ends.filter("end_a <> end_b").select(F.least("end_a", "end_b").alias("a"), F.greatest("end_a", "end_b").alias("b"))
        left = stored(drawn.distinct(), "links")
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.select("node", F.col("to").alias("component"))


def _followed(pointers: DataFrame) -> DataFrame:
    """Pointers to the ends of their chains; chain lengths halve with each pass."""
    while True:
        further = pointers.select(F.col("node").alias("to"), F.col("to").alias("next")).filter("to <> next")
        moved = pointers.join(further, "to", "left").select("node", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
        moved = stored(moved, "pointers")
        pointers = moved.select("node", "to")
        if moved.filter("moved").isEmpty():
            return pointers


def _repointed(found: DataFrame, pointers: DataFrame) -> DataFrame:
    return found.join(pointers.select(F.col("node").alias("to"), F.col("to").alias("next")), "to", "left").select(
        "node", F.coalesce("next", "to").alias("to")
    )
