"""Samples of several checks in one pass over a table.

Each task keeps the first five rows of every check while it reads (a bounded aggregate that merges: the first five of two
parts are among the first fives of both), so the table is scanned once for all its checks, unsorted, and five rows a
check and task are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 5


@dataclass(frozen=True)
class Sampled:
    """What a check samples: rows are ordered by ``first`` (lower goes first, null takes no part) and then by the order
    of the pass; a row stands ``times`` times, once at least. ``shown``: the columns of the sample."""

    name: str
    first: Column
    shown: tuple[str, ...]
    times: Column | None = None


def first_rows(rows: DataFrame, checks: Sequence[Sampled], order: Sequence[str]) -> DataFrame:
    """Columns check_name and sample_json, a row for each check that any row takes part in."""
    columns = [*dict.fromkeys([*order, *(c for check in checks for c in check.shown)])]
    narrow = rows.select(
        *columns,
        *[check.first.cast("int").alias(f"_first{i}") for i, check in enumerate(checks)],
        *[(F.lit(1) if check.times is None else check.times).cast("long").alias(f"_times{i}") for i, check in enumerate(checks)],
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema)
    n_checks, by = len(checks), [(c, "ascending") for c in order]

    def smallest(table: pa.Table, i: int) -> pa.Table:
        places = pc.sort_indices(table, [(f"_first{i}", "ascending"), *by], null_placement="at_start")
        return table.take(places[:SAMPLE_ROWS])

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table | None] = [None] * n_checks
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for i in range(n_checks):
                some = table.filter(pc.is_valid(table.column(f"_first{i}")))
                if kept[i] is not None:
                    some = _not_behind(some, kept[i], f"_first{i}")
                    some = pa.concat_tables([kept[i], some]) if some.num_rows else kept[i]
                if some.num_rows:
                    kept[i] = smallest(some, i)
        for i, table in enumerate(kept):
            if table is not None:
                yield from table.append_column("_check", pa.array([i] * table.num_rows, pa.int32())).combine_chunks().to_batches()

    found = narrow.mapInArrow(partial, f"{schema}, _check int")
    of_check = lambda name: F.coalesce(*[F.when(F.col("_check") == i, F.col(f"{name}{i}")) for i in range(n_checks)])
    shown = [F.when(F.col("_check") == i, F.to_json(F.struct(*check.shown), {"ignoreNullFields": "false"})) for i, check in enumerate(checks)]
    found = found.select("_check", of_check("_first").alias("_first"), of_check("_times").alias("_times"), *order, F.coalesce(*shown).alias("_shown"))
    ranked = ["_first", *order]
    five = _limited(found, ranked)
    copies = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least("_times", F.lit(SAMPLE_ROWS))).cast("int")))
    five = _limited(five.withColumn("_copy", copies), [*ranked, "_copy"])
    listed = F.array_sort(F.collect_list(F.struct("_rank", "_shown")))
    names = F.element_at(F.array(*[F.lit(check.name) for check in checks]), F.col("_check") + 1)
    joined = five.groupBy("_check").agg(F.transform(listed, lambda r: r["_shown"]).alias("rows"))
    return joined.select(names.alias("check_name"), F.concat(F.lit("["), F.array_join("rows", ","), F.lit("]")).alias("sample_json"))


def _not_behind(rows: pa.Table, kept: pa.Table, column: str) -> pa.Table:
    """Rows that may stand before the last of the kept ones: a full sample of failing rows passes over the others at once."""
    if kept.num_rows < SAMPLE_ROWS:
        return rows
    return rows.filter(pc.less_equal(rows.column(column), pc.max(kept.column(column))))


def _limited(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    window = Window.partitionBy("_check").orderBy(*order)
    return rows.drop("_rank").withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= SAMPLE_ROWS)
