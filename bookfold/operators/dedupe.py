"""Keep the newest load of every physical row.

Filter order is the caller's choice and matters: ``latest_rows(df.filter(c))`` lets an older row
reappear when the newest load fails the condition, ``latest_rows(df).filter(c)`` drops the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, keys: Sequence[str], stamp: str, ties: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the one with the greatest ``stamp``.

    Rows with equal stamps are told apart by ``ties`` (default: all other columns), so a recomputed
    task picks the same row. The ``= 1`` filter becomes a group limit that runs before the shuffle,
    so a key loaded many times sends one row per map task.
    """
    others = [c for c in df.columns if c != stamp and c not in keys] if ties is None else list(ties)
    newest_first = Window.partitionBy(*keys).orderBy(F.desc(stamp), *[F.desc(c) for c in others])
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") == 1).drop("_rank")
