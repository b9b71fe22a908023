"""Look fact rows up in a master table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_master(facts: DataFrame, master: DataFrame, keys: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Left join on ``keys``; ``columns`` maps master columns to the names they get.

    A master with a repeated key repeats the fact row. No broadcast hint: the planner broadcasts the
    master only under ``autoBroadcastJoinThreshold``, by estimate or by its measured size at run time,
    and otherwise sort-merges with AQE splitting the partitions of a hot key.
    """
    looked_up = master.select(*keys, *[F.col(c).alias(new) for c, new in columns.items()])
    return facts.join(looked_up, list(keys), "left")
