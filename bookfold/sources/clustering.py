"""Rows laid out so that a look-up by a cluster key opens few files.

Rows are dealt to files by ranges: of the key, if there is one, or of the interleaved bits of the places of both keys
among their quantiles (a Z-curve), so that a file spans a small range of each key. The ranges that the files really hold
are kept beside the table, one row a file, and a look-up opens only the files whose ranges can hold its key. (Row groups
are skipped by Parquet's own statistics, but not before each file has been opened.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of each key's place: 2^BITS ranges.
BITS = 6
#: Rows whose keys give the quantiles: those of the smallest row hashes, at most this many come to the driver.
SAMPLED_ROWS = 10_000


def _quantiles(rows: DataFrame, keys: Sequence[str], identity: Sequence[str]) -> dict[str, list[str]]:
    """Up to 2^BITS - 1 bounds of each key, from a sample that does not depend on how the rows are parted."""
    hashed = rows.select(*keys, F.xxhash64(*identity).alias("_hash"))
    held = hashed.orderBy("_hash", *keys).limit(SAMPLED_ROWS).collect()
    bounds = {}
    for key in keys:
        values = sorted(r[key] for r in held if r[key] is not None)
        step = max(1, len(values) >> BITS)
        bounds[key] = sorted(set(values[step::step]))[: (1 << BITS) - 1]
    return bounds


def _place(key: str, bounds: list[str]) -> Column:
    """How many bounds the key has reached; null comes first."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.coalesce(F.col(key), F.lit(""))))


def z_order(rows: DataFrame, keys: Sequence[str], identity: Sequence[str]) -> Column:
    """Bits of the places of the keys, taken in turn."""
    bounds = _quantiles(rows, keys, identity)
    places = [_place(key, bounds[key]) for key in keys]
    bits = [F.shiftleft(F.shiftright(place, bit).bitwiseAND(1), bit * len(keys) + i) for i, place in enumerate(places) for bit in range(BITS)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total


def clustered(rows: DataFrame, first: Sequence[str], keys: Sequence[str], identity: Sequence[str], files: int) -> DataFrame:
    """The rows in ``files`` ranges of ``first`` and then of the keys, sorted inside."""
    if len(keys) == 1:
        return rows.repartitionByRange(files, *first, *keys).sortWithinPartitions(*first, *keys)
    curved = rows.withColumn("_z", z_order(rows, keys, identity))
    return curved.repartitionByRange(files, *first, "_z", *keys).sortWithinPartitions(*first, "_z", *keys).drop("_z")


def file_ranges(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per file: its path, and the least and greatest value of each key; nulls are told apart."""
    measures = [f(key).alias(f"{name}_{key}") for key in keys for name, f in (("least", F.min), ("most", F.max))]
    missing = [F.count_if(F.col(key).isNull()).alias(f"nulls_{key}") for key in keys]
    return stored.select("*", F.col("_metadata.file_path").alias("file_path")).groupBy("file_path").agg(*measures, *missing)


def may_hold(wanted: Mapping[str, str | None]) -> Column:
    """Over the ranges of a file: whether it can hold rows with these keys."""
    possible = F.lit(True)
    for key, value in wanted.items():
        possible &= F.col(f"nulls_{key}") > 0 if value is None else F.lit(value).between(F.col(f"least_{key}"), F.col(f"most_{key}"))
    return possible
