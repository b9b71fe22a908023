"""Data-quality checks. Every check yields one row: check_name, severity, table_name, error_count, sample_json.

Counts and samples are separate frames. Predicate counts of one table share one aggregate; unmatched
and duplicate counts work on keys that are counted map-side before they are shuffled, so a hot key
costs one row per map task. Samples are top-5 scans without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookfold.functions.cleanse import blank_to_null, rows_json

SAMPLE_ROWS = 5
SEVERITY = "ERROR"


@dataclass(frozen=True)
class Check:
    """A named count, and the sample that goes with it when the count is not zero (None: no sample)."""

    name: str
    table: str
    sample: DataFrame | None


def all_rows(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def any_null(*columns: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def predicate_counts(df: DataFrame, table: str, failing: Mapping[str, Column], empty_check: str | None = None) -> DataFrame:
    """Rows failing each predicate, plus 1 for ``empty_check`` when there are no rows: one scan for all."""
    measures = [F.count_if(predicate).alias(name) for name, predicate in failing.items()]
    if empty_check:
        measures.append(F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias(empty_check))
    names = [*failing, *([empty_check] if empty_check else [])]
    counted = df.agg(*measures)
    return counted.select(
        F.inline(
            F.array(*[
                F.struct(F.lit(name).alias("check_name"), F.lit(table).alias("table_name"), F.col(name).alias("error_count"))
                for name in names
            ])
        )
    )


def as_sample(top: DataFrame, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """At most ``SAMPLE_ROWS`` rows -> one row of JSON, in the given order whatever the plan."""
    ranked = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*columns).alias("s"))))
    return top.agg(rows_json(F.transform(ranked, lambda r: r["s"])).alias("sample_json"))


def row_sample(df: DataFrame, failing: Column, columns: Sequence[str], row_order: Sequence[str]) -> DataFrame:
    """Failing rows first, then by ``row_order``; passing rows only fill the remaining places."""
    order = ["_passes", *(f"_o{i}" for i in range(len(row_order)))]
    keyed = df.select(
        F.when(failing, 0).otherwise(1).alias("_passes"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(row_order)],
        *columns,
    )
    return as_sample(keyed.orderBy(*order).limit(SAMPLE_ROWS), order, columns)


def key_matches(facts: DataFrame, master: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per fact key: ``n_rows`` and ``n_matches``, the number of master rows with that key (0: unmatched).

    Both sides are reduced to distinct keys before the join.
    """
    fact_keys = facts.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    master_keys = master.groupBy(*keys).agg(F.count("*").alias("n_matches"))
    return fact_keys.join(master_keys, list(keys), "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0)))


def unmatched_count(facts: DataFrame, master: DataFrame, keys: Sequence[str], name: str, table: str) -> DataFrame:
    matched = key_matches(facts, master, keys)
    total = F.coalesce(F.sum(F.when(F.col("n_matches") == 0, F.col("n_rows"))), F.lit(0))
    return matched.agg(total.alias("error_count")).select(
        F.lit(name).alias("check_name"), F.lit(table).alias("table_name"), "error_count"
    )


def unmatched_sample(
    facts: DataFrame, master: DataFrame, keys: Sequence[str], columns: Sequence[str], row_order: Sequence[str]
) -> DataFrame:
    """Unmatched rows first, then by key and ``row_order``; a row matching n master rows counts n times.

    The first five keys in that order hold the first five rows, so only five keys are sent to the facts.
    """
    first_keys = (
        key_matches(facts, master, keys)
        .select(F.when(F.col("n_matches") == 0, 0).otherwise(1).alias("_passes"), "n_matches", *keys)
        .orderBy("_passes", *keys)
        .limit(SAMPLE_ROWS)
        .select("_passes", "n_matches", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    )
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    rows = facts.select(
        *keys, *[c for c in columns if c not in keys], *[F.col(c).alias(f"_o{i}") for i, c in enumerate(row_order)]
    )
    order = ["_passes", *(f"_k{i}" for i in range(len(keys))), *(f"_o{i}" for i in range(len(row_order))), "_copy"]
    top = (
        rows.join(F.broadcast(first_keys), same_key)
        .orderBy(*order[:-1])
        .limit(SAMPLE_ROWS)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least("n_matches", F.lit(SAMPLE_ROWS))))))
        .orderBy(*order)
        .limit(SAMPLE_ROWS)
    )
    return as_sample(top, order, columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; null is a key like any other."""
    return df.groupBy(*keys).agg(F.count("*").alias("duplicate_count")).filter("duplicate_count > 1")


def duplicate_count(df: DataFrame, keys: Sequence[str], name: str, table: str) -> DataFrame:
    """The number of duplicated keys, not of rows."""
    return duplicate_keys(df, keys).agg(F.count("*").alias("error_count")).select(
        F.lit(name).alias("check_name"), F.lit(table).alias("table_name"), "error_count"
    )


def duplicate_sample(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    top = duplicate_keys(df, keys).orderBy(*keys).limit(SAMPLE_ROWS)
    return as_sample(top, keys, [*keys, "duplicate_count"])


def findings(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Counts above zero with their samples. Both sides are one row per check."""
    no_sample = F.lit(None).cast("string")
    parts = [counts.select("check_name", "table_name", "error_count", no_sample.alias("sample_json"))]
    for check in checks:
        if check.sample is not None:
            parts.append(
                check.sample.select(
                    F.lit(check.name).alias("check_name"),
                    F.lit(check.table).alias("table_name"),
                    F.lit(None).cast("bigint").alias("error_count"),
                    "sample_json",
                )
            )
    merged = (
        all_rows(parts)
        .groupBy("check_name", "table_name")
        .agg(F.max("error_count").alias("error_count"), F.max("sample_json").alias("sample_json"))
    )
    return merged.filter("error_count > 0").select(
        "check_name", F.lit(SEVERITY).alias("severity"), "table_name", "error_count", "sample_json"
    )


def total_errors(results: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum(F.when(F.col("severity") == SEVERITY, F.col("error_count"))), F.lit(0))
    return results.agg(total.alias("total_error_count"))


def conversion_failures(raw: DataFrame, typed: Mapping[str, Column]) -> DataFrame:
    """Per column: non-blank text that its typed expression turns into null."""
    failed = [
        F.count_if(blank_to_null(name).isNotNull() & expression.isNull()).alias(name) for name, expression in typed.items()
    ]
    return raw.agg(*failed).select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("error_count")) for n in typed]))
    )


def month_mismatch(month_text: Column, target_month: Column) -> Column:
    """The accounting month, digits only, is not the target month."""
    return F.regexp_replace(month_text, "[^0-9]", "") != target_month
