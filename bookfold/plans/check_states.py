"""The quality suite from grouped states: each refined table is scanned once to count and once to sample.

A state has a row per key with the number of rows, and of those that fail each predicate. All 13 counts follow from the
four states: nulls and emptiness are sums, duplicates are keys of more than one row, and unmatched sales are sales keys
without a master or author key. The states are far narrower than the tables and are written once, as several counts and
the first keys of the samples come from them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookfold.operators import quality as q
from bookfold.operators.samples import Sampled, first_rows
from bookfold.plans.source_checks import (
    AUTHORS,
    DUPLICATE,
    MATCH_KEYS,
    MISSING_CODE,
    PRODUCTS,
    REQUIRED,
    SALES,
    STATEMENTS,
    UNMATCHED,
)
from bookfold.schemas import ROW_IDENTITY
from bookfold.session import shared_folder, together

STATE_KEYS = {
    PRODUCTS: ("product_code", "target_month"),
    AUTHORS: ("product_code", "author_identifier_id", "target_month"),
    STATEMENTS: ("target_month",),
    SALES: ("product_code", "target_month"),
}


def _failing(table: str) -> dict:
    required, _ = REQUIRED[table]
    failing = {f"{table}_required_null": q.any_null(*required)}
    return failing | ({MISSING_CODE: q.any_null("electronic_publication_code")} if table == SALES else {})


def table_state(table: str, rows: DataFrame) -> DataFrame:
    """One scan: rows, and rows failing each predicate, by key."""
    measures = [F.count_if(failing).alias(name) for name, failing in _failing(table).items()]
    return rows.groupBy(*STATE_KEYS[table]).agg(F.count("*").alias("n_rows"), *measures)


def written(frames: Mapping[str, DataFrame], purpose: str) -> dict[str, DataFrame]:
    """Frames written to the shared folder and read back, all at once."""
    paths = {name: shared_folder(df.sparkSession, f"{purpose}-{name}") for name, df in frames.items()}
    together([partial(df.write.parquet, paths[name]) for name, df in frames.items()])
    return {name: df.sparkSession.read.schema(df.schema).parquet(paths[name]) for name, df in frames.items()}


def matched_keys(states: Mapping[str, DataFrame]) -> DataFrame:
    """Per sales key: rows, and how many product and author rows it meets."""
    keys = states[SALES].select(*MATCH_KEYS, "n_rows")
    for table in (PRODUCTS, AUTHORS):
        other = states[table].groupBy(*MATCH_KEYS).agg(F.sum("n_rows").alias(table))
        keys = keys.join(other, MATCH_KEYS, "left").withColumn(table, F.coalesce(table, F.lit(0)))
    return keys


def _named(name: str, table: str, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(name).alias("check_name"), F.lit(table).alias("table_name"), "error_count")


def state_counts(states: Mapping[str, DataFrame], matched: DataFrame) -> DataFrame:
    """All 13 counts, zeros included."""
    parts = []
    for table, state in states.items():
        sums = {name: F.coalesce(F.sum(name), F.lit(0)) for name in _failing(table)}
        sums[f"{table}_row_count_zero"] = F.when(F.coalesce(F.sum("n_rows"), F.lit(0)) == 0, 1).otherwise(0).cast("long")
        totals = state.agg(*[total.alias(name) for name, total in sums.items()])
        rows = [F.struct(F.lit(n).alias("check_name"), F.lit(table).alias("table_name"), F.col(n).alias("error_count")) for n in sums]
        parts.append(totals.select(F.inline(F.array(*rows))))
    unmatched = {name: F.coalesce(F.sum(F.when(F.col(other) == 0, F.col("n_rows"))), F.lit(0)).alias(name) for name, (other, _) in UNMATCHED.items()}
    both = matched.agg(*unmatched.values())
    parts += [_named(name, SALES, both.select(F.col(name).alias("error_count"))) for name in unmatched]
    for table, keys in DUPLICATE.items():
        parts.append(_named(f"{table}_duplicate_key", table, _duplicates(states[table], keys).agg(F.count("*").alias("error_count"))))
    return q.all_rows(parts)


def _duplicates(state: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return state.groupBy(*keys).agg(F.sum("n_rows").alias("duplicate_count")).filter("duplicate_count > 1")


def table_samples(table: str, rows: DataFrame, failed: set[str], matched: DataFrame) -> DataFrame | None:
    """check_name and sample_json of the failed checks that sample rows of one table: one scan of it for all of them.

    Samples of unmatched rows go by key before row; a key's place among the first ones says as much, so that all checks
    of the pass share the order of rows."""
    _, shown = REQUIRED[table]
    checks = [Sampled(name, F.when(failing, 0).otherwise(1), shown) for name, failing in _failing(table).items() if name in failed]
    joins = {name: UNMATCHED[name] for name in UNMATCHED if table == SALES and name in failed}
    if joins:
        rows = rows.join(F.broadcast(_first_keys(matched, joins)), _same_key(), "left")
        checks += [Sampled(name, F.col(f"_place{i}"), columns, F.col(f"_met{i}")) for i, (name, (_, columns)) in enumerate(joins.items())]
    return first_rows(rows, checks, ROW_IDENTITY) if checks else None


def _same_key():
    return F.col(MATCH_KEYS[0]).eqNullSafe(F.col("_key0")) & F.col(MATCH_KEYS[1]).eqNullSafe(F.col("_key1"))


def _first_keys(matched: DataFrame, joins: Mapping[str, tuple]) -> DataFrame:
    """The keys that hold the first five rows of each check, unmatched ones first: five a check."""
    parts = []
    for i, (table, _) in enumerate(joins.values()):
        top = matched.select(F.when(F.col(table) == 0, 0).otherwise(1).alias("_passes"), *MATCH_KEYS, F.col(table).alias("_met"))
        top = top.orderBy("_passes", *MATCH_KEYS).limit(q.SAMPLE_ROWS)
        listed = top.agg(F.array_sort(F.collect_list(F.struct("_passes", *MATCH_KEYS, "_met"))).alias("keys"))
        placed = listed.select(F.posexplode("keys").alias("place", "key"))
        columns = [F.col(f"key.{k}").alias(f"_key{n}") for n, k in enumerate(MATCH_KEYS)]
        for n in range(len(joins)):
            columns += [(F.col("place") if n == i else F.lit(None).cast("int")).alias(f"_place{n}")]
            columns += [(F.col("key._met") if n == i else F.lit(None).cast("long")).alias(f"_met{n}")]
        parts.append(placed.select(columns))
    both = q.all_rows(parts).groupBy("_key0", "_key1")
    return both.agg(*[F.max(f"{c}{n}").alias(f"{c}{n}") for n in range(len(joins)) for c in ("_place", "_met")])


def findings_from_states(tables: Mapping[str, DataFrame], target_month: str) -> DataFrame:
    """Checks that failed, with their samples. 13 counts go to the driver; only what failed is sampled."""
    spark = next(iter(tables.values())).sparkSession
    month = {name: df.filter(F.col("target_month") == target_month) for name, df in tables.items()}
    states = written({table: table_state(table, month[table]) for table in STATE_KEYS}, "state")
    matched = written({"matched": matched_keys(states)}, "state")["matched"]
    counted = [tuple(r) for r in state_counts(states, matched).collect()]
    failed = {name for name, _, n in counted if n > 0}
    counts = spark.createDataFrame(counted, "check_name string, table_name string, error_count bigint")
    samples = [table_samples(table, month[table], failed, matched) for table in STATE_KEYS]
    for table, keys in DUPLICATE.items():
        if f"{table}_duplicate_key" in failed:
            top = _duplicates(states[table], keys).orderBy(*keys).limit(q.SAMPLE_ROWS)
            samples.append(q.as_sample(top, keys, [*keys, "duplicate_count"]).select(F.lit(f"{table}_duplicate_key").alias("check_name"), "sample_json"))
    found = counts.filter("error_count > 0")
    present = [s for s in samples if s is not None]
    sampled = q.all_rows(present) if present else spark.createDataFrame([], "check_name string, sample_json string")
    return found.join(sampled, "check_name", "left").select("check_name", F.lit(q.SEVERITY).alias("severity"), "table_name", "error_count", "sample_json")
