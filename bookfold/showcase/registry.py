"""Queries over the driver tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookfold.functions.cleanse import CELL_SPACE, INT_NOISE, MONEY_NOISE, RATE_NOISE, WHITE_SPACE
from bookfold.showcase.frames import for_duckdb

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; frame placeholders in ``oracle`` become table names."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLE[function.__name__] = for_duckdb(oracle)
        return function

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that any client compares them alike."""
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            columns.append(F.col(field.name).cast("double").alias(field.name))
        elif isinstance(field.dataType, T.DateType):
            columns.append(F.col(field.name).cast("string").alias(field.name))
        else:
            columns.append(F.col(field.name))
    return df.select(columns)


# DuckDB spellings of the column functions.

def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _chars(characters: str) -> str:
    return " || ".join(f"chr({ord(c)})" for c in characters)


def sql_trim(value: str) -> str:
    return f"trim({value}, {_chars(WHITE_SPACE)})"


def sql_clean(value: str) -> str:
    text = f"trim(replace(coalesce({value}, ''), chr(12288), ' '), {_chars(CELL_SPACE)})"
    return f"CASE WHEN lower({text}) = 'nan' THEN '' ELSE {text} END"


def sql_blank_to_null(value: str) -> str:
    return f"nullif({sql_trim(value)}, '')"


def _sql_decimal(value: str, noise: str) -> str:
    digits = f"translate({value}, {sql_text(noise)}, '')"
    number = f"try_cast({digits} AS DECIMAL(38, 9))"
    return f"CASE WHEN regexp_full_match({digits}, '[-+]?[0-9]+([.][0-9]*)?([eE][-+]?[0-9]+)?') THEN CAST({number} AS DOUBLE) END"


def sql_money(value: str) -> str:
    return _sql_decimal(value, MONEY_NOISE)


def sql_rate(value: str) -> str:
    return _sql_decimal(value, RATE_NOISE)


def sql_int(value: str) -> str:
    digits = f"translate({value}, {sql_text(INT_NOISE)}, '')"
    return f"CASE WHEN regexp_full_match({digits}, '[-+]?[0-9]+') THEN try_cast({digits} AS BIGINT) END"


def sql_date(value: str) -> str:
    text = sql_trim(value)
    tries = [
        ("[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", "%Y/%m/%d"),
        ("[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", "%Y-%m-%d"),
        ("[0-9]{8}", "%Y%m%d"),
    ]
    cases = " ".join(f"WHEN regexp_full_match({text}, '{p}') THEN try_strptime({text}, '{f}')" for p, f in tries)
    return f"CAST(CAST(CASE {cases} END AS DATE) AS VARCHAR)"


SQL_REFINE = {
    "text": sql_blank_to_null,
    "money": sql_money,
    "rate": sql_rate,
    "int": sql_int,
    "date": sql_date,
}
