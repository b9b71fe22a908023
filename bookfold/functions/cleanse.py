"""Column expressions for cell cleaning and safe typing. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points with the Unicode White_Space property.
_SPACE_CODES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WHITE_SPACE = "".join(map(chr, _SPACE_CODES))
# What is trimmed from a sheet cell also counts the four ASCII separator controls as space.
CELL_SPACE = WHITE_SPACE + "\u001c\u001d\u001e\u001f"

# Characters that numbers may carry, and how a month stands in a file name.
MONEY_NOISE = ",￥¥ "
RATE_NOISE = "%％, "
INT_NOISE = ", "

MONTH_PATTERN = r"(20\p{Nd}{2})(?:年)?(0[1-9]|1[0-2])"
DATE_PATTERN = r"^([0-9]{4})(?:([-/])([0-9]{1,2})\2([0-9]{1,2})|([0-9]{2})([0-9]{2}))\z"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trim_space(value: Column | str) -> Column:
    return F.btrim(as_column(value), F.lit(WHITE_SPACE))


def clean_cell(value: Column | str) -> Column:
    """Cell text as stored: never null, trimmed, ideographic spaces narrowed, ``nan`` blanked."""
    text = F.btrim(_narrow_space(as_column(value)), F.lit(CELL_SPACE))
    return F.when(_is_nan(text), F.lit("")).otherwise(text)


def _narrow_space(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("\u3000"), F.lit(" "))


def _is_nan(text: Column) -> Column:
    return F.lower(F.substring(text, 1, 4)) == "nan"  # four characters: a long cell is not copied


def clean_cells(values: Column | str) -> Column:
    """``clean_cell`` on every element; two passes, as a lambda would trim each cell twice."""
    trimmed = F.transform(as_column(values), lambda v: F.btrim(_narrow_space(v), F.lit(CELL_SPACE)))
    return F.transform(trimmed, lambda v: F.when(_is_nan(v), F.lit("")).otherwise(v))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(trim_space(value), F.lit(""))


def has_text(value: Column | str) -> Column:
    """Not blank, and never null."""
    return F.coalesce(trim_space(value) != "", F.lit(False))


def _decimal_without(value: Column | str, noise: str) -> Column:
    digits = F.translate(as_column(value), noise, "")
    # The decimal parser reads any Unicode digit; equal byte and character lengths keep it to ASCII. Text without a digit is
    # kept from it, as it throws, and a thrown exception takes longer than all else that is done for a cell.
    return F.when((F.octet_length(digits) == F.length(digits)) & digits.rlike("[0-9]"), digits.try_cast("decimal(38,9)"))


def money(value: Column | str) -> Column:
    return _decimal_without(value, MONEY_NOISE)


def rate(value: Column | str) -> Column:
    """``10%`` is 10, not 0.10."""
    return _decimal_without(value, RATE_NOISE)


def whole_number(value: Column | str) -> Column:
    """Digits and a sign; a point or an exponent makes it none. As for decimals, the parser that throws gets no other text."""
    digits = F.translate(as_column(value), INT_NOISE, "")
    return F.when(digits.rlike("[0-9]") & ~digits.rlike("[!-*,./:-~]"), digits.try_cast("bigint"))


def calendar_date(value: Column | str) -> Column:
    """``2025/6/1``, ``2025-06-01`` or ``20250601``; a year has four digits and is 0001 at least; anything else is null."""
    text = trim_space(value)
    iso = F.regexp_replace(text, DATE_PATTERN, "$1-$3$5-$4$6")
    return F.when(text.rlike(DATE_PATTERN) & ~text.startswith("0000"), iso.try_cast("date"))


def refine(value: Column | str, refined_type: str) -> Column:
    return {
        "text": blank_to_null,
        "money": money,
        "rate": rate,
        "int": whole_number,
        "date": calendar_date,
    }[refined_type](value)


def product_key(code: Column | str) -> Column:
    """Null when the code is null."""
    return F.concat(F.lit("01-"), as_column(code))


def own_or_master(own: Column | str, master: Column | str) -> Column:
    return F.coalesce(as_column(own), as_column(master))


def month_in_name(name: Column | str) -> Column:
    """First ``YYYYMM`` or ``YYYY年MM`` anywhere in the text, as ``YYYYMM``."""
    text = as_column(name)
    digits = F.concat(F.regexp_extract(text, MONTH_PATTERN, 1), F.regexp_extract(text, MONTH_PATTERN, 2))
    return F.nullif(digits, F.lit(""))


def cell_at(values: Column | str, index: Column | int) -> Column:
    """Blank when there is no such cell."""
    position = F.lit(index) if isinstance(index, int) else index
    return F.coalesce(F.get(as_column(values), position), F.lit(""))


def pad_cells(values: Column | str, width: Column) -> Column:
    cells = as_column(values)
    return F.concat(cells, F.array_repeat(F.lit(""), F.greatest(width - F.size(cells), F.lit(0))))


# Escapes a JSON string needs, in the form with lower-case hexadecimal digits.
_SHORT_ESCAPES = {"\b": r"\b", "\t": r"\t", "\n": r"\n", "\f": r"\f", "\r": r"\r"}
_NEEDS_ESCAPE = r'["\\\x00-\x1f]'


def _json_string(text: Column) -> Column:
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for code in range(0x20):
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(_SHORT_ESCAPES.get(chr(code), f"\\u{code:04x}")))
    body = F.when(text.rlike(_NEEDS_ESCAPE), escaped).otherwise(text)
    return F.concat(F.lit('"'), body, F.lit('"'))


def payload_json(values: Column | str) -> Column:
    """The cells as a JSON list, a space after each comma, non-ASCII text kept."""
    cells = as_column(values)
    quoted = F.concat(F.lit('["'), F.array_join(cells, '", "'), F.lit('"]'))
    escaped = F.concat(F.lit("["), F.array_join(F.transform(cells, _json_string), ", "), F.lit("]"))
    # Escaping goes cell by cell, so it is kept for the rows that need it.
    return (
        F.when(F.size(cells) == 0, F.lit("[]"))
        .when(F.array_join(cells, " ").rlike(_NEEDS_ESCAPE), escaped)
        .otherwise(quoted)
    )


def rows_json(values: Column | str) -> Column:
    """An array of structs as JSON, null fields written out."""
    return F.to_json(as_column(values), {"ignoreNullFields": "false"})
