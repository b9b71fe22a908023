"""Header-label keys: the form in which a header cell and a known label are compared."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookfold.functions.cleanse import CELL_SPACE, as_column

# Characters that do not count when labels are compared.
IGNORED_IN_LABELS = CELL_SPACE + "_-()/（）・."


_DELETE_IGNORED = dict.fromkeys(map(ord, IGNORED_IN_LABELS))


def label_key(label: str) -> str:
    """Compatibility form, lower case, without space and punctuation."""
    return unicodedata.normalize("NFKC", label).lower().translate(_DELETE_IGNORED)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _label_keys(cells: pa.Array) -> pa.Array:
    # Spark has no NFKC function, and Arrow's leaves characters decomposed.
    keys = [None if text is None else label_key(text) for text in cells.values.to_pylist()]
    return type(cells).from_arrays(cells.offsets, pa.array(keys, pa.string()))


def label_keys(values: Column | str) -> Column:
    """Array of clean cells -> array of comparison keys; null stays null."""
    return _label_keys(as_column(values))


# Characters that the compatibility form keeps and whose lower case is among them.
_PLAIN = r"\x00-\x7f\xc0-\xff"


def may_be_label(keys: Iterable[str]) -> str:
    """A pattern that finds something in every cell whose key is one of ``keys``, and nothing in most others.

    A cell of plain characters must spell a key, with ignored ones anywhere; any other cell may be a label."""
    ignored = "[" + "".join(f"\\x{ord(c):02x}" for c in IGNORED_IN_LABELS if re.fullmatch(f"[{_PLAIN}]", c)) + "]*+"
    plain = sorted(key for key in set(keys) if re.fullmatch(f"[{_PLAIN}]*", key))
    spelled = "|".join("".join(f"\\x{ord(c):02x}{ignored}" for c in key) for key in plain)
    return f"[^{_PLAIN}]" + (f"|(?iu)\\A{ignored}(?:{spelled})\\z" if plain else "")
