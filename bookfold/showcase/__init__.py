"""Every operator on the driver tables, with its comparison SQL."""

from bookfold.showcase import checks, files, ledger, loads, months, refined, scalars, sheets  # noqa: F401  (registers the queries)
from bookfold.showcase.registry import ORACLE, QUERIES  # noqa: F401
