"""Operators bound to the benchmark tables, each with its SQL twin.

A binding only maps columns of the given tables onto an operator's arguments.
"""

from gridlake.suite import (  # noqa: F401
    aggregates,
    catalog,
    files,
    functions,
    market,
    quality,
    relational,
    sql_text,
    udfs,
    windows,
)
from gridlake.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
