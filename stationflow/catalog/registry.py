"""Registered queries, each next to the SQL it has to agree with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

# Means of two-decimal values often end in an exact half of the last compared digit, where two
# engines may round apart. Results are compared after this shift (in units of that digit).
OFF_HALF = 0.1718281828

ROUNDED = re.compile(r"\bR([246])\(")


def expand(sql: str) -> str:
    """Write ``R6(x)`` (and R4, R2) out as the rounding of :func:`data.r6`."""
    while (hit := ROUNDED.search(sql)) is not None:
        digits, depth, end = int(hit.group(1)), 1, hit.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = f"round_even(CAST({sql[hit.end():end - 1]} AS DOUBLE) + {OFF_HALF!r} / 1e{digits}, {digits})"
        sql = sql[:hit.start()] + inner + sql[end:]
    return sql


QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name; without ``sql`` only its rows are checked."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = expand(sql)
        return fn
    return add
