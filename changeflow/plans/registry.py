"""Query registry: one Spark callable per operator key, with its DuckDB oracle SQL.

Query modules register with ``@query``; ``catalog`` imports them all.

Output conventions (shared with the oracle): flat columns with explicit
aliases, sums of money rounded to 2 places, counts as BIGINT, timestamps as
TIMESTAMP_NTZ, arrays joined to text in rule order.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def r2(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 2)


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """Scalar subqueries in one row: union the one-row aggregates, then max() per column.

    No join is needed; each input is a global aggregate with exactly one row.
    """
    cols = [c for df in one_row for c in df.columns]
    parts = []
    for df in one_row:
        types = dict(df.dtypes)
        parts.append(df.select(*[
            F.col(c) if c in types else F.lit(None).alias(c) for c in cols
        ]))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=False)
    return u.agg(*[F.max(c).alias(c) for c in cols])


