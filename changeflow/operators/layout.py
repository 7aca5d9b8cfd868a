"""Data layout jobs: Z-order compaction and clustered writes (rows never change, only their files).

Z-order: each column is scaled into ``bits`` range buckets (min/max from one
aggregate), the bucket numbers are bit-interleaved into a Morton key with
``shiftleft`` / ``bitwiseOR`` (pure Catalyst expressions), and the table is
range-partitioned on that key into files of about ``rows_per_file`` rows,
sorted within each file. Nearby values of all the columns land in the same
files, so parquet min/max statistics skip files for filters on any of them.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeutil import ntz_micros

ROWS_PER_FILE = 1_000_000


def _numeric(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    if isinstance(t, T.TimestampNTZType):
        return ntz_micros(c)
    if isinstance(t, T.TimestampType):
        return F.unix_micros(F.col(c))
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(c)).cast("bigint")
    if isinstance(t, T.StringType):
        return F.conv(F.hex(F.substring(F.col(c), 1, 7)), 16, 10).cast("bigint")
    return F.col(c).cast("double")


def _bounds(df: DataFrame, cols: Sequence[str]):
    """Row count and each column's min / max in one aggregate (the driver reads one row)."""
    nums = {c: _numeric(df, c) for c in cols}
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [x for c in cols for x in (F.min(nums[c]).alias(f"lo_{c}"), F.max(nums[c]).alias(f"hi_{c}"))]
    return nums, df.agg(*aggs).first()


def zorder_key(df: DataFrame, cols: Sequence[str], bits: int | None = None, bounds=None) -> Column:
    """Morton (Z-order) key over ``cols`` from range buckets of each column."""
    cols = list(cols)
    bits = bits or max(1, 62 // len(cols))
    nums, row = bounds or _bounds(df, cols)
    top = (1 << bits) - 1
    buckets = []
    for c in cols:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        if lo is None or hi is None or hi == lo:
            b = F.lit(0).cast("bigint")
        else:
            scaled = (nums[c].cast("double") - F.lit(float(lo))) / F.lit(float(hi - lo)) * F.lit(float(top))
            b = F.coalesce(F.floor(scaled).cast("bigint"), F.lit(0).cast("bigint"))
        buckets.append(b)
    key = F.lit(0).cast("bigint")
    n = len(cols)
    for i in range(bits):
        for j, b in enumerate(buckets):
            bit = F.shiftright(b, i).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(bit, i * n + j))
    return key


def zorder(df: DataFrame, cols: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Rows laid out along the Z-curve of ``cols`` in files of about ``rows_per_file`` rows."""
    bounds = _bounds(df, list(cols))
    parts = max(1, math.ceil(bounds[1]["_n"] / rows_per_file))
    key = zorder_key(df, cols, bounds=bounds)
    # A deterministic row hash as the second range key lets rows sharing one Z value (a hot
    # customer on one day) spread over several files instead of one task.
    return (
        df.withColumn("_z", key).withColumn("_h", _row_hash(df))
        .repartitionByRange(parts, "_z", "_h").sortWithinPartitions("_z", "_h").drop("_z", "_h")
    )


def clustered(df: DataFrame, cols: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Liquid-clustering-like layout: range partitions on ``cols``, sorted within each file."""
    n = df.count()
    parts = max(1, math.ceil(n / rows_per_file))
    return (
        df.withColumn("_h", _row_hash(df)).repartitionByRange(parts, *cols, "_h")
        .sortWithinPartitions(*cols, "_h").drop("_h")
    )


def _row_hash(df: DataFrame) -> Column:
    """Deterministic hash of the whole row (stable across task retries)."""
    return F.xxhash64(*[F.col(c) for c in df.columns])
