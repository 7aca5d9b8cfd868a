"""Skew-safe "next value within a key" (a ``lead`` that splits hot keys).

``Window.partitionBy(key)`` sends every row of a key to one task; if one key holds a third of the log, that
task sorts a third of the data. Keys above ``hot_rows`` rows take another way: their rows are range-partitioned on (key,
sequence, tie-break, row hash), so that equal and NULL sequences are split too, and numbered in order. The first
row of each partition is sent to the partition before it as well, where it follows the last row; the window then runs per
partition. All of it is one lazy plan: which keys are hot is found by a partial count and a broadcast of the hot
keys, of which there are at most rows / ``hot_rows``. Without hot keys adaptive execution drops the second way.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 2_000_000
#: Row numbers of ``monotonically_increasing_id`` hold the partition above this many bits.
ROW_BITS = 33


def _order(keys: Sequence[str], sequence_by: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in [*keys, sequence_by, *tiebreak]]


def lead_by_range(
    df: DataFrame, keys: Sequence[str], sequence_by: str, tiebreak: Sequence[str] = (), out_col: str = "_next_seq"
) -> DataFrame:
    """Add ``out_col`` = ``sequence_by`` of the next row within ``keys``, without gathering a key in one task."""
    hashed = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    order = [*_order(keys, sequence_by, tiebreak), F.xxhash64(*hashed).asc()]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    part = F.shiftright("_row", ROW_BITS)
    begins = (F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) == 0) & (part > 0)
    sent = placed.withColumn("_to", F.explode(F.when(begins, F.array(part, part - 1)).otherwise(F.array(part))))
    after = F.lead(F.struct(*keys, F.col(sequence_by).alias("_s"))).over(Window.partitionBy("_to").orderBy("_row"))
    out = sent.withColumn("_after", after).where(F.col("_to") == part)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_after")[k])
    return out.withColumn(out_col, F.when(F.col("_after").isNotNull() & same, F.col("_after._s"))).drop("_row", "_to", "_after")


def lead_sequence(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tiebreak: Sequence[str] = (),
    out_col: str = "_next_seq",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``out_col`` = ``sequence_by`` of the next row by (sequence_by, *tiebreak) within ``keys``.

    Rows with a NULL key follow each other like those of any key, in one task.
    """
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(counts.filter(F.col("_n") > hot_rows).select(*keys))
    w = Window.partitionBy(*keys).orderBy(*_order((), sequence_by, tiebreak))
    cold = df.join(hot, keys, "left_anti").select(*df.columns).withColumn(out_col, F.lead(sequence_by).over(w))
    return cold.unionByName(lead_by_range(df.join(hot, keys, "left_semi").select(*df.columns), keys, sequence_by, tiebreak, out_col))
