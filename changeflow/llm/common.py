"""Helpers shared by the operators: lineage cuts, prefix sums and joins that stand hot keys."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_dir

#: Characters that separate words and are folded by exact dedup: space, tab, \n, \v, \f, \r.
WHITE = r"[\x20\x09-\x0D]+"

#: A side is broadcast when a count proves that it has at most this many narrow rows (under 10 MB).
BROADCAST_ROWS = 200_000


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the folder of a table made by ``written`` that no later job reads."""
    path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark) -> None:
    """Let Spark remove the shuffle files of finished jobs now: its cleaner does so when their plans are collected.

    Python's handles on plans form cycles, and hold the plans until they are collected themselves.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint when its counted ``rows`` are few, else as it is."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def prefix_sums(df: DataFrame, order: list[str], weights: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """Rows with, for each weight, the sum over all earlier rows in the global order.

    The rows are dealt to ranges of ``order`` and written with the number of
    their range; a window then adds within a range, and one row per range gives
    what the ranges before it hold. No task holds more than one range. ``order``
    must tell rows apart, or rows that tie must be interchangeable.

    Returns the rows (with a column per weight name) and the totals.
    """
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    ranged = written(ranged.withColumn("__part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("__part").agg(*[F.sum(w).cast("long").alias(f"__sum_{n}") for n, w in weights.items()])
    totals = {n: int(v or 0) for n, v in zip(weights, sums.agg(*[F.sum(f"__sum_{n}") for n in weights]).first())}
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__part", *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__off_{n}") for n in weights])
    within = Window.partitionBy("__part").orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.select("*", *[F.coalesce(F.sum(w).over(within), F.lit(0)).alias(f"__in_{n}") for n, w in weights.items()])
    # One row per range: as many rows as the shuffle has partitions.
    out = out.join(F.broadcast(offsets), "__part")
    keep = [c for c in df.columns]
    return out.select(*keep, *[(F.col(f"__in_{n}") + F.col(f"__off_{n}")).cast("long").alias(n) for n in weights]), totals


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], weight: str, rows: int, how: str = "left", share: int = 1000) -> DataFrame:
    """``left`` joined with ``right`` (one row per key), hot keys apart.

    ``weight`` counts the left rows of a key, ``rows`` all of them. Keys with over 1/``share`` of the rows number
    less than ``share``; they are broadcast, so their rows stay where they are. The rest is an ordinary join.
    """
    hot = right.where(F.col(weight) * share > F.lit(rows))
    cold = right.where(F.col(weight) * share <= F.lit(rows))
    few = F.broadcast(hot)
    return left.join(few, keys, "inner").unionByName(left.join(few.select(*keys), keys, "left_anti").join(cold, keys, how))
