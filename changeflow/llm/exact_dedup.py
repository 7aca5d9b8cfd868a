"""Exact dedup over an extendible-hash index kept on shared files.

Each row gets a key, a 64-bit hash of its normalised text. A histogram of key
prefixes drives directory doubling: a bucket with more rows than its capacity is
split by one more key bit until it fits or the directory has its full depth. A
bucket that is overfull even then holds long chains and is cut into parts, each
about as large as an ordinary bucket. The directory then routes all work:

* Owner tasks take ranges of (bucket, key, part), count the rows of each chain and
  write the index pages (key, row, length of the chain), one file per range.
* Chains of one row are done. Where a chain is longer, or lies in a bucket of
  several parts, its parts are added up.
* The texts are looked up by way of the directory: prefix, bucket, chain. Those
  of longer chains are compared byte by byte, and different texts of one key are
  kept apart. Only these texts are moved, one of equal texts per task.

Defined results: null text counts as empty. Of equal texts the smallest id stays;
null ids come last. Of rows that repeat id and text exactly one is kept. Any
extra columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, broadcast_if_small, join_hot, written

#: Rows that a bucket holds before it splits, and the deepest directory (2**14 entries). Where a directory of full
#: depth would hold over an eighth of that in each bucket (8.4 million rows), buckets hold more: rows / 2**11.
CAPACITY = 4096
MAX_DEPTH = 14


def normalised(text: str = "text") -> Column:
    """White-space runs folded to one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " ")


def key_of(norm: str) -> Column:
    return F.xxhash64(norm)


def prefix_of(depth: int, key: str = "key") -> Column:
    """The top ``depth`` bits of a key."""
    return F.shiftrightunsigned(F.col(key), 64 - depth).cast("int") if depth else F.lit(0)


def grow_directory(counts: dict[int, int], depth: int, capacity: int) -> list[tuple[int, int]]:
    """Buckets as (prefix, local depth), from row counts by prefix of ``depth`` bits (at most 2**depth entries).

    Starts with one bucket and, round after round, splits every overfull one in two; where a bucket's depth
    passes that of the directory, the directory doubles. A bucket that is overfull at full depth keeps a chain.
    """
    level, done = {0: sum(counts.values())}, []
    for local in range(depth + 1):
        split = set()
        for prefix, rows in level.items():
            if rows <= capacity or local == depth:
                done.append((prefix, local))
            else:
                split.add(prefix)
        level = {child: 0 for prefix in split for child in (2 * prefix, 2 * prefix + 1)}
        for prefix, rows in counts.items():
            child = prefix >> max(0, depth - local - 1)
            if local < depth and child >> 1 in split:
                level[child] += rows
    return done


def build_index(entries: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, DataFrame, int]:
    """The index pages, the directory and the number of rows.

    The pages hold the entries with their ``bucket``, the ``parts`` of the bucket, and ``chained``: the rows of the same
    bucket, key and part. The directory has a row per prefix at full depth: at most 2**max_depth, whatever the input.
    """
    spark = entries.sparkSession
    rows = entries.count()
    depth = min(max_depth, max(1, math.ceil(math.log2(max(2.0, rows / capacity))) + 3))
    capacity = max(capacity, rows >> (max_depth - 3))
    counts = {r["prefix"]: r["n"] for r in entries.groupBy(prefix_of(depth).alias("prefix")).agg(F.count(F.lit(1)).alias("n")).collect()}
    usual = max(1, rows >> depth)
    directory = []
    for prefix, local in grow_directory(counts, depth, capacity):
        first = prefix << (depth - local)
        # Only a bucket of full depth can be overfull; it is one slot.
        held = counts.get(prefix, 0) if local == depth else 0
        parts = -(-held // usual) if held > capacity else 1
        directory += [(slot, first, local, parts) for slot in range(first, first + (1 << (depth - local)))]
    directory = spark.createDataFrame(directory, "prefix int, bucket int, local_depth int, parts int")
    pages = routed(entries, directory).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    # The window has the partitioning of the ranges: a task counts the chains that it owns, and writes them.
    chain = Window.partitionBy("bucket", "key", "part")
    pages = pages.repartitionByRange("bucket", "key", "part").withColumn("chained", F.count(F.lit(1)).over(chain))
    return written(pages, "index"), directory, rows


def routed(df: DataFrame, directory: DataFrame) -> DataFrame:
    """Rows with the ``bucket`` of their ``key`` and its ``parts``, looked up in the directory."""
    # The directory has all slots of its depth, so the last prefix tells the depth.
    depth = max(0, directory.agg(F.max("prefix")).first()[0].bit_length())
    slots = F.broadcast(directory.select("prefix", "bucket", "parts"))
    return df.withColumn("prefix", prefix_of(depth)).join(slots, "prefix").drop("prefix")


def chain_groups(norm: DataFrame, key, index: DataFrame, directory: DataFrame, rows: int) -> DataFrame:
    """One row per document, from the chains of the index and the texts ``__norm`` that the directory leads to them."""
    alone = index.where("chained = 1 AND parts = 1")
    shared = index.where("chained > 1 OR parts > 1")
    chains = written(shared.groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "key"), "chains")
    n_chains = chains.count()
    probe = routed(norm.select(key("__norm").alias("key"), "__norm"), directory)
    texts = probe.join(broadcast_if_small(chains, n_chains), ["bucket", "key"], "left_semi")
    # The different texts of each chain. Grouping compares whole texts, once per task before any shuffle.
    met = texts.groupBy("bucket", "key", "__norm").agg(F.count(F.lit(1)).alias("group_size"))
    met = met.select("bucket", "key", F.sha2("__norm", 256).alias("text_sha256"), "group_size").where("group_size > 1")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    heads = shared.join(broadcast_if_small(chains, n_chains), ["bucket", "key"], "left_semi").groupBy("bucket", "key", "text_sha256").agg(first)
    on = ["bucket", "key", "text_sha256"]
    groups = written(met.join(heads, on), "groups")
    out = join_hot(shared, groups, on, "group_size", rows)
    out = out.unionByName(alone.withColumns({"group_size": F.lit(1).cast("long"), "first": F.lit(None).cast(groups.schema["first"].dataType)}))
    return out.select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
        "bucket",
    )


def exact_groups(docs: DataFrame, key=key_of, capacity: int = CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket.

    ``key``: hash of the normalised text column, a long; a weak one only makes chains longer.
    """
    norm = docs.select("doc_id", normalised().alias("__norm"))
    entries = norm.select("doc_id", key("__norm").alias("key"), F.sha2("__norm", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row"))
    return chain_groups(norm, key, *build_index(written(entries, "entries"), capacity))


def keep_first(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs``, all columns, without later copies. Of rows with equal id and text any one stays."""
    groups = written(exact_groups(docs, capacity=capacity), "exact")
    dropped = groups.groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    dropped = written(dropped.where("NOT kept OR n > 1"), "dropped")
    n = dropped.count()
    packed = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__id"), F.sha2(normalised(), 256).alias("__sha"))

    def same(side: DataFrame) -> Column:
        return packed["__id"].eqNullSafe(side["__id"]) & (packed["__sha"] == side["__sha"])

    few = broadcast_if_small(dropped, n)
    rest = packed.join(few, same(few), "left_anti").select("__row.*")
    again = dropped.where("kept")
    m = again.count()
    if not m:
        return rest
    again = broadcast_if_small(again, m)
    return rest.unionByName(packed.join(again, same(again), "left_semi").dropDuplicates(["__id", "__sha"]).select("__row.*"))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256 FROM t"""
