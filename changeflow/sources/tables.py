"""Readers for the given parquet tables.

Each reader returns a lazy DataFrame; Catalyst prunes columns and pushes filters
into the parquet scan, so callers select only what they use.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """A table as a file stream: its one file, or the part files of its folder."""
    path = table_path(sf_dir, name)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(jpath).isDirectory()
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # A stream reads folders; a single file is picked from its folder by name.
    return r.parquet(path) if folder else r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))
