"""Run-to-completion streaming: ``trigger(availableNow=True)`` + ``awaitTermination``.

Each stream writes to a parquet sink with its own checkpoint, both under the
shared checkpoint folder (``session.checkpoint_root``). Re-running on the same
checkpoint processes only files it has not seen (exactly-once file source +
idempotent file sink).
"""

from __future__ import annotations

import os
import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import work_dir


@dataclass(frozen=True)
class StreamTarget:
    """Where one streaming table lives: its data folder and its checkpoint."""

    path: str
    checkpoint: str

    @classmethod
    def create(cls, spark: SparkSession, name: str) -> "StreamTarget":
        root = work_dir(spark, name)
        return cls(os.path.join(root, "data"), os.path.join(root, "_checkpoint"))


_START_LOCK = threading.Lock()
STATE_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Rows of a stream that one task of a shuffle sorts; more would be spilled.
ROWS_PER_TASK = 1_000_000


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Shuffle partitions for a micro-batch of ``rows``: the cluster's parallelism, or what keeps tasks at ``ROWS_PER_TASK``."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def run_available_now(stream: DataFrame, target: StreamTarget, output_mode: str = "append",
                      query_name: str | None = None, state_partitions: int | None = None):
    """Process everything available now, then stop. Returns the finished StreamingQuery."""
    return await_query(start_available_now(stream, target, output_mode, query_name, state_partitions))


def await_query(q):
    """Wait for an availableNow query to finish; re-raise its failure."""
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def start_available_now(stream: DataFrame, target: StreamTarget, output_mode: str = "append",
                        query_name: str | None = None, state_partitions: int | None = None):
    """Start an availableNow query (it runs in the background until the input is drained).

    Stateful operators (windows, dedup) keep one state-store partition per shuffle
    partition, fixed in the checkpoint at the first start and never coalesced by
    AQE. They are sized to the cluster's parallelism (or ``state_partitions``, which
    a join with a static table sets to its rows: see ``partitions_for``)
    rather than to the batch-query setting, and kept in the RocksDB state store
    unless the session chose another provider; the session values are restored
    once the query has cloned its own session.
    """
    spark = stream.sparkSession
    w = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", target.checkpoint)
        .option("compression", "zstd")
        .outputMode(output_mode)
        .trigger(availableNow=True)
    )
    if query_name:
        w = w.queryName(query_name)
    n = state_partitions or spark.sparkContext.defaultParallelism
    settings = {"spark.sql.shuffle.partitions": str(n)}
    if spark.conf.get(STATE_PROVIDER_CONF, None) is None or spark.conf.get(STATE_PROVIDER_CONF).endswith(
            "HDFSBackedStateStoreProvider"):
        # State beyond executor memory: RocksDB keeps it on local disk, checkpointed to the shared folder.
        settings[STATE_PROVIDER_CONF] = ROCKSDB_PROVIDER
    with _START_LOCK:  # the swap is session-wide: one start at a time
        previous = {k: spark.conf.get(k, None) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            q = w.start(target.path)
        finally:
            for k, v in previous.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)
    return q


def read_sink(spark: SparkSession, target: StreamTarget) -> DataFrame:
    """Batch read of a streaming parquet sink (only committed files, via the sink's log)."""
    return spark.read.parquet(target.path)
