"""Counts of streaming flows, one row per flow and micro-batch, in a table of the run.

A listener hears of every finished micro-batch; a query itself keeps only its last
progress reports. What it hears goes through a bounded queue to the caller's thread,
which appends it to the table, so the driver holds at most ``QUEUED`` batches whatever
the length of a backlog. Totals are summed by Spark from the table. A batch that is
run again after a failure reports again under its own number; its last report counts.
"""

from __future__ import annotations

import datetime as dt
import queue
import time
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "flow STRING, batch_id BIGINT, run STRING, recorded_at TIMESTAMP, metrics MAP<STRING, BIGINT>"

#: Reports on their way to the table, and how many are appended as one file.
QUEUED = 1000
APPENDED = 100

#: Seconds to wait for the report of a query's end after the query has ended.
PATIENCE = 120


class _Reports(StreamingQueryListener):
    """Puts the observed metrics of this collector's queries, and the end of any query, into a queue."""

    def __init__(self, tag: str, reports: queue.Queue):
        self.tag, self.reports = tag, reports

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        flow, _, tag = (p.name or "").rpartition("@")
        if tag != self.tag:
            return
        counts: dict[str, int] = {}
        for row in p.observedMetrics.values():
            for name, value in row.asDict().items():
                counts[name] = counts.get(name, 0) + int(value or 0)
        self.reports.put((flow, p.batchId, tag, dt.datetime.now(), counts))

    def onQueryTerminated(self, event):
        self.reports.put(str(event.runId))


class FlowMetrics:
    """The table of one pipeline root, and the collector of the flows that are running now."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        """One row per flow and micro-batch: the last report of each."""
        rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        last = F.max_by(F.struct("run", "metrics"), "recorded_at").alias("last")
        return rows.groupBy("flow", "batch_id").agg(F.max("recorded_at").alias("recorded_at"), last).select(
            "flow", "batch_id", "last.run", "recorded_at", "last.metrics")

    def totals(self, run: str | None = None) -> DataFrame:
        """flow, name, total over all micro-batches, or those of one ``run``."""
        rows = self.table() if run is None else self.table().where(F.col("run") == run)
        return rows.select("flow", F.explode("metrics").alias("name", "value")).groupBy("flow", "name").agg(
            F.sum("value").alias("total"))

    def _append(self, rows: list) -> None:
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            rows.clear()

    def collect(self, flows: Sequence[str], start, await_end) -> tuple[dict[str, dict[str, int]], dict[str, Exception]]:
        """Run flows and return the totals of each by name, and the failures.

        ``start(flow, query_name)`` starts a flow's query; ``await_end(query)`` raises its failure once it has ended.
        """
        tag = uuid.uuid4().hex
        reports: queue.Queue = queue.Queue(QUEUED)
        listener = _Reports(tag, reports)
        self.spark.streams.addListener(listener)
        rows: list = []
        running, queries, failed = set(), {}, {}
        try:
            for flow in flows:
                queries[flow] = start(flow, f"{flow}@{tag}")
                running.add(str(queries[flow].runId))
            ended = None
            while running:
                try:
                    report = reports.get(timeout=1)
                except queue.Empty:
                    if any(q.isActive for q in queries.values()):
                        continue
                    ended = ended or time.monotonic()
                    if time.monotonic() - ended > PATIENCE:
                        raise TimeoutError("a query ended without its last report")
                    continue
                if isinstance(report, str):
                    running.discard(report)
                else:
                    rows.append(report)
                    if len(rows) >= APPENDED:
                        self._append(rows)
            self._append(rows)
        finally:
            self.spark.streams.removeListener(listener)
        for flow, q in queries.items():
            try:
                await_end(q)
            except Exception as ex:  # noqa: BLE001 - given back, one flow's failure leaves the others' totals
                failed[flow] = ex
        totals: dict[str, dict[str, int]] = {flow: {} for flow in flows}
        if len(failed) < len(queries):
            # A few counters per flow.
            for r in self.totals(tag).collect():
                totals[r["flow"]][r["name"]] = r["total"]
        return totals, failed
