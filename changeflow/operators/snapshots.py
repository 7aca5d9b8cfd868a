"""Versioned snapshots: UPDATE / DELETE / MERGE as new versions, change feed, restore, retention.

Open-source parquet tables have no transaction log, so a table here is a
folder of versions ``<root>/v=<n>`` (each written once, never modified) plus a
commit table ``<root>/_commits`` with one row per version: version, timestamp,
operation, operationParameters and operationMetrics maps. Time travel is a
read of one version; RESTORE writes an old version as a new one. Writing every
version also cuts the lineage between steps, so a lost executor recomputes at
most one step.

Metrics are computed by Spark from the data (aggregates over the step's
input), never by the driver walking rows.
"""

from __future__ import annotations

import datetime as dt
import os
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .cdc import merge_upsert

METRIC_KEYS = (
    "numTargetRowsUpdated", "numTargetRowsDeleted", "numTargetRowsInserted", "numOutputRows",
    "numRemovedFiles", "numAddedFiles",
)



def ntz(t: dt.datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{t:%Y-%m-%d %H:%M:%S}'")


def update_rows(df: DataFrame, set_exprs: Mapping[str, str], where: str | Column) -> DataFrame:
    """UPDATE ... SET col = expr WHERE pred; adds ``_touched`` (row matched the predicate)."""
    cond = F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))
    out = df.withColumn("_touched", cond)
    for c, e in set_exprs.items():
        out = out.withColumn(c, F.when(F.col("_touched"), F.expr(e)).otherwise(F.col(c)))
    return out


def delete_rows(df: DataFrame, where: str | Column | None = None) -> DataFrame:
    """DELETE WHERE pred (all rows when ``where`` is None); adds ``_touched`` = row is deleted."""
    cond = F.lit(True) if where is None else F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))
    return df.withColumn("_touched", cond)


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level changes between two versions keyed by ``keys``.

    ``_change_type`` is insert, delete, update_preimage or update_postimage; a key
    present in both versions with any column distinct (null-safe) yields a
    pre/post pair. One full-outer join on the key, no per-row Python.
    """
    keys = list(keys)
    cols = new.columns
    o = old.select(*keys, F.struct(*cols).alias("_o"), F.lit(True).alias("_in_old"))
    n = new.select(*keys, F.struct(*cols).alias("_n"), F.lit(True).alias("_in_new"))
    j = o.join(n, keys, "full_outer")
    same = None
    for c in cols:
        e = F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}"))
        same = e if same is None else same & e
    in_old, in_new = F.col("_in_old").isNotNull(), F.col("_in_new").isNotNull()
    events = F.when(in_old & ~in_new, F.array(F.struct(F.col("_o").alias("row"), F.lit("delete").alias("t")))).when(
        ~in_old & in_new, F.array(F.struct(F.col("_n").alias("row"), F.lit("insert").alias("t")))
    ).when(
        in_old & in_new & ~same,
        F.array(
            F.struct(F.col("_o").alias("row"), F.lit("update_preimage").alias("t")),
            F.struct(F.col("_n").alias("row"), F.lit("update_postimage").alias("t")),
        ),
    )
    return (
        j.select(F.explode(events).alias("_e"))
        .select("_e.row.*", F.col("_e.t").alias("_change_type"))
    )


class SnapshotTable:
    """A folder of immutable parquet versions plus a commit table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._latest: int | None = None

    def _vpath(self, v: int) -> str:
        return os.path.join(self.root, f"v={v}")

    def _cpath(self, v: int) -> str:
        return os.path.join(self.root, "_commits", f"v={v}")

    def latest_version(self) -> int | None:
        if self._latest is None:
            h = self.history()
            self._latest = None if h is None else h.agg(F.max("version")).first()[0]
        return self._latest

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def history(self) -> DataFrame | None:
        p = os.path.join(self.root, "_commits")
        if not self._exists(p):
            return None
        h = self.spark.read.parquet(p)
        return h.select("version", "timestamp", "operation", "operationParameters", "operationMetrics")

    def read(self, version: int | None = None) -> DataFrame:
        v = self.latest_version() if version is None else version
        if v is None:
            raise ValueError("table has no version")
        return self.spark.read.parquet(self._vpath(v))

    def commit(
        self,
        df: DataFrame,
        operation: str,
        committed_at: dt.datetime,
        params: Mapping[str, str] | None = None,
        metrics: Mapping[str, Column] | None = None,
        keep: Column | None = None,
        helpers: Sequence[str] = (),
    ) -> int:
        """Write ``df`` (rows where ``keep`` holds, without ``helpers``) as the next version, with one commit row.

        ``metrics`` are aggregate Columns over ``df`` (before ``keep``); they and the
        output row count are gathered with ``observe`` during the write job itself —
        no second pass over the data.
        """
        from pyspark.sql import Observation

        prev = self.latest_version()
        v = 0 if prev is None else prev + 1
        before, after = Observation(f"{operation}-in-{v}"), Observation(f"{operation}-out-{v}")
        out = df
        if metrics:
            out = out.observe(before, *[c.alias(k) for k, c in metrics.items()])
        if keep is not None:
            out = out.filter(keep)
        out = out.observe(after, F.count(F.lit(1)).alias("numOutputRows"))
        out.drop(*helpers).write.mode("errorifexists").parquet(self._vpath(v))
        values = {**(before.get if metrics else {}), **after.get}
        values["numAddedFiles"] = len(self.spark.read.parquet(self._vpath(v)).inputFiles())
        mvals = {k: None if values.get(k) is None else str(values[k]) for k in METRIC_KEYS if k in values}
        commit = self.spark.createDataFrame(
            [(v, committed_at, operation, {k: str(x) for k, x in (params or {}).items()}, mvals)],
            "version BIGINT, timestamp TIMESTAMP_NTZ, operation STRING, "
            "operationParameters MAP<STRING, STRING>, operationMetrics MAP<STRING, STRING>",
        )
        commit.coalesce(1).write.mode("errorifexists").parquet(self._cpath(v))
        self._latest = v
        return v

    # -- user-level operations, each one new version ------------------------------------

    def create(self, df: DataFrame, committed_at: dt.datetime) -> int:
        return self.commit(df, "CREATE TABLE AS SELECT", committed_at)

    def update(self, set_exprs: Mapping[str, str], where: str, committed_at: dt.datetime) -> int:
        u = update_rows(self.read(), set_exprs, where)
        return self.commit(u, "UPDATE", committed_at, {"predicate": where}, {
            "numTargetRowsUpdated": F.count_if("_touched"),
            "numTargetRowsDeleted": F.lit(0).cast("bigint"),
            "numTargetRowsInserted": F.lit(0).cast("bigint"),
        }, helpers=("_touched",))

    def delete(self, where: str | None, committed_at: dt.datetime) -> int:
        d = delete_rows(self.read(), where)
        return self.commit(d, "DELETE", committed_at, {"predicate": where or "true"}, {
            "numTargetRowsUpdated": F.lit(0).cast("bigint"),
            "numTargetRowsDeleted": F.count_if("_touched"),
            "numTargetRowsInserted": F.lit(0).cast("bigint"),
        }, keep=~F.col("_touched"), helpers=("_touched",))

    def merge(self, source: DataFrame, on: Sequence[str], committed_at: dt.datetime,
              matched_condition: str | None = None, update_set: Mapping[str, str] | None = None) -> int:
        m = merge_upsert(self.read(), source, on, matched_condition, update_set, insert=True, action_col="_action")
        return self.commit(m, "MERGE", committed_at, {"predicate": " AND ".join(f"t.{k} = s.{k}" for k in on)}, {
            "numTargetRowsUpdated": F.count_if(F.col("_action") == "update"),
            "numTargetRowsDeleted": F.lit(0).cast("bigint"),
            "numTargetRowsInserted": F.count_if(F.col("_action") == "insert"),
        }, helpers=("_action",))

    def optimize_zorder(self, cols: Sequence[str], committed_at: dt.datetime, rows_per_file: int | None = None) -> int:
        """OPTIMIZE ... ZORDER BY (cols): same rows, rewritten along the Z-curve of ``cols``."""
        from .layout import ROWS_PER_FILE, zorder

        before = self.read()
        removed = len(before.inputFiles())
        laid_out = zorder(before, cols, rows_per_file or ROWS_PER_FILE)
        return self.commit(laid_out, "OPTIMIZE", committed_at, {"zOrderBy": ",".join(cols)},
                           {"numRemovedFiles": F.lit(removed).cast("bigint")},
                           helpers=[c for c in laid_out.columns if c not in before.columns])

    def restore(self, version: int, committed_at: dt.datetime) -> int:
        return self.commit(self.read(version), "RESTORE", committed_at, {"version": str(version)})

    def last_version_where(self, operation_not: str) -> int:
        """max(version) among commits whose operation differs from ``operation_not`` (one tiny aggregate)."""
        return self.history().filter(F.col("operation") != operation_not).agg(F.max("version")).first()[0]


def expired_versions(history: DataFrame, as_of: dt.datetime, retain_hours: int) -> DataFrame:
    """Versions a VACUUM RETAIN n HOURS would let go: older than the limit and superseded.

    The current (latest) version is never expired, however old. The latest
    version number is one tiny aggregate read by the driver.
    """
    latest = history.agg(F.max("version")).first()[0]
    limit = ntz(as_of) - F.expr(f"INTERVAL {int(retain_hours)} HOURS")
    return history.filter((F.col("timestamp") < limit) & (F.col("version") < F.lit(latest)))
