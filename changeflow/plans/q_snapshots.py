"""Snapshot / maintenance queries: CTAS, aged UPDATE and DELETE, MERGE, history metrics,
accidental DELETE + RESTORE, time travel, retention, change feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.snapshots import SnapshotTable, change_feed, expired_versions
from ..session import materialize, work_dir
from . import oracle as O
from . import silver
from .registry import query, side_by_side
from .q_cdc import ORD_OUT, ORDER_BATCH_CUTOFF

# The run's clock: a fixed "now" for repeatable results, and one commit every two days before it.
AS_OF = dt.datetime(2001, 12, 31)
RETAIN_HOURS = 168


def commit_time(step: int, n_steps: int = 6) -> dt.datetime:
    return AS_OF - dt.timedelta(days=2 * (n_steps - 1 - step))


UPDATE_WHERE = "status = 'ENVIADO' AND pedido_ts < TIMESTAMP_NTZ '2001-12-31 00:00:00' - INTERVAL 30 DAYS"
DELETE_WHERE = "status = 'CANCELADO' AND pedido_ts < TIMESTAMP_NTZ '2001-12-31 00:00:00' - INTERVAL 365 DAYS"

STEPS = ("create", "update", "delete", "merge", "delete_all", "restore")


def run_maintenance(spark, sf_dir, upto: str = "restore") -> SnapshotTable:
    """The audit-snapshot flow, one written version per statement, stopping after ``upto``."""
    table = SnapshotTable(spark, work_dir(spark, "orders_snapshot"))
    # silver.pedidos is a written table: CTAS and MERGE both read it instead of recomputing the SCD1 apply.
    orders = materialize(silver.orders(spark, sf_dir), work_dir(spark, "silver_pedidos"))
    for i, step in enumerate(STEPS):
        at = commit_time(i)
        if step == "create":
            table.create(orders, at)
        elif step == "update":
            table.update({"status": "'ENTREGUE'"}, UPDATE_WHERE, at)
        elif step == "delete":
            table.delete(DELETE_WHERE, at)
        elif step == "merge":
            table.merge(orders, ["pedido_id"], at, matched_condition="t.status != s.status",
                        update_set={"status": "s.status"})
        elif step == "delete_all":
            table.delete(None, at)
        elif step == "restore":
            table.restore(table.last_version_where("DELETE"), at)
        if step == upto:
            break
    return table


# ------------------------------------------------------------------------------ oracle CTEs

V1 = """v1 AS (SELECT pedido_id, cliente_id, produto_id, quantidade, preco_unitario,
  CASE WHEN coalesce(status = 'ENVIADO' AND pedido_ts < TIMESTAMP '2001-12-31' - INTERVAL 30 DAY, false)
       THEN 'ENTREGUE' ELSE status END AS status, canal, pedido_ts,
  coalesce(status = 'ENVIADO' AND pedido_ts < TIMESTAMP '2001-12-31' - INTERVAL 30 DAY, false) AS touched
  FROM scd1_orders)"""
V2 = """v2 AS (SELECT *, coalesce(status = 'CANCELADO' AND pedido_ts < TIMESTAMP '2001-12-31' - INTERVAL 365 DAY, false) AS gone FROM v1)"""
V3 = """v3 AS (
  SELECT t.pedido_id, t.cliente_id, t.produto_id, t.quantidade, t.preco_unitario,
         CASE WHEN s.pedido_id IS NOT NULL AND t.status != s.status THEN s.status ELSE t.status END AS status,
         t.canal, t.pedido_ts,
         coalesce(s.pedido_id IS NOT NULL AND t.status != s.status, false) AS upd, false AS ins
  FROM (SELECT * FROM v2 WHERE NOT gone) t LEFT JOIN scd1_orders s ON t.pedido_id = s.pedido_id
  UNION ALL
  SELECT s.*, false AS upd, true AS ins FROM scd1_orders s
  WHERE NOT EXISTS (SELECT 1 FROM v2 t WHERE NOT t.gone AND t.pedido_id = s.pedido_id))"""
SNAP = O.ORD + (V1, V2, V3)
COLS = ", ".join(ORD_OUT)


def _rows(table: SnapshotTable, v: int):
    return table.read(v).select(*ORD_OUT)


@query("snapshot_create", O.with_(*O.ORD) + "SELECT * FROM scd1_orders")
def snapshot_create(spark, sf_dir):
    return _rows(run_maintenance(spark, sf_dir, "create"), 0)


@query("aged_status_update", O.with_(*SNAP) + f"SELECT {COLS} FROM v1")
def aged_status_update(spark, sf_dir):
    return _rows(run_maintenance(spark, sf_dir, "update"), 1)


@query("aged_delete", O.with_(*SNAP) + f"SELECT {COLS} FROM v2 WHERE NOT gone")
def aged_delete(spark, sf_dir):
    return _rows(run_maintenance(spark, sf_dir, "delete"), 2)


@query("merge_upsert", O.with_(*SNAP) + f"SELECT {COLS} FROM v3")
def merge_upsert_query(spark, sf_dir):
    return _rows(run_maintenance(spark, sf_dir, "merge"), 3)


def _ts(step: int) -> str:
    return f"TIMESTAMP '{commit_time(step):%Y-%m-%d %H:%M:%S}'"


COMMITS_SQL = f"""commits AS (
  SELECT 0 AS version, {_ts(0)} AS ts, 'CREATE TABLE AS SELECT' AS operation, NULL::BIGINT AS upd, NULL::BIGINT AS del, NULL::BIGINT AS ins, (SELECT count(*) FROM scd1_orders) AS out_rows
  UNION ALL SELECT 1, {_ts(1)}, 'UPDATE', (SELECT count(*) FILTER (WHERE touched) FROM v1), 0, 0, (SELECT count(*) FROM v1)
  UNION ALL SELECT 2, {_ts(2)}, 'DELETE', 0, (SELECT count(*) FILTER (WHERE gone) FROM v2), 0, (SELECT count(*) FILTER (WHERE NOT gone) FROM v2)
  UNION ALL SELECT 3, {_ts(3)}, 'MERGE', (SELECT count(*) FILTER (WHERE upd) FROM v3), 0, (SELECT count(*) FILTER (WHERE ins) FROM v3), (SELECT count(*) FROM v3)
  UNION ALL SELECT 4, {_ts(4)}, 'DELETE', 0, (SELECT count(*) FROM v3), 0, 0
  UNION ALL SELECT 5, {_ts(5)}, 'RESTORE', NULL, NULL, NULL, (SELECT count(*) FROM v3))"""


@query(
    "commit_metrics",
    O.with_(*SNAP, COMMITS_SQL)
    + """SELECT CAST(version AS BIGINT) AS version, ts AS "timestamp", operation,
       CAST(upd AS BIGINT) AS linhas_atualizadas, CAST(del AS BIGINT) AS linhas_deletadas,
       CAST(ins AS BIGINT) AS linhas_inseridas, CAST(out_rows AS BIGINT) AS linhas_saida
FROM commits""",
)
def commit_metrics(spark, sf_dir):
    h = run_maintenance(spark, sf_dir).history()
    m = F.col("operationMetrics")
    return h.select(
        "version", "timestamp", "operation",
        m["numTargetRowsUpdated"].cast("bigint").alias("linhas_atualizadas"),
        m["numTargetRowsDeleted"].cast("bigint").alias("linhas_deletadas"),
        m["numTargetRowsInserted"].cast("bigint").alias("linhas_inseridas"),
        m["numOutputRows"].cast("bigint").alias("linhas_saida"),
    )


@query(
    "restore_after_delete",
    O.with_(*SNAP)
    + """SELECT CAST(0 AS BIGINT) AS linhas_apos_delete_acidental, CAST(3 AS BIGINT) AS versao_restaurada,
       (SELECT count(*) FROM v3) AS linhas_apos_restore""",
)
def restore_after_delete(spark, sf_dir):
    t = run_maintenance(spark, sf_dir)
    restored = t.last_version_where("DELETE")  # the RESTORE itself (v5); its source version is a parameter
    h = t.history()
    src = h.filter(F.col("version") == restored).select(F.col("operationParameters")["version"].cast("bigint").alias("versao_restaurada"))
    return side_by_side(
        t.read(restored - 1).agg(F.count(F.lit(1)).alias("linhas_apos_delete_acidental")),
        src,
        t.read(restored).agg(F.count(F.lit(1)).alias("linhas_apos_restore")),
    )


@query(
    "version_count_compare",
    O.with_(*SNAP) + "SELECT (SELECT count(*) FROM scd1_orders) AS linhas_versao_0, (SELECT count(*) FROM v3) AS linhas_atual",
)
def version_count_compare(spark, sf_dir):
    t = run_maintenance(spark, sf_dir)
    return side_by_side(
        t.read(0).agg(F.count(F.lit(1)).alias("linhas_versao_0")),
        t.read().agg(F.count(F.lit(1)).alias("linhas_atual")),
    )


@query(
    "expired_versions",
    O.with_(*SNAP, COMMITS_SQL)
    + f"""SELECT CAST(version AS BIGINT) AS version, operation, ts AS "timestamp" FROM commits
WHERE ts < TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}' - INTERVAL {RETAIN_HOURS} HOUR AND version < (SELECT max(version) FROM commits)""",
)
def expired_versions_query(spark, sf_dir):
    h = run_maintenance(spark, sf_dir).history()
    return expired_versions(h, AS_OF, RETAIN_HOURS).select("version", "operation", "timestamp")


FEED_SQL = f"""old_orders AS (
  SELECT {COLS} FROM (SELECT *, row_number() OVER (PARTITION BY pedido_id ORDER BY evento_ts DESC NULLS LAST,
               preco_unitario DESC NULLS LAST, quantidade DESC NULLS LAST, produto_id DESC NULLS LAST,
               desempate DESC NULLS LAST, status DESC NULLS LAST) AS rn
        FROM valid_orders WHERE evento_ts < TIMESTAMP '{ORDER_BATCH_CUTOFF}') x WHERE rn = 1),
feed AS (
  SELECT CASE WHEN o.pedido_id IS NULL THEN 'insert' WHEN n.pedido_id IS NULL THEN 'delete' END AS t, 1 AS w
  FROM old_orders o FULL JOIN scd1_orders n ON o.pedido_id = n.pedido_id
  WHERE o.pedido_id IS NULL OR n.pedido_id IS NULL
  UNION ALL
  SELECT unnest(['update_preimage', 'update_postimage']) AS t, 1 AS w
  FROM old_orders o JOIN scd1_orders n ON o.pedido_id = n.pedido_id
  WHERE o.cliente_id IS DISTINCT FROM n.cliente_id OR o.produto_id IS DISTINCT FROM n.produto_id
     OR o.quantidade IS DISTINCT FROM n.quantidade OR o.preco_unitario IS DISTINCT FROM n.preco_unitario
     OR o.status IS DISTINCT FROM n.status OR o.canal IS DISTINCT FROM n.canal OR o.pedido_ts IS DISTINCT FROM n.pedido_ts)"""


@query(
    "change_feed_counts",
    O.with_(*O.ORD, FEED_SQL) + "SELECT t AS _change_type, count(*) AS qtd FROM feed GROUP BY t",
)
def change_feed_counts(spark, sf_dir):
    """Changes to the SCD1 order table made by the second batch, counted by type."""
    log = silver.valid_order_events(spark, sf_dir)
    second = F.col("evento_ts") >= F.expr(f"TIMESTAMP_NTZ '{ORDER_BATCH_CUTOFF}'")
    # Only keys the second batch touched can change: both versions are rebuilt for those keys alone.
    touched = log.filter(second).select("pedido_id").distinct()
    log = log.join(touched, "pedido_id", "left_semi")
    before = silver.orders_scd1(log.filter(~second))
    after = silver.orders_scd1(log)
    feed = change_feed(before.select(*ORD_OUT), after.select(*ORD_OUT), ["pedido_id"])
    return feed.groupBy("_change_type").agg(F.count(F.lit(1)).alias("qtd"))
