"""Observability queries over the run event log, the lineage feed and the layer tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.jsonpath import expectations, json_path
from ..functions.timeutil import ntz_micros
from ..sources import fixtures as fx
from . import gold, silver
from . import oracle as O
from .registry import query

def _flow_progress():
    return F.col("event_type") == "flow_progress"


@query(
    "flow_rows",
    O.with_(O.RUN_LOG)
    + """SELECT flow_name,
       CAST(sum(CAST(json_extract_string(details, '$.flow_progress.metrics.num_output_rows') AS BIGINT)) AS BIGINT) AS linhas_processadas,
       CAST(sum(coalesce(CAST(json_extract_string(details, '$.flow_progress.data_quality.dropped_records') AS BIGINT), 0)) AS BIGINT) AS linhas_descartadas
FROM run_log WHERE event_type = 'flow_progress' GROUP BY ALL""",
)
def flow_rows(spark, sf_dir):
    log = fx.run_log(spark, sf_dir).filter(_flow_progress())
    return log.groupBy(F.col("origin.flow_name").alias("flow_name")).agg(
        F.sum(json_path("details", "flow_progress.metrics.num_output_rows", "bigint")).alias("linhas_processadas"),
        F.sum(F.coalesce(json_path("details", "flow_progress.data_quality.dropped_records", "bigint"), F.lit(0)))
        .cast("bigint").alias("linhas_descartadas"),
    )


@query(
    "rule_metrics_from_log",
    O.with_(O.RUN_LOG)
    + """SELECT e.dataset AS dataset, e.name AS regra, CAST(sum(e.passed_records) AS BIGINT) AS total_aprovados, CAST(sum(e.failed_records) AS BIGINT) AS total_reprovados
FROM (SELECT unnest(from_json(json_extract(details, '$.flow_progress.data_quality.expectations'),
             '[{"name":"VARCHAR","dataset":"VARCHAR","passed_records":"BIGINT","failed_records":"BIGINT"}]')) AS e
      FROM run_log
      WHERE event_type = 'flow_progress' AND json_extract(details, '$.flow_progress.data_quality.expectations') IS NOT NULL) x
GROUP BY ALL""",
)
def rule_metrics_from_log(spark, sf_dir):
    log = fx.run_log(spark, sf_dir).filter(_flow_progress())
    e = log.select(F.explode(expectations("details")).alias("e"))
    return e.groupBy(F.col("e.dataset").alias("dataset"), F.col("e.name").alias("regra")).agg(
        F.sum("e.passed_records").alias("total_aprovados"),
        F.sum("e.failed_records").alias("total_reprovados"),
    )


@query(
    "update_durations",
    O.with_(O.RUN_LOG)
    + """SELECT update_id, min("timestamp") AS inicio, max("timestamp") AS fim,
       CAST(date_diff('microsecond', min("timestamp"), max("timestamp")) AS DOUBLE) / 1000000.0 AS duracao_segundos
FROM run_log WHERE event_type = 'update_progress' GROUP BY update_id""",
)
def update_durations(spark, sf_dir):
    log = fx.run_log(spark, sf_dir).filter(F.col("event_type") == "update_progress")
    g = log.groupBy(F.col("origin.update_id").alias("update_id")).agg(
        F.min("timestamp").alias("inicio"), F.max("timestamp").alias("fim")
    )
    return g.select(
        "update_id", "inicio", "fim",
        ((ntz_micros("fim") - ntz_micros("inicio")) / F.lit(1_000_000.0)).alias("duracao_segundos"),
    )


@query(
    "flow_status_feed",
    O.with_(O.RUN_LOG)
    + """SELECT "timestamp", update_id, flow_name AS flow, json_extract_string(details, '$.flow_progress.status') AS status
FROM run_log
WHERE event_type = 'flow_progress' AND json_extract_string(details, '$.flow_progress.status') IN ('COMPLETED', 'FAILED')
ORDER BY "timestamp" DESC, message DESC LIMIT 40""",
)
def flow_status_feed(spark, sf_dir):
    """The latest 40 terminal flow statuses (a top-k report: the limit is the feature)."""
    log = fx.run_log(spark, sf_dir).filter(_flow_progress())
    status = json_path("details", "flow_progress.status")
    return (
        log.filter(status.isin("COMPLETED", "FAILED"))
        .orderBy(F.col("timestamp").desc(), F.col("message").desc())
        .limit(40)
        .select("timestamp", F.col("origin.update_id").alias("update_id"), F.col("origin.flow_name").alias("flow"),
                status.alias("status"))
    )


@query(
    "event_feed",
    O.with_(O.RUN_LOG)
    + """SELECT "timestamp", event_type, message, update_id FROM run_log
WHERE event_type IN ('planning_information', 'cluster_resources')""",
)
def event_feed(spark, sf_dir):
    """Planning and cluster-resource events, newest first."""
    log = fx.run_log(spark, sf_dir).filter(F.col("event_type").isin("planning_information", "cluster_resources"))
    return log.select("timestamp", "event_type", "message", F.col("origin.update_id").alias("update_id")).orderBy(
        F.col("timestamp").desc()
    )


@query(
    "lineage_latest",
    O.with_(O.LINEAGE)
    + """SELECT source_table_schema, source_table_name, target_table_schema, target_table_name, max(event_time) AS ultimo_evento
FROM lineage WHERE target_table_catalog = 'lakehouse' AND source_table_catalog = 'lakehouse'
GROUP BY ALL""",
)
def lineage_latest(spark, sf_dir):
    feed = fx.lineage_feed(spark, sf_dir).filter(
        (F.col("target_table_catalog") == "lakehouse") & (F.col("source_table_catalog") == "lakehouse")
    )
    return feed.groupBy("source_table_schema", "source_table_name", "target_table_schema", "target_table_name").agg(
        F.max("event_time").alias("ultimo_evento")
    )


FEED_COLUMNS = ("source_table_catalog", "source_table_schema", "source_table_name",
                "target_table_catalog", "target_table_schema", "target_table_name", "event_time")
FEED_ROWS = 200


@query(
    "lineage_feed",
    O.with_(O.LINEAGE)
    + f"""SELECT {', '.join(FEED_COLUMNS)} FROM lineage
WHERE source_table_catalog = 'lakehouse' OR target_table_catalog = 'lakehouse'
ORDER BY event_time DESC, {', '.join(FEED_COLUMNS[:-1])} LIMIT {FEED_ROWS}""",
)
def lineage_feed(spark, sf_dir):
    """The newest lineage events that read or write the catalog, as they came (top-k, ties by name)."""
    feed = fx.lineage_feed(spark, sf_dir).filter(
        (F.col("target_table_catalog") == "lakehouse") | (F.col("source_table_catalog") == "lakehouse"))
    return feed.select(*FEED_COLUMNS).orderBy(F.col("event_time").desc(), *FEED_COLUMNS[:-1]).limit(FEED_ROWS)


LAYER_SQL = """SELECT * FROM (
  SELECT 'bronze' AS camada, 'clientes_raw' AS tabela, (SELECT count(*) FROM customer_events) AS linhas
  UNION ALL SELECT 'bronze', 'pedidos_raw', (SELECT count(*) FROM order_events)
  UNION ALL SELECT 'bronze', 'produtos_raw', (SELECT count(*) FROM product_events)
  UNION ALL SELECT 'silver', 'clientes_eventos_validos', (SELECT count(*) FROM valid_customers)
  UNION ALL SELECT 'silver', 'pedidos_eventos_validos', (SELECT count(*) FROM valid_orders)
  UNION ALL SELECT 'silver', 'pedidos_quarentena', (SELECT count(*) FROM quarantine)
  UNION ALL SELECT 'silver', 'clientes', (SELECT count(*) FROM scd2_customers)
  UNION ALL SELECT 'silver', 'pedidos', (SELECT count(*) FROM scd1_orders)
  UNION ALL SELECT 'silver', 'produtos', (SELECT count(*) FROM scd1_products)
  UNION ALL SELECT 'gold', 'vendas_diarias_categoria', (SELECT count(*) FROM daily)
  UNION ALL SELECT 'gold', 'funil_status_pedidos', (SELECT count(DISTINCT status) FROM scd1_orders)
  UNION ALL SELECT 'gold', 'clientes_valor', (SELECT count(*) FROM scd2_customers WHERE __END_AT IS NULL)
  UNION ALL SELECT 'gold', 'dim_clientes', (SELECT count(*) FROM scd2_customers WHERE __END_AT IS NULL)) x"""


@query(
    "layer_row_counts",
    O.with_(*O.CUST, *O.GOLD, O.QUARANTINE, O.DAILY) + LAYER_SQL,
)
def layer_row_counts(spark, sf_dir):
    """Rows per table, bronze to gold, sorted by layer.

    Tables that share an input are counted in one pass with conditional counts
    (raw = valid + quarantine for orders; raw and valid for customers; history
    and current for the SCD2 table), so each input is scanned once.
    """
    from ..operators.quality import valid_condition

    def counts(df, **named):
        return df.agg(*[F.count_if(c).alias(n) for n, c in named.items()])

    raw_o = fx.order_events(spark, sf_dir)
    ok_o = valid_condition(silver.ORDER_RULES)
    o = counts(raw_o, pedidos_raw=F.lit(True), pedidos_eventos_validos=ok_o, pedidos_quarentena=~ok_o)
    raw_c = silver.customer_events_std(spark, sf_dir)
    c = counts(raw_c, clientes_raw=F.lit(True), clientes_eventos_validos=valid_condition(silver.CUSTOMER_RULES))
    cust = silver.customers(spark, sf_dir)
    h = counts(cust, clientes=F.lit(True), clientes_valor=F.col("__END_AT").isNull(), dim_clientes=F.col("__END_AT").isNull())
    orders = silver.orders(spark, sf_dir)
    so = counts(orders, pedidos=F.lit(True))
    funnel = orders.agg(F.countDistinct("status").alias("funil_status_pedidos"))
    p = counts(fx.product_events(spark, sf_dir), produtos_raw=F.lit(True))
    sp = counts(silver.products(spark, sf_dir), produtos=F.lit(True))
    d = counts(gold.daily_category_sales(gold.orders_enriched(spark, sf_dir)), vendas_diarias_categoria=F.lit(True))
    layer_of = {
        "clientes_raw": "bronze", "pedidos_raw": "bronze", "produtos_raw": "bronze",
        "clientes_eventos_validos": "silver", "pedidos_eventos_validos": "silver", "pedidos_quarentena": "silver",
        "clientes": "silver", "pedidos": "silver", "produtos": "silver",
        "vendas_diarias_categoria": "gold", "funil_status_pedidos": "gold", "clientes_valor": "gold", "dim_clientes": "gold",
    }
    rows = []
    for one in (o, c, h, so, funnel, p, sp, d):
        pairs = ", ".join(f"'{layer_of[n]}', '{n}', CAST({n} AS BIGINT)" for n in one.columns)
        rows.append(one.selectExpr(f"stack({len(one.columns)}, {pairs}) AS (camada, tabela, linhas)"))
    u = reduce(lambda a, b: a.unionByName(b), rows)
    order = F.when(F.col("camada") == "bronze", 1).when(F.col("camada") == "silver", 2).otherwise(3)
    return u.orderBy(order, "tabela")
