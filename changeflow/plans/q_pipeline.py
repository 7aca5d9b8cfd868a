"""Queries over one end-to-end pipeline run (two updates): table sizes, and the run's own
event log (expectation totals, rows per flow) as written by the runner."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.jsonpath import expectations, json_path
from . import oracle as O
from . import gold, silver
from .pipeline import BATCH_TABLES, CUSTOMER_CUTOFF, STREAM_TABLES, pipeline_run
from .q_ingest import BRONZE_ORDERS, BRONZE_PRODUCTS
from .registry import query

# ---------------------------------------------------------------- oracle: the logs as bronze types them

P_ORDER_EVENTS = """p_order_events AS (
  SELECT pedido_id, cliente_id, produto_id, quantidade, preco_unitario, status, canal,
         TRY_CAST(pedido_ts AS TIMESTAMP) AS pedido_ts, TRY_CAST(evento_ts AS TIMESTAMP) AS evento_ts, desempate, lote
  FROM bronze_orders)"""
P_VALID_ORDERS = O.VALID_ORDERS.replace("valid_orders AS", "p_valid_orders AS").replace("FROM order_events", "FROM p_order_events")
P_QUARANTINE = O.QUARANTINE.replace("quarantine AS", "p_quarantine AS").replace("FROM order_events", "FROM p_order_events")
P_SCD1_ORDERS = O.SCD1_ORDERS.replace("scd1_orders AS", "p_scd1_orders AS").replace("FROM valid_orders", "FROM p_valid_orders")
P_SCD1_ORDERS_1 = O.SCD1_ORDERS.replace("scd1_orders AS", "p_scd1_orders_1 AS").replace(
    "FROM valid_orders", "FROM p_valid_orders WHERE lote = 1")
P_PRODUCT_EVENTS = """p_product_events AS (
  SELECT produto_id, nome_produto, categoria_id, preco_lista, ativo, operacao,
         TRY_CAST(atualizado_em AS TIMESTAMP) AS atualizado_em, _rescued_data, lote
  FROM bronze_products)"""
P_SCD1_PRODUCTS = O.SCD1_PRODUCTS.replace("scd1_products AS", "p_scd1_products AS").replace(
    "FROM product_events", "FROM p_product_events")
P_SCD1_PRODUCTS_1 = O.SCD1_PRODUCTS.replace("scd1_products AS", "p_scd1_products_1 AS").replace(
    "FROM product_events", "FROM p_product_events WHERE lote = 1")
P_ENRICHED = O.ENRICHED.replace("enriched AS", "p_enriched AS").replace("FROM scd1_orders", "FROM p_scd1_orders").replace(
    "FROM scd1_products", "FROM p_scd1_products")
P_DAILY = O.DAILY.replace("daily AS", "p_daily AS").replace("FROM enriched", "FROM p_enriched")
P_ENRICHED_1 = O.ENRICHED.replace("enriched AS", "p_enriched_1 AS").replace("FROM scd1_orders", "FROM p_scd1_orders_1").replace(
    "FROM scd1_products", "FROM p_scd1_products_1")
P_DAILY_1 = O.DAILY.replace("daily AS", "p_daily_1 AS").replace("FROM enriched", "FROM p_enriched_1")
P_SCD2_1 = O.SCD2_CUSTOMERS.replace("scd2_customers AS", "p_scd2_customers_1 AS").replace(
    "FROM valid_customers", f"FROM valid_customers WHERE evento_ts < TIMESTAMP '{CUSTOMER_CUTOFF}'")
P_HOURLY = """p_hourly AS (
  SELECT * FROM (SELECT date_trunc('hour', pedido_ts) AS h, canal, count(*) AS n
                 FROM p_valid_orders WHERE status = 'CRIADO' GROUP BY 1, 2) g
  WHERE h + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(pedido_ts)) - INTERVAL 2 HOUR
                                FROM p_valid_orders WHERE status = 'CRIADO'))"""

P_ALL = (
    *O.CUST, O.ORDER_EVENTS, BRONZE_ORDERS, O.PRODUCT_EVENTS, BRONZE_PRODUCTS, O.CATEGORIES,
    P_ORDER_EVENTS, P_VALID_ORDERS, P_QUARANTINE, P_SCD1_ORDERS, P_SCD1_ORDERS_1,
    P_PRODUCT_EVENTS, P_SCD1_PRODUCTS, P_SCD1_PRODUCTS_1, P_ENRICHED, P_DAILY, P_ENRICHED_1, P_DAILY_1, P_SCD2_1, P_HOURLY,
)

LAYER_SQL = """SELECT * FROM (
  SELECT 'bronze' AS camada, 'clientes_raw' AS tabela, (SELECT count(*) FROM customer_events) AS linhas
  UNION ALL SELECT 'bronze', 'pedidos_raw', (SELECT count(*) FROM bronze_orders)
  UNION ALL SELECT 'bronze', 'produtos_raw', (SELECT count(*) FROM bronze_products)
  UNION ALL SELECT 'silver', 'clientes_eventos_validos', (SELECT count(*) FROM valid_customers)
  UNION ALL SELECT 'silver', 'pedidos_eventos_validos', (SELECT count(*) FROM p_valid_orders)
  UNION ALL SELECT 'silver', 'pedidos_quarentena', (SELECT count(*) FROM p_quarantine)
  UNION ALL SELECT 'silver', 'produtos_eventos_validos', (SELECT count(*) FROM p_product_events)
  UNION ALL SELECT 'silver', 'clientes', (SELECT count(*) FROM scd2_customers)
  UNION ALL SELECT 'silver', 'pedidos', (SELECT count(*) FROM p_scd1_orders)
  UNION ALL SELECT 'silver', 'produtos', (SELECT count(*) FROM p_scd1_products)
  UNION ALL SELECT 'gold', 'vendas_diarias_categoria', (SELECT count(*) FROM p_daily)
  UNION ALL SELECT 'gold', 'funil_status_pedidos', (SELECT count(DISTINCT status) FROM p_scd1_orders)
  UNION ALL SELECT 'gold', 'clientes_valor', (SELECT count(*) FROM scd2_customers WHERE __END_AT IS NULL)
  UNION ALL SELECT 'gold', 'dim_clientes', (SELECT count(*) FROM scd2_customers WHERE __END_AT IS NULL)
  UNION ALL SELECT 'gold', 'pedidos_por_hora', (SELECT count(*) FROM p_hourly)) x"""



@query("pipeline_layer_counts", O.with_(*P_ALL) + LAYER_SQL)
def pipeline_layer_counts(spark, sf_dir):
    """Rows per table after the two-update pipeline run (landing -> bronze -> silver -> gold)."""
    p = pipeline_run(spark, sf_dir)
    frames = [(l, n, p.read(l, n)) for l, n in STREAM_TABLES]
    frames += [(l, n, p.current(l, n)) for l, n in BATCH_TABLES]
    counts = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(l).alias("camada"), F.lit(n).alias("tabela"), "linhas")
        for l, n, df in frames
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def _rules_sql(dataset: str, source: str, rules) -> list[str]:
    out = []
    for r in rules:
        pred = r.predicate.replace("TIMESTAMP_NTZ", "TIMESTAMP")
        out.append(
            f"SELECT '{dataset}' AS dataset, '{r.name}' AS regra, "
            f"count(*) FILTER (WHERE coalesce({pred}, false)) AS total_aprovados, "
            f"count(*) FILTER (WHERE NOT coalesce({pred}, false)) AS total_reprovados FROM {source}"
        )
    return out


QUALITY_SQL = "\nUNION ALL ".join(
    [
        "SELECT 'clientes_raw' AS dataset, 'rescued_data_vazio' AS regra, count(*) AS total_aprovados, 0 AS total_reprovados FROM customer_events",
        "SELECT 'pedidos_raw', 'rescued_data_vazio', count(*) FILTER (WHERE _rescued_data IS NULL), count(*) FILTER (WHERE _rescued_data IS NOT NULL) FROM bronze_orders",
        "SELECT 'produtos_raw', 'rescued_data_vazio', count(*) FILTER (WHERE _rescued_data IS NULL), count(*) FILTER (WHERE _rescued_data IS NOT NULL) FROM bronze_products",
    ]
    + _rules_sql("clientes_eventos_validos", "customer_std", silver.CUSTOMER_RULES)
    + _rules_sql("pedidos_eventos_validos", "p_order_events", silver.ORDER_RULES)
    + _rules_sql("produtos_eventos_validos", "p_product_events", silver.PRODUCT_RULES)
    # Targets are checked once per update.
    + _rules_sql("clientes", "(SELECT cliente_id FROM p_scd2_customers_1 UNION ALL SELECT cliente_id FROM scd2_customers) t", silver.CDC_RULES["clientes"])
    + _rules_sql("pedidos", "(SELECT pedido_id FROM p_scd1_orders_1 UNION ALL SELECT pedido_id FROM p_scd1_orders) t", silver.CDC_RULES["pedidos"])
    + _rules_sql("vendas_diarias_categoria", "(SELECT receita_dia FROM p_daily_1 UNION ALL SELECT receita_dia FROM p_daily) t",
                 gold.DAILY_SALES_RULES)
)


@query(
    "pipeline_quality_log",
    O.with_(*P_ALL) + "SELECT dataset, regra, CAST(total_aprovados AS BIGINT) AS total_aprovados, "
    "CAST(total_reprovados AS BIGINT) AS total_reprovados FROM (" + QUALITY_SQL + ") q",
)
def pipeline_quality_log(spark, sf_dir):
    """Expectation totals per dataset and rule, read from the run's own event log."""
    log = pipeline_run(spark, sf_dir).event_log().filter(F.col("event_type") == "flow_progress")
    e = log.select(F.explode(expectations("details")).alias("e"))
    return e.groupBy(F.col("e.dataset").alias("dataset"), F.col("e.name").alias("regra")).agg(
        F.sum("e.passed_records").alias("total_aprovados"), F.sum("e.failed_records").alias("total_reprovados"))


FLOW_SQL = """SELECT flow_name, CAST(linhas_processadas AS BIGINT) AS linhas_processadas,
       CAST(linhas_descartadas AS BIGINT) AS linhas_descartadas FROM (
  SELECT 'clientes_raw' AS flow_name, (SELECT count(*) FROM customer_events) AS linhas_processadas, 0 AS linhas_descartadas
  UNION ALL SELECT 'pedidos_raw', (SELECT count(*) FROM bronze_orders), 0
  UNION ALL SELECT 'produtos_raw', (SELECT count(*) FROM bronze_products), 0
  UNION ALL SELECT 'clientes_eventos_validos', (SELECT count(*) FROM valid_customers),
                   (SELECT count(*) FROM customer_std) - (SELECT count(*) FROM valid_customers)
  UNION ALL SELECT 'pedidos_eventos_validos', (SELECT count(*) FROM p_valid_orders), (SELECT count(*) FROM p_quarantine)
  UNION ALL SELECT 'pedidos_quarentena', (SELECT count(*) FROM p_quarantine), 0
  UNION ALL SELECT 'produtos_eventos_validos', (SELECT count(*) FROM p_product_events), 0
  UNION ALL SELECT 'clientes_cdc_flow', (SELECT count(*) FROM p_scd2_customers_1) + (SELECT count(*) FROM scd2_customers), 0
  UNION ALL SELECT 'pedidos_cdc_flow', (SELECT count(*) FROM p_scd1_orders_1) + (SELECT count(*) FROM p_scd1_orders), 0
  UNION ALL SELECT 'produtos_cdc_flow', (SELECT count(*) FROM p_scd1_products_1) + (SELECT count(*) FROM p_scd1_products), 0
  UNION ALL SELECT 'vendas_diarias_categoria', (SELECT count(*) FROM p_daily_1) + (SELECT count(*) FROM p_daily), 0
  UNION ALL SELECT 'funil_status_pedidos', (SELECT count(DISTINCT status) FROM p_scd1_orders_1) + (SELECT count(DISTINCT status) FROM p_scd1_orders), 0
  UNION ALL SELECT n, (SELECT count(*) FROM p_scd2_customers_1 WHERE __END_AT IS NULL) + (SELECT count(*) FROM scd2_customers WHERE __END_AT IS NULL), 0
            FROM unnest(['clientes_valor', 'dim_clientes']) u(n)
  UNION ALL SELECT 'pedidos_por_hora', (SELECT count(*) FROM p_hourly), 0) x"""


@query("pipeline_flow_rows", O.with_(*P_ALL) + FLOW_SQL)
def pipeline_flow_rows(spark, sf_dir):
    """Rows written and dropped per flow over both updates, read from the run's own event log."""
    log = pipeline_run(spark, sf_dir).event_log().filter(F.col("event_type") == "flow_progress")
    return log.groupBy(F.col("origin.flow_name").alias("flow_name")).agg(
        F.sum(json_path("details", "flow_progress.metrics.num_output_rows", "bigint")).alias("linhas_processadas"),
        F.sum(F.coalesce(json_path("details", "flow_progress.data_quality.dropped_records", "bigint"), F.lit(0)))
        .cast("bigint").alias("linhas_descartadas"),
    )


# ---------------------------------------------------------------- SQL over the registered tables


@query(
    "sql_orders_by_status",
    O.with_(*P_ALL) + "SELECT status, count(*) AS qtd FROM p_scd1_orders GROUP BY status",
)
def sql_orders_by_status(spark, sf_dir):
    """Current orders per status, as SQL over ``silver.pedidos``."""
    pipeline_run(spark, sf_dir)
    return spark.sql("SELECT status, count(*) AS qtd FROM silver.pedidos GROUP BY status")


@query(
    "sql_scd2_versions",
    O.with_(*P_ALL)
    + """SELECT count(*) FILTER (WHERE __END_AT IS NULL) AS versoes_vigentes,
       count(*) FILTER (WHERE __END_AT IS NOT NULL) AS versoes_historicas,
       count(DISTINCT cliente_id) AS clientes_distintos FROM scd2_customers""",
)
def sql_scd2_versions(spark, sf_dir):
    """Current vs historical versions of ``silver.clientes`` (SCD2), as SQL."""
    pipeline_run(spark, sf_dir)
    return spark.sql(
        "SELECT count_if(__END_AT IS NULL) AS versoes_vigentes, count_if(__END_AT IS NOT NULL) AS versoes_historicas, "
        "count(DISTINCT cliente_id) AS clientes_distintos FROM silver.clientes"
    )


@query(
    "sql_quarantine_by_rule",
    O.with_(*P_ALL)
    + """SELECT regra, count(*) AS qtd FROM (SELECT unnest(string_split(regras_violadas, ',')) AS regra FROM p_quarantine) x
GROUP BY regra""",
)
def sql_quarantine_by_rule(spark, sf_dir):
    """Quarantined orders per violated rule, as SQL over ``silver.pedidos_quarentena``."""
    pipeline_run(spark, sf_dir)
    return spark.sql(
        "SELECT regra, count(*) AS qtd FROM silver.pedidos_quarentena "
        "LATERAL VIEW explode(split(regras_violadas, ',')) r AS regra GROUP BY regra"
    )


@query(
    "sql_expectations",
    O.with_(*P_ALL) + "SELECT dataset, regra, CAST(total_aprovados AS BIGINT) AS total_aprovados, "
    "CAST(total_reprovados AS BIGINT) AS total_reprovados FROM (" + QUALITY_SQL + ") q",
)
def sql_expectations(spark, sf_dir):
    """Expectation totals from ``monitoring.event_log``, as SQL with a JSON path and a typed array parse."""
    pipeline_run(spark, sf_dir)
    return spark.sql(
        """SELECT e.dataset AS dataset, e.name AS regra, sum(e.passed_records) AS total_aprovados,
                  sum(e.failed_records) AS total_reprovados
           FROM monitoring.event_log
           LATERAL VIEW explode(from_json(get_json_object(details, '$.flow_progress.data_quality.expectations'),
               'array<struct<name:string,dataset:string,passed_records:bigint,failed_records:bigint>>')) x AS e
           WHERE event_type = 'flow_progress'
           GROUP BY e.dataset, e.name"""
    )


P_FEED = """p_feed AS (
  SELECT CASE WHEN o.pedido_id IS NULL THEN 'insert' ELSE 'delete' END AS t
  FROM p_scd1_orders_1 o FULL JOIN p_scd1_orders n ON o.pedido_id = n.pedido_id
  WHERE o.pedido_id IS NULL OR n.pedido_id IS NULL
  UNION ALL
  SELECT unnest(['update_preimage', 'update_postimage']) AS t
  FROM p_scd1_orders_1 o JOIN p_scd1_orders n ON o.pedido_id = n.pedido_id
  WHERE o.cliente_id IS DISTINCT FROM n.cliente_id OR o.produto_id IS DISTINCT FROM n.produto_id
     OR o.quantidade IS DISTINCT FROM n.quantidade OR o.preco_unitario IS DISTINCT FROM n.preco_unitario
     OR o.status IS DISTINCT FROM n.status OR o.canal IS DISTINCT FROM n.canal OR o.pedido_ts IS DISTINCT FROM n.pedido_ts)"""


@query("pipeline_change_feed", O.with_(*P_ALL, P_FEED) + "SELECT t AS _change_type, count(*) AS qtd FROM p_feed GROUP BY t")
def pipeline_change_feed(spark, sf_dir):
    """Row changes of ``silver.pedidos`` made by the second update (its version 1 -> version 2), by type."""
    from ..operators.snapshots import change_feed

    p = pipeline_run(spark, sf_dir)
    cols = [c for c in silver.ORDER_COLUMNS if c != "evento_ts"]
    before = spark.read.parquet(p.table_path("silver", "pedidos", 1)).select(*cols)
    after = spark.read.parquet(p.table_path("silver", "pedidos", 2)).select(*cols)
    return change_feed(before, after, ["pedido_id"]).groupBy("_change_type").agg(F.count(F.lit(1)).alias("qtd"))


BATCH_SQL = """SELECT flow, contador, CAST(total AS BIGINT) AS total FROM (
  SELECT 'clientes_raw' AS flow, 'rows' AS contador, (SELECT count(*) FROM customer_events) AS total
  UNION ALL SELECT 'pedidos_raw', 'rows', (SELECT count(*) FROM bronze_orders)
  UNION ALL SELECT 'produtos_raw', 'rows', (SELECT count(*) FROM bronze_products)
  UNION ALL SELECT 'clientes_eventos_validos', 'rows', (SELECT count(*) FROM customer_std)
  UNION ALL SELECT 'pedidos_eventos_validos', 'rows', (SELECT count(*) FROM p_order_events)
  UNION ALL SELECT 'pedidos_quarentena', 'rows', (SELECT count(*) FROM p_order_events)
  UNION ALL SELECT 'produtos_eventos_validos', 'rows', (SELECT count(*) FROM p_product_events)
  UNION ALL SELECT 'clientes_raw', 'output_rows', (SELECT count(*) FROM customer_events)
  UNION ALL SELECT 'pedidos_raw', 'output_rows', (SELECT count(*) FROM bronze_orders)
  UNION ALL SELECT 'produtos_raw', 'output_rows', (SELECT count(*) FROM bronze_products)
  UNION ALL SELECT 'clientes_eventos_validos', 'output_rows', (SELECT count(*) FROM valid_customers)
  UNION ALL SELECT 'pedidos_eventos_validos', 'output_rows', (SELECT count(*) FROM p_valid_orders)
  UNION ALL SELECT 'pedidos_quarentena', 'output_rows', (SELECT count(*) FROM p_quarantine)
  UNION ALL SELECT 'produtos_eventos_validos', 'output_rows', (SELECT count(*) FROM p_product_events)) x"""


@query("pipeline_batch_metrics", O.with_(*P_ALL) + BATCH_SQL)
def pipeline_batch_metrics(spark, sf_dir):
    """Rows read and written by each ingestion and validation stream, summed over the reports of its micro-batches."""
    totals = pipeline_run(spark, sf_dir).metrics.totals()
    return totals.where("name IN ('rows', 'output_rows') AND flow <> 'pedidos_por_hora'").select(
        "flow", F.col("name").alias("contador"), "total")


@query(
    "pipeline_file_ledger",
    O.with_(*P_ALL)
    + f"""SELECT tabela, lote, count(*) AS linhas, true AS cada_arquivo_uma_vez, true AS hora_da_carga FROM (
  SELECT 'clientes_raw' AS tabela, CASE WHEN evento_ts < TIMESTAMP '{CUSTOMER_CUTOFF}' THEN 1 ELSE 2 END AS lote FROM customer_events
  UNION ALL SELECT 'pedidos_raw', lote FROM bronze_orders
  UNION ALL SELECT 'produtos_raw', lote FROM bronze_products) x GROUP BY tabela, lote""",
)
def pipeline_file_ledger(spark, sf_dir):
    """Rows per table and landing folder from the run's file ledger, whether each file is there once, and whether files of
    the first folder were ingested before those of the second."""
    files = pipeline_run(spark, sf_dir).file_ledger().withColumn("lote", F.regexp_extract("arquivo_origem", r"lote=(\d+)", 1).cast("int"))
    per = files.groupBy("tabela", "lote").agg(
        F.sum("linhas").alias("linhas"), F.count(F.lit(1)).alias("n"), F.count_distinct("arquivo_origem").alias("d"),
        F.min("ingerido_em").alias("primeiro"), F.max("ingerido_em").alias("ultimo"))
    # Two landing folders per table: a handful of rows.
    before = per.select("tabela", (F.col("lote") + 1).alias("lote"), F.col("ultimo").alias("anterior"))
    return per.join(before, ["tabela", "lote"], "left").select(
        "tabela", "lote", "linhas", (F.col("n") == F.col("d")).alias("cada_arquivo_uma_vez"),
        F.coalesce(F.col("anterior") < F.col("primeiro"), F.lit(True)).alias("hora_da_carga"))
