"""Ingestion queries: JSON and CSV landing files streamed into bronze, with rescue and provenance.

The landing files are written from the derived change logs (every row), in two
batches (``lote=1``, ``lote=2``); the stream runs after each batch on one
checkpoint, so the second run reads only the second batch.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..session import work_dir
from ..sources import fixtures as fx
from ..sources import ingest as ing
from ..streaming.runner import StreamTarget, read_sink, run_available_now
from . import oracle as O
from .registry import query
from .q_cdc import ORDER_BATCH_CUTOFF

PRODUCT_FIRST_BATCH = "1995-01-01 00:00:00"

ORDER_BRONZE_COLS = (
    "pedido_id", "cliente_id", "produto_id", "quantidade", "preco_unitario", "status", "canal", "pedido_ts",
    "evento_ts", "desempate",
)
PRODUCT_BRONZE_COLS = ("produto_id", "nome_produto", "categoria_id", "preco_lista", "ativo", "operacao", "atualizado_em")


def ingest_orders(spark, sf_dir):
    """Land order events as JSON in two batches and stream each batch into bronze."""
    root = work_dir(spark, "landing_pedidos")
    lines = ing.order_landing_lines(fx.order_events(spark, sf_dir))
    first = F.coalesce(F.col("evento_ts") < F.lit(ORDER_BATCH_CUTOFF), F.lit(False))
    target = StreamTarget.create(spark, "bronze_pedidos")
    schema = ing.schema_with_hints(ing.ORDER_HINTS)
    for lote, cond in ((1, first), (2, ~first)):
        ing.write_batch_json(lines.filter(cond), os.path.join(root, f"lote={lote}"))
        run_available_now(ing.json_stream(spark, os.path.join(root, "*"), schema), target)
    return read_sink(spark, target).withColumn("lote", ing.batch_of())


def ingest_products(spark, sf_dir):
    """Land product events as headered CSV in two batches and stream each into bronze."""
    root = work_dir(spark, "landing_produtos")
    ev = fx.product_events(spark, sf_dir)
    first = F.col("atualizado_em") == F.expr(f"TIMESTAMP_NTZ '{PRODUCT_FIRST_BATCH}'")
    target = StreamTarget.create(spark, "bronze_produtos")
    schema = ing.schema_with_hints(ing.PRODUCT_HINTS)
    for lote, cond in ((1, first), (2, ~first)):
        ing.write_batch_csv(ing.product_landing(ev.filter(cond)), os.path.join(root, f"lote={lote}"))
        run_available_now(ing.csv_stream(spark, os.path.join(root, "*"), schema), target)
    return read_sink(spark, target).withColumn("lote", ing.batch_of())


BRONZE_ORDERS = f"""bronze_orders AS (
  SELECT CASE WHEN c THEN NULL ELSE pedido_id END AS pedido_id,
         CASE WHEN c THEN NULL ELSE cliente_id END AS cliente_id,
         CASE WHEN c THEN NULL ELSE produto_id END AS produto_id,
         CASE WHEN c OR w THEN NULL ELSE quantidade END AS quantidade,
         CASE WHEN c THEN NULL ELSE preco_unitario END AS preco_unitario,
         CASE WHEN c THEN NULL ELSE status END AS status,
         CASE WHEN c THEN NULL ELSE canal END AS canal,
         CASE WHEN c THEN NULL ELSE strftime(pedido_ts, '%Y-%m-%d %H:%M:%S') END AS pedido_ts,
         CASE WHEN c THEN NULL ELSE strftime(evento_ts, '%Y-%m-%d %H:%M:%S') END AS evento_ts,
         CASE WHEN c THEN NULL ELSE desempate END AS desempate,
         CASE WHEN c THEN '#corrupt line ' || CAST(pedido_id AS VARCHAR)
              WHEN w AND u THEN '{{"quantidade":"' || CAST(quantidade AS VARCHAR) || ' un","cupom":"PROMO' || CAST(pedido_id AS VARCHAR) || '"}}'
              WHEN w THEN '{{"quantidade":"' || CAST(quantidade AS VARCHAR) || ' un"}}'
              WHEN u THEN '{{"cupom":"PROMO' || CAST(pedido_id AS VARCHAR) || '"}}' END AS _rescued_data,
         CASE WHEN evento_ts < TIMESTAMP '{ORDER_BATCH_CUTOFF}' THEN 1 ELSE 2 END AS lote
  FROM (SELECT *, coalesce(pedido_id % 101 = 7, false) AS c, coalesce(pedido_id % 97 = 3, false) AS w,
               coalesce(pedido_id % 89 = 5, false) AS u FROM order_events) x)"""

BRONZE_PRODUCTS = f"""bronze_products AS (
  SELECT produto_id, nome_produto, categoria_id,
         CASE WHEN s THEN NULL ELSE preco_lista END AS preco_lista, ativo, operacao,
         strftime(atualizado_em, '%Y-%m-%d %H:%M:%S') AS atualizado_em,
         CASE WHEN s THEN '{{"preco_lista":"R$ 1.00"}}' END AS _rescued_data,
         CASE WHEN atualizado_em = TIMESTAMP '{PRODUCT_FIRST_BATCH}' THEN 1 ELSE 2 END AS lote
  FROM (SELECT *, atualizado_em = TIMESTAMP '1995-01-15 00:00:00' AS s FROM product_events) x)"""


@query(
    "ingest_json_stream",
    O.with_(O.ORDER_EVENTS, BRONZE_ORDERS) + "SELECT * FROM bronze_orders",
)
def ingest_json_stream(spark, sf_dir):
    return ingest_orders(spark, sf_dir).select(*ORDER_BRONZE_COLS, ing.RESCUED, "lote")


@query(
    "ingest_csv_stream",
    O.with_(O.PRODUCT_EVENTS, BRONZE_PRODUCTS) + "SELECT * FROM bronze_products",
)
def ingest_csv_stream(spark, sf_dir):
    return ingest_products(spark, sf_dir).select(*PRODUCT_BRONZE_COLS, ing.RESCUED, "lote")


def ingest_products_by_header(spark, sf_dir):
    """Products whose second delivery names its columns in another order, lacks ``ativo`` and brings ``fornecedor``."""
    root = work_dir(spark, "landing_produtos_cabecalho")
    ev = fx.product_events(spark, sf_dir)
    first = F.col("atualizado_em") == F.expr(f"TIMESTAMP_NTZ '{PRODUCT_FIRST_BATCH}'")
    target = StreamTarget.create(spark, "bronze_produtos_cabecalho")
    schema = ing.schema_with_hints(ing.PRODUCT_HINTS)
    rows = ing.product_landing(ev.filter(first))
    late = ing.product_landing(ev.filter(~first)).withColumn("fornecedor", F.concat(F.lit("F, "), "produto_id"))
    late = late.select("atualizado_em", "operacao", "fornecedor", "preco_lista", "categoria_id", "nome_produto", "produto_id")
    for lote, df in ((1, rows), (2, late)):
        ing.write_batch_csv(df, os.path.join(root, f"lote={lote}"))
        ing.run_csv_by_header(spark, os.path.join(root, "*"), schema, target)
    return read_sink(spark, target).withColumn("lote", ing.batch_of())


@query(
    "ingest_csv_headers",
    O.with_(O.PRODUCT_EVENTS, BRONZE_PRODUCTS)
    + """SELECT produto_id, nome_produto, categoria_id, preco_lista, CASE WHEN lote = 1 THEN ativo END AS ativo, operacao, atualizado_em, lote,
       CASE WHEN lote = 1 THEN _rescued_data
            WHEN _rescued_data IS NULL THEN '{"fornecedor":"F, ' || produto_id || '"}'
            ELSE replace(_rescued_data, '}', ',"fornecedor":"F, ' || produto_id || '"}') END AS _rescued_data
FROM bronze_products""",
)
def ingest_csv_headers(spark, sf_dir):
    return ingest_products_by_header(spark, sf_dir).select(*PRODUCT_BRONZE_COLS, ing.RESCUED, "lote")


@query(
    "rescued_data",
    O.with_(O.ORDER_EVENTS, BRONZE_ORDERS, O.PRODUCT_EVENTS, BRONZE_PRODUCTS)
    + """SELECT 'pedidos_raw' AS tabela, count(*) FILTER (WHERE _rescued_data IS NOT NULL) AS com_rescued_data FROM bronze_orders
UNION ALL SELECT 'produtos_raw', count(*) FILTER (WHERE _rescued_data IS NOT NULL) FROM bronze_products""",
)
def rescued_data(spark, sf_dir):
    o = ingest_orders(spark, sf_dir).agg(F.count_if(F.col(ing.RESCUED).isNotNull()).alias("com_rescued_data"))
    p = ingest_products(spark, sf_dir).agg(F.count_if(F.col(ing.RESCUED).isNotNull()).alias("com_rescued_data"))
    return o.select(F.lit("pedidos_raw").alias("tabela"), "com_rescued_data").unionByName(
        p.select(F.lit("produtos_raw").alias("tabela"), "com_rescued_data")
    )


@query(
    "rows_per_source_file",
    O.with_(O.ORDER_EVENTS, BRONZE_ORDERS, O.PRODUCT_EVENTS, BRONZE_PRODUCTS)
    + """SELECT 'pedidos_raw' AS tabela, lote, count(*) AS linhas FROM bronze_orders GROUP BY lote
UNION ALL SELECT 'produtos_raw', lote, count(*) FROM bronze_products GROUP BY lote""",
)
def rows_per_source_file(spark, sf_dir):
    """Rows per landing batch folder (each file is read exactly once across the two runs)."""
    o = ingest_orders(spark, sf_dir).groupBy("lote").agg(F.count(F.lit(1)).alias("linhas"))
    p = ingest_products(spark, sf_dir).groupBy("lote").agg(F.count(F.lit(1)).alias("linhas"))
    return o.select(F.lit("pedidos_raw").alias("tabela"), "lote", "linhas").unionByName(
        p.select(F.lit("produtos_raw").alias("tabela"), "lote", "linhas")
    )
