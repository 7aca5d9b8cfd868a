"""Gold queries: enriched orders and the business datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import gold, silver
from . import oracle as O
from .registry import query, r2


def _daily(spark, sf_dir, guard=True):
    enriched = gold.orders_enriched(spark, sf_dir, gold.DAILY_ORDER_COLUMNS)
    return gold.daily_category_sales(enriched, guard=guard)


ENRICHED_OUT_SQL = """SELECT pedido_id, cliente_id, produto_id, quantidade, preco_unitario, round(receita_bruta, 2) AS receita_bruta,
       status, canal, pedido_ts, nome_produto, categoria_id, nome_categoria, CAST(margem_alvo AS DOUBLE) AS margem_alvo
FROM enriched"""


@query("orders_enriched", O.with_(*O.GOLD) + ENRICHED_OUT_SQL)
def orders_enriched(spark, sf_dir):
    e = gold.orders_enriched(spark, sf_dir)
    return e.select(
        "pedido_id", "cliente_id", "produto_id", "quantidade", "preco_unitario", r2("receita_bruta").alias("receita_bruta"),
        "status", "canal", "pedido_ts", "nome_produto", "categoria_id", "nome_categoria",
        F.col("margem_alvo").cast("double").alias("margem_alvo"),
    )


DAILY_OUT_SQL = """SELECT data_pedido, categoria_id, nome_categoria, qtd_pedidos, CAST(qtd_itens AS BIGINT) AS qtd_itens,
       round(receita_dia, 2) AS receita_dia, round(CAST(margem_alvo_media AS DOUBLE), 6) AS margem_alvo_media
FROM daily"""


def _daily_out(d):
    return d.select(
        "data_pedido", "categoria_id", "nome_categoria", "qtd_pedidos", F.col("qtd_itens").cast("bigint").alias("qtd_itens"),
        r2("receita_dia").alias("receita_dia"),
        F.round(F.col("margem_alvo_media").cast("double"), 6).alias("margem_alvo_media"),
    )


@query("daily_category_sales", O.with_(*O.GOLD, O.DAILY) + DAILY_OUT_SQL)
def daily_category_sales(spark, sf_dir):
    return _daily_out(_daily(spark, sf_dir))


@query("fail_guard", O.with_(*O.GOLD, O.DAILY) + DAILY_OUT_SQL)
def fail_guard_query(spark, sf_dir):
    """The guarded daily dataset; on clean input it equals the unguarded result (abort is a pytest)."""
    return _daily_out(_daily(spark, sf_dir, guard=True))


@query(
    "status_funnel",
    O.with_(*O.GOLD)
    + "SELECT status, count(*) AS qtd_pedidos, round(sum(receita_bruta), 2) AS receita_total FROM enriched GROUP BY ALL",
)
def status_funnel(spark, sf_dir):
    f = gold.status_funnel(silver.orders(spark, sf_dir, gold.FUNNEL_ORDER_COLUMNS))
    return f.select("status", "qtd_pedidos", r2("receita_total").alias("receita_total"))


@query(
    "customer_value",
    O.with_(*O.CUST, *O.GOLD)
    + """, per_customer AS (
  SELECT cliente_id, count(*) AS n, sum(quantidade * preco_unitario) AS spent, max(pedido_ts) AS latest
  FROM scd1_orders GROUP BY cliente_id)
SELECT CAST(c.cliente_id AS BIGINT) AS cliente_id, c.cidade, c.uf, coalesce(p.n, 0) AS qtd_pedidos,
       round(p.spent, 2) AS receita_total, p.latest AS ultima_compra
FROM (SELECT * FROM scd2_customers WHERE __END_AT IS NULL) c LEFT JOIN per_customer p USING (cliente_id)""",
)
def customer_value(spark, sf_dir):
    v = gold.customer_value(silver.current_customers(spark, sf_dir), silver.orders(spark, sf_dir, gold.VALUE_ORDER_COLUMNS))
    return v.select("cliente_id", "cidade", "uf", "qtd_pedidos", r2("receita_total").alias("receita_total"), "ultima_compra")


@query(
    "category_revenue",
    O.with_(*O.GOLD, O.DAILY)
    + """SELECT nome_categoria, round(sum(receita_dia), 2) AS receita_total, CAST(sum(qtd_pedidos) AS BIGINT) AS pedidos
FROM daily GROUP BY nome_categoria""",
)
def category_revenue(spark, sf_dir):
    c = gold.category_revenue(_daily(spark, sf_dir))
    return c.select("nome_categoria", r2("receita_total").alias("receita_total"), F.col("pedidos").cast("bigint").alias("pedidos"))
