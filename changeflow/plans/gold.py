"""Gold layer: enriched orders and the business datasets.

Join strategy: the order fact (SCD1, one row per order) is left-joined to the
product dimension with a plain join — the product table grows with the data,
so AQE picks broadcast from *measured* shuffle sizes and falls back to a
sort-merge join (with skew splitting) beyond the threshold. The category
reference has a fixed number of rows and is broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import FAIL, Rule, fail_guard
from ..sources import fixtures as fx
from . import silver

DAILY_SALES_RULES = (Rule("receita_nao_negativa", "receita_dia >= 0", FAIL),)
DATASET_RULES = {"vendas_diarias_categoria": DAILY_SALES_RULES}


def enrich_orders(orders: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    p = products.select("produto_id", "nome_produto", "categoria_id")
    c = F.broadcast(categories.select("categoria_id", "nome_categoria", "margem_alvo"))
    wanted = ("pedido_id", "cliente_id", "produto_id", "quantidade", "preco_unitario", "receita_bruta",
              "status", "canal", "pedido_ts", "nome_produto", "categoria_id", "nome_categoria", "margem_alvo")
    joined = (
        orders.join(p, "produto_id", "left")
        .join(c, "categoria_id", "left")
        .withColumn("receita_bruta", F.col("quantidade") * F.col("preco_unitario"))
    )
    return joined.select(*[x for x in wanted if x in joined.columns])


def orders_enriched(spark: SparkSession, sf_dir: str, order_columns=None) -> DataFrame:
    orders = silver.orders(spark, sf_dir, order_columns)
    products = silver.products(spark, sf_dir, ("nome_produto", "categoria_id"))
    return enrich_orders(orders, products, fx.categories(spark))


# Order columns each gold dataset reads (the SCD1 payload carries only these).
DAILY_ORDER_COLUMNS = ("produto_id", "quantidade", "preco_unitario", "status", "pedido_ts")
FUNNEL_ORDER_COLUMNS = ("quantidade", "preco_unitario", "status")
VALUE_ORDER_COLUMNS = ("cliente_id", "quantidade", "preco_unitario", "pedido_ts")


def daily_category_sales(enriched: DataFrame, guard: bool = True) -> DataFrame:
    """Revenue and orders per day and category, cancelled orders excluded; FAIL if revenue < 0.

    Orders are unique per pedido_id after SCD1, so count(pedido_id) equals
    count(DISTINCT pedido_id) without the distinct-aggregate expansion.
    """
    out = (
        enriched.filter(F.col("status") != "CANCELADO")
        .groupBy(F.to_date("pedido_ts").alias("data_pedido"), "categoria_id", "nome_categoria")
        .agg(
            F.count("pedido_id").alias("qtd_pedidos"),
            F.sum("quantidade").alias("qtd_itens"),
            F.sum("receita_bruta").alias("receita_dia"),
            F.avg("margem_alvo").alias("margem_alvo_media"),
        )
    )
    return fail_guard(out, DAILY_SALES_RULES) if guard else out


def status_funnel(orders: DataFrame) -> DataFrame:
    """Orders and revenue per current status (cancelled included).

    Reads the order fact directly: the left join to products keeps one row per
    order and no product column is used, so the join is dropped from the plan.
    """
    return orders.groupBy("status").agg(
        F.count(F.lit(1)).alias("qtd_pedidos"),
        F.sum(F.col("quantidade") * F.col("preco_unitario")).alias("receita_total"),
    )


def customer_value(current_customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Per current customer: orders, revenue, last purchase (no PII columns).

    Orders are pre-aggregated per customer (map-side partial aggregation) before
    the join, so a customer holding a third of all orders costs one row per map
    task in the shuffle, not a third of the fact.
    """
    per_customer = orders.groupBy("cliente_id").agg(
        F.count("pedido_id").alias("_n"),
        F.sum(F.col("quantidade") * F.col("preco_unitario")).alias("receita_total"),
        F.max("pedido_ts").alias("ultima_compra"),
    )
    cli = current_customers.select(F.col("cliente_id").cast("bigint").alias("cliente_id"), "cidade", "uf")
    return cli.join(per_customer, "cliente_id", "left").select(
        "cliente_id", "cidade", "uf",
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("qtd_pedidos"),
        "receita_total", "ultima_compra",
    )


def category_revenue(daily: DataFrame) -> DataFrame:
    return daily.groupBy("nome_categoria").agg(
        F.sum("receita_dia").alias("receita_total"),
        F.sum("qtd_pedidos").alias("pedidos"),
    )


def masked_dimension_source(current_customers: DataFrame) -> DataFrame:
    """The current customer dimension (9 typed columns) before masking."""
    return current_customers.select(
        F.col("cliente_id").cast("int").alias("cliente_id"),
        "nome", "email", "cpf", "telefone", "cidade", "uf", "data_nascimento",
        F.col("__START_AT").cast("bigint").alias("vigente_desde_evento_seq"),
    )
