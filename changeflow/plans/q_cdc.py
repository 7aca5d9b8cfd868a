"""Change-data queries: SCD2 history and checks, SCD1 tables, incremental apply."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.cdc import apply_incremental
from ..sources import fixtures as fx
from . import oracle as O
from . import silver
from .registry import query, side_by_side

SCD2_OUT = ("cliente_id", "nome", "email", "cpf", "telefone", "cidade", "uf", "data_nascimento", "evento_ts", "__START_AT", "__END_AT")

# Batch boundary of the two-batch incremental runs (events before it arrive first).
BATCH_CUTOFF = "2024-01-16 00:00:00"
ORDER_BATCH_CUTOFF = "1998-06-01 00:00:00"


@query("scd2_history", O.with_(*O.CUST) + "SELECT * FROM scd2_customers")
def scd2_history(spark, sf_dir):
    return silver.customers(spark, sf_dir).select(*SCD2_OUT)


@query(
    "current_customers",
    O.with_(*O.CUST) + "SELECT * FROM scd2_customers WHERE __END_AT IS NULL",
)
def current_customers(spark, sf_dir):
    return silver.current_customers(spark, sf_dir).select(*SCD2_OUT)


@query(
    "scd2_version_counts",
    O.with_(*O.CUST)
    + """SELECT count(*) FILTER (WHERE __END_AT IS NULL) AS versoes_vigentes,
       count(*) FILTER (WHERE __END_AT IS NOT NULL) AS versoes_historicas,
       count(DISTINCT cliente_id) AS clientes_distintos
FROM scd2_customers""",
)
def scd2_version_counts(spark, sf_dir):
    c = silver.customers(spark, sf_dir)
    return c.agg(
        F.count_if(F.col("__END_AT").isNull()).alias("versoes_vigentes"),
        F.count_if(F.col("__END_AT").isNotNull()).alias("versoes_historicas"),
        F.countDistinct("cliente_id").alias("clientes_distintos"),
    )


@query(
    "scd2_multi_version",
    O.with_(*O.CUST)
    + """SELECT cliente_id, email, telefone, __START_AT, __END_AT FROM scd2_customers
WHERE cliente_id IN (SELECT cliente_id FROM scd2_customers GROUP BY cliente_id HAVING count(*) > 1)""",
)
def scd2_multi_version(spark, sf_dir):
    c = silver.customers(spark, sf_dir)
    multi = c.groupBy("cliente_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("cliente_id")
    return c.join(multi, "cliente_id", "left_semi").select("cliente_id", "email", "telefone", "__START_AT", "__END_AT")


@query("scd2_incremental", O.with_(*O.CUST) + "SELECT * FROM scd2_customers")
def scd2_incremental(spark, sf_dir):
    """Batch 1 applied in full, batch 2 applied incrementally (only touched keys rebuilt)."""
    log = silver.valid_customer_events(spark, sf_dir)
    arrived_late = F.coalesce(F.col("evento_ts") >= F.expr(f"TIMESTAMP_NTZ '{BATCH_CUTOFF}'"), F.lit(False))
    batch1, batch2 = log.filter(~arrived_late), log.filter(arrived_late)
    target = silver.customers_scd2(batch1)
    out = apply_incremental(target, log, batch2, ["cliente_id"], silver.customers_scd2)
    return out.select(*SCD2_OUT)


ORD_OUT = ("pedido_id", "cliente_id", "produto_id", "quantidade", "preco_unitario", "status", "canal", "pedido_ts")


@query("scd1_orders", O.with_(*O.ORD) + "SELECT * FROM scd1_orders")
def scd1_orders(spark, sf_dir):
    return silver.orders(spark, sf_dir).select(*ORD_OUT)


@query("scd1_products", O.with_(*O.PROD) + "SELECT * FROM scd1_products")
def scd1_products(spark, sf_dir):
    return silver.products(spark, sf_dir).select(
        "produto_id", "nome_produto", "categoria_id", "preco_lista", "ativo", "atualizado_em"
    )


@query(
    "scd1_orders_incremental",
    O.with_(*O.ORD) + "SELECT * FROM scd1_orders",
)
def scd1_orders_incremental(spark, sf_dir):
    """SCD1 orders with the second half of the log applied incrementally; equals the full apply."""
    log = silver.valid_order_events(spark, sf_dir)
    late = F.col("evento_ts") >= F.expr(f"TIMESTAMP_NTZ '{ORDER_BATCH_CUTOFF}'")
    target = silver.orders_scd1(log.filter(~late))
    return apply_incremental(target, log, log.filter(late), ["pedido_id"], silver.orders_scd1).select(*ORD_OUT)


@query(
    "scd1_uniqueness",
    O.with_(*O.ORD) + "SELECT count(*) AS linhas, count(DISTINCT pedido_id) AS ids FROM scd1_orders",
)
def scd1_uniqueness(spark, sf_dir):
    return silver.orders(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("linhas"), F.countDistinct("pedido_id").alias("ids")
    )


@query(
    "orders_by_status",
    O.with_(*O.ORD) + "SELECT status, count(*) AS qtd FROM scd1_orders GROUP BY status",
)
def orders_by_status(spark, sf_dir):
    return silver.orders(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("qtd"))


@query(
    "deleted_key_gap",
    O.with_(*O.PROD)
    + """SELECT (SELECT count(DISTINCT produto_id) FROM product_events) AS produtos_na_bronze,
       (SELECT count(*) FROM scd1_products) AS produtos_na_silver""",
)
def deleted_key_gap(spark, sf_dir):
    bronze = fx.product_events(spark, sf_dir).agg(F.countDistinct("produto_id").alias("produtos_na_bronze"))
    silver_n = silver.products(spark, sf_dir).agg(F.count(F.lit(1)).alias("produtos_na_silver"))
    return side_by_side(bronze, silver_n)


REFERENCE_TARGET = """target AS (
  SELECT DISTINCT categoria_id, 'Categoria ' || CAST(categoria_id AS VARCHAR) AS nome_categoria,
         CAST(NULL AS DECIMAL(5,2)) AS margem_alvo
  FROM product_events)"""

REFERENCE_MERGED = """SELECT coalesce(t.categoria_id, s.categoria_id) AS categoria_id,
       CASE WHEN s.categoria_id IS NOT NULL THEN s.nome_categoria ELSE t.nome_categoria END AS nome_categoria,
       CAST(CASE WHEN s.categoria_id IS NOT NULL THEN s.margem_alvo ELSE t.margem_alvo END AS DOUBLE) AS margem_alvo
FROM target t FULL JOIN categories s ON t.categoria_id = s.categoria_id"""


@query("reference_categories", O.with_(O.PRODUCT_EVENTS, O.CATEGORIES, REFERENCE_TARGET) + REFERENCE_MERGED)
def reference_categories(spark, sf_dir):
    """MERGE the reference category rows into the categories the products use.

    Target: one auto-registered row per category id seen in the product log;
    WHEN MATCHED UPDATE SET name, margin; WHEN NOT MATCHED INSERT. The CHECK on
    the margin (NULL or within 0..1) is a FAIL rule.
    """
    from ..operators.cdc import merge_upsert
    from ..operators.quality import FAIL, Rule, fail_guard

    target = (
        fx.product_events(spark, sf_dir).select("categoria_id").distinct()
        .select(
            "categoria_id",
            F.concat(F.lit("Categoria "), F.col("categoria_id").cast("string")).alias("nome_categoria"),
            F.lit(None).cast("decimal(5,2)").alias("margem_alvo"),
        )
    )
    merged = merge_upsert(
        target, fx.categories(spark), ["categoria_id"],
        update_set={"nome_categoria": "s.nome_categoria", "margem_alvo": "s.margem_alvo"},
    )
    check = Rule("margem_valida", "margem_alvo IS NULL OR (margem_alvo >= 0 AND margem_alvo <= 1)", FAIL)
    return fail_guard(merged, [check]).select(
        "categoria_id", "nome_categoria", F.col("margem_alvo").cast("double").alias("margem_alvo")
    )
