"""Quality queries: valid rows, quarantine, per-rule totals, conservation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.quality import rule_counts
from ..sources import fixtures as fx
from . import oracle as O
from . import silver
from .registry import query

ORDER_OUT = ("pedido_id", "cliente_id", "produto_id", "quantidade", "preco_unitario", "status", "canal", "pedido_ts", "evento_ts")


@query("valid_orders", O.with_(O.ORDER_EVENTS, O.VALID_ORDERS) + f"SELECT {', '.join(ORDER_OUT)} FROM valid_orders")
def valid_orders(spark, sf_dir):
    return silver.valid_order_events(spark, sf_dir).select(*ORDER_OUT)


CUST_OUT = ("cliente_id", "nome", "email", "cpf", "telefone", "cidade", "uf", "data_nascimento", "operacao", "evento_seq", "evento_ts")


@query(
    "clean_customer_events",
    O.with_(O.CUSTOMER_EVENTS, O.CUSTOMER_STD, O.VALID_CUSTOMERS) + f"SELECT {', '.join(CUST_OUT)} FROM valid_customers",
)
def clean_customer_events(spark, sf_dir):
    return silver.valid_customer_events(spark, sf_dir).select(*CUST_OUT)


@query("quarantine", O.with_(O.ORDER_EVENTS, O.QUARANTINE) + "SELECT * FROM quarantine")
def quarantine(spark, sf_dir):
    _, q = silver.order_events_split(spark, sf_dir)
    return q.select(*ORDER_OUT, F.array_join("regras_violadas", ",").alias("regras_violadas"))


@query(
    "quarantine_by_rule",
    O.with_(O.ORDER_EVENTS, O.QUARANTINE)
    + """SELECT regra, count(*) AS qtd FROM (SELECT unnest(string_split(regras_violadas, ',')) AS regra FROM quarantine) x
GROUP BY regra""",
)
def quarantine_by_rule(spark, sf_dir):
    _, q = silver.order_events_split(spark, sf_dir)
    return (
        q.select(F.explode("regras_violadas").alias("regra"))
        .groupBy("regra")
        .agg(F.count(F.lit(1)).alias("qtd"))
    )


@query(
    "quality_balance",
    O.with_(O.ORDER_EVENTS, O.VALID_ORDERS, O.QUARANTINE)
    + """SELECT r.recebidos, v.validos, q.quarentena, r.recebidos = v.validos + q.quarentena AS balanceado
FROM (SELECT count(*) AS recebidos FROM order_events) r,
     (SELECT count(*) AS validos FROM valid_orders) v,
     (SELECT count(*) AS quarentena FROM quarantine) q""",
)
def quality_balance(spark, sf_dir):
    """received = valid + quarantined, in one pass over the log (two conditional counts)."""
    from ..operators.quality import valid_condition

    ev = silver.fx.order_events(spark, sf_dir)
    ok = valid_condition(silver.ORDER_RULES)
    return ev.agg(
        F.count(F.lit(1)).alias("recebidos"),
        F.count_if(ok).alias("validos"),
        F.count_if(~ok).alias("quarentena"),
    ).select(
        "recebidos", "validos", "quarentena",
        (F.col("recebidos") == F.col("validos") + F.col("quarentena")).alias("balanceado"),
    )


def _rule_rows_sql(dataset: str, source: str, rules) -> str:
    parts = []
    for r in rules:
        pred = r.predicate.replace("TIMESTAMP_NTZ", "TIMESTAMP")
        parts.append(
            f"SELECT '{dataset}' AS dataset, '{r.name}' AS regra, '{r.action}' AS acao, "
            f"count(*) FILTER (WHERE coalesce({pred}, false)) AS aprovados, "
            f"count(*) FILTER (WHERE NOT coalesce({pred}, false)) AS reprovados FROM {source}"
        )
    return "\nUNION ALL ".join(parts)


@query(
    "rule_pass_fail",
    O.with_(O.CUSTOMER_EVENTS, O.CUSTOMER_STD, O.ORDER_EVENTS, O.PRODUCT_EVENTS)
    + _rule_rows_sql("clientes_eventos_validos", "customer_std", silver.CUSTOMER_RULES)
    + "\nUNION ALL "
    + _rule_rows_sql("pedidos_eventos_validos", "order_events", silver.ORDER_RULES)
    + "\nUNION ALL "
    + _rule_rows_sql("produtos_eventos_validos", "product_events", silver.PRODUCT_RULES),
)
def rule_pass_fail(spark, sf_dir):
    return (
        rule_counts(silver.customer_events_std(spark, sf_dir), silver.CUSTOMER_RULES, "clientes_eventos_validos")
        .unionByName(rule_counts(fx.order_events(spark, sf_dir), silver.ORDER_RULES, "pedidos_eventos_validos"))
        .unionByName(rule_counts(fx.product_events(spark, sf_dir), silver.PRODUCT_RULES, "produtos_eventos_validos"))
    )
