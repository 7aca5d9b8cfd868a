"""Silver layer: standardise, validate and apply the three change logs.

customers: trim/case fixes, try-cast dates, DROP rules, SCD type 2 by evento_seq
orders:    DROP rules + quarantine with reasons, SCD type 1 by evento_ts
products:  FAIL rule on the key, SCD type 1 by atualizado_em with deletes
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cdc import apply_scd1, apply_scd2, current_scd2
from ..operators.quality import DROP, FAIL, WARN, Rule, fail_guard, split_valid
from ..sources import fixtures as fx

# Expectations of the customer event log (name, predicate, action).
CUSTOMER_RULES = (
    Rule("id_valido", "cliente_id IS NOT NULL", DROP),
    Rule("sequencia_valida", "evento_seq IS NOT NULL", DROP),
    Rule("operacao_valida", "operacao IN ('INSERT', 'UPDATE', 'DELETE')", DROP),
    Rule("email_valido", "operacao = 'DELETE' OR (email IS NOT NULL AND email LIKE '%@%')", DROP),
    Rule("cpf_valido", "operacao = 'DELETE' OR (cpf IS NOT NULL AND length(cpf) = 11)", DROP),
    Rule("uf_valida", "uf IS NOT NULL", WARN),
)

# Expectations of the order event log, with their quarantine reasons.
ORDER_RULES = (
    Rule("pedido_id_valido", "pedido_id IS NOT NULL", DROP, "pedido_id_nulo"),
    Rule("cliente_id_valido", "cliente_id IS NOT NULL", DROP, "cliente_id_nulo"),
    Rule("quantidade_valida", "coalesce(quantidade, 0) > 0", DROP, "quantidade_invalida"),
    Rule("preco_valido", "coalesce(preco_unitario, -1) > 0", DROP, "preco_invalido"),
    Rule("status_valido", "status IN ('CRIADO', 'PAGO', 'ENVIADO', 'ENTREGUE', 'CANCELADO')", DROP, "status_invalido"),
    Rule(
        "data_coerente",
        "coalesce(pedido_ts, TIMESTAMP_NTZ '1900-01-01 00:00:00') <= coalesce(evento_ts, TIMESTAMP_NTZ '9999-12-31 00:00:00')",
        DROP,
        "data_futura",
    ),
    Rule("sequencia_valida", "evento_ts IS NOT NULL", DROP, "sequencia_nula"),
    Rule("canal_valido", "canal IS NOT NULL", WARN),
)

# Expectations of the product event log.
PRODUCT_RULES = (Rule("produto_id_obrigatorio", "produto_id IS NOT NULL", FAIL),)

# Expectations of the CDC targets.
CDC_RULES = {
    "clientes": (Rule("id_final_valido", "cliente_id IS NOT NULL"),),
    "pedidos": (Rule("id_final_valido", "pedido_id IS NOT NULL"),),
}

# Tie-break of equal order sequences (all descending with the sequence).
ORDER_TIEBREAK = ("preco_unitario", "quantidade", "produto_id", "desempate", "status")

# Tie-breaks of equal customer and product sequences, so that results never depend on arrival.
CUSTOMER_TIEBREAK = ("evento_ts", "operacao", "nome", "email", "cpf", "telefone", "cidade", "uf", "data_nascimento")
PRODUCT_TIEBREAK = ("operacao", "preco_lista", "ativo", "nome_produto", "categoria_id")

ORDER_COLUMNS = (
    "pedido_id", "cliente_id", "produto_id", "quantidade", "preco_unitario", "status", "canal", "pedido_ts", "evento_ts",
)


def standardize_customers(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """trim / lower / upper fixes and try-cast of the birth date; ``keep`` passes extra columns through."""
    return raw.select(
        *keep,
        "cliente_id",
        F.trim("nome").alias("nome"),
        F.lower(F.trim("email")).alias("email"),
        "cpf",
        "telefone",
        "cidade",
        F.upper("uf").alias("uf"),
        F.expr("try_cast(data_nascimento AS DATE)").alias("data_nascimento"),
        "operacao",
        "evento_seq",
        "evento_ts",
    )


def customer_events_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_customers(fx.customer_events(spark, sf_dir))


def valid_customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid(customer_events_std(spark, sf_dir), CUSTOMER_RULES)
    return valid


def customers_scd2(valid_log: DataFrame, hot_rows: int | None = None) -> DataFrame:
    kw = {} if hot_rows is None else {"hot_rows": hot_rows}
    return apply_scd2(
        valid_log, ["cliente_id"], "evento_seq",
        delete_when="operacao = 'DELETE'", except_cols=("operacao", "evento_seq"), tiebreak=CUSTOMER_TIEBREAK, **kw,
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_scd2(valid_customer_events(spark, sf_dir))


def current_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_scd2(
        valid_customer_events(spark, sf_dir), ["cliente_id"], "evento_seq",
        delete_when="operacao = 'DELETE'", except_cols=("operacao", "evento_seq"), tiebreak=CUSTOMER_TIEBREAK,
    )


def order_events_split(spark: SparkSession, sf_dir: str):
    """(valid, quarantine) order events; the quarantine carries ``regras_violadas``."""
    return split_valid(fx.order_events(spark, sf_dir), ORDER_RULES)


def valid_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events_split(spark, sf_dir)[0]


def orders_scd1(valid_log: DataFrame, columns=None) -> DataFrame:
    return apply_scd1(
        valid_log, ["pedido_id"], "evento_ts", except_cols=("evento_ts", "desempate"), tiebreak=ORDER_TIEBREAK,
        columns=columns,
    )


def orders(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """Current orders (SCD1); ``columns`` narrows the carried row for consumers reading a few columns."""
    return orders_scd1(valid_order_events(spark, sf_dir), columns)


def valid_product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fail_guard(fx.product_events(spark, sf_dir), PRODUCT_RULES)


def products_scd1(valid_log: DataFrame, columns=None) -> DataFrame:
    return apply_scd1(
        valid_log, ["produto_id"], "atualizado_em", delete_when="operacao = 'DELETE'", except_cols=("operacao",),
        tiebreak=PRODUCT_TIEBREAK, columns=columns,
    )


def products(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return products_scd1(valid_product_events(spark, sf_dir), columns)
