"""Change logs and small reference tables derived from the given tables.

The medallion pipeline consumes three change logs (customers, orders, products),
a category reference table, a region access policy, a run event log and a
lineage feed. All logs are derived here, lazily, from the parquet tables, so
their size grows with the scale factor. The derivation rules are the ones in
FIXTURES.md; the DuckDB oracle (plans/oracle.py) states them again in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Reference category table (id, name, target margin).
CATEGORIES = [
    (1, "Economy", "0.18"),
    (2, "Medium", "0.35"),
    (3, "Promo", "0.28"),
    (4, "Small", "0.30"),
    (5, "Large", "0.22"),
]

# Region access policy (group, region code).
REGION_POLICY = [
    ("analysts", "SP"),
    ("analysts", "RJ"),
    ("analysts", "MG"),
    ("other", "BA"),
]

# Sales channels.
CHANNELS = ("site", "app", "marketplace", "loja_fisica")


def _ntz(literal: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{literal}'")


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD2 change log of customers, one row per event in ``events``."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    # nation holds the 25 nations of the schema: a fixed, proven-small dimension.
    n = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = e.join(n, n["n_nationkey"] == (e["user_id"] % 25), "left")
    eid, uid = F.col("event_id"), F.col("user_id")
    return j.select(
        uid.cast("int").alias("cliente_id"),
        F.concat(F.lit("  Client "), _s(uid), F.lit(" ")).alias("nome"),
        F.when(eid % 33 == 0, F.concat(F.lit("USER"), _s(eid)))
        .otherwise(F.concat(F.lit("User"), _s(eid), F.lit("@Example.com"))).alias("email"),
        F.when(eid % 37 == 0, F.lit("12345"))
        .otherwise(F.lpad(_s((uid * 7919 + 11) % 99999999999), 11, "0")).alias("cpf"),
        F.concat(F.lit("11"), F.lpad(_s((uid * 104729 + eid) % 1000000000), 9, "0")).alias("telefone"),
        F.col("n_name").alias("cidade"),
        F.when(uid % 6 == 0, "sp").when(uid % 6 == 1, "rj").when(uid % 6 == 2, "mg")
        .when(uid % 6 == 3, "ba").when(uid % 6 == 4, "pe").alias("uf"),
        F.when(eid % 41 == 0, F.lit("not-a-date")).otherwise(F.lit("1980-05-17")).alias("data_nascimento"),
        F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE")
        .when(F.col("event_type") == "purchase", "UPSERT").otherwise("UPDATE").alias("operacao"),
        F.when(eid % 50 == 0, (eid - 200) * 10 + 5).otherwise(eid * 10).alias("evento_seq"),
        F.col("ts").alias("evento_ts"),
    )


def order_events(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """SCD1 change log of orders: one event per line item, with injected faults.

    ``lineitem`` may be given as a stream (stream-static join with ``orders``).
    """
    li = (read_table(spark, sf_dir, "lineitem") if lineitem is None else lineitem).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    x = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner").withColumn(
        "f", (F.col("l_orderkey") + F.col("l_partkey")) % 150
    )
    f = F.col("f")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    prio = F.col("o_orderpriority")
    ship = F.col("l_shipdate")
    return x.select(
        F.when(f == 0, F.lit(None)).otherwise(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pedido_id"),
        F.when(f == 1, F.lit(None)).otherwise(F.col("o_custkey")).alias("cliente_id"),
        F.col("l_partkey").alias("produto_id"),
        F.when(f == 2, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int").alias("quantidade"),
        F.when(f == 3, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("preco_unitario"),
        F.when(f == 4, "PERDIDO").when(f == 6, F.lit(None))
        .when((rf == "A") & (ls == "F"), "ENTREGUE").when(rf == "A", "ENVIADO")
        .when((rf == "N") & (ls == "F"), "PAGO").when(rf == "N", "CRIADO")
        .otherwise("CANCELADO").alias("status"),
        F.when(f == 7, F.lit(None)).when(prio == "1-URGENT", "app").when(prio == "2-HIGH", "site")
        .when(prio == "3-MEDIUM", "marketplace").otherwise("loja_fisica").alias("canal"),
        F.when(f == 5, ship + F.expr("INTERVAL 1 DAY")).otherwise(ship - F.expr("INTERVAL 2 DAYS")).alias("pedido_ts"),
        ship.alias("evento_ts"),
        F.col("l_suppkey").alias("desempate"),
    )


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD1 change log of products with deletes and a stale update older than the delete."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    key = F.col("p_partkey")
    ops = F.array(F.lit("INSERT"), F.lit("UPDATE"), F.lit("DELETE"), F.lit("STALE"))
    x = p.select("*", F.explode(ops).alias("op")).filter(
        (F.col("op") == "INSERT")
        | ((F.col("op") == "UPDATE") & (key % 8 == 0))
        | (F.col("op").isin("DELETE", "STALE") & (key % 40 == 1))
    )
    op, ptype = F.col("op"), F.col("p_type")
    return x.select(
        key.alias("produto_id"),
        F.col("p_name").alias("nome_produto"),
        F.when(ptype == "ECONOMY", 1).when(ptype == "MEDIUM", 2).when(ptype == "PROMO", 3)
        .when(ptype == "SMALL", 4).when(ptype == "LARGE", 5).otherwise(99).alias("categoria_id"),
        F.when(op == "UPDATE", F.round(F.col("p_retailprice").cast("decimal(12,2)") * F.lit(1.1).cast("decimal(2,1)"), 2).cast("double")).when(op == "STALE", F.lit(1.0))
        .otherwise(F.col("p_retailprice")).alias("preco_lista"),
        (op != "DELETE").alias("ativo"),
        F.when(op == "STALE", "UPDATE").otherwise(op).alias("operacao"),
        F.when(op == "INSERT", _ntz("1995-01-01 00:00:00")).when(op == "STALE", _ntz("1995-01-15 00:00:00"))
        .otherwise(_ntz("1995-02-01 00:00:00")).alias("atualizado_em"),
    )


def categories(spark: SparkSession) -> DataFrame:
    """The reference category table (fixed rows; broadcast wherever it is joined)."""
    rows = ", ".join(f"({i}, '{n}', CAST({m} AS DECIMAL(5,2)))" for i, n, m in CATEGORIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(categoria_id, nome_categoria, margem_alvo)")


def region_policy(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{g}', '{u}')" for g, u in REGION_POLICY)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(grupo, uf)")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run event log: timestamp, event_type, message, origin{update_id, flow_name}, details (JSON text)."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    eid, et = F.col("event_id"), F.col("event_type")
    status = F.when(eid % 3 == 0, "COMPLETED").when(eid % 3 == 1, "RUNNING").otherwise("FAILED")
    dropped = F.when(eid % 2 == 0, F.concat(F.lit('"dropped_records":'), _s(eid % 5), F.lit(","))).otherwise(F.lit(""))
    details = F.concat(
        F.lit('{"flow_progress":{"status":"'), status,
        F.lit('","metrics":{"num_output_rows":'), _s(eid % 101),
        F.lit('},"data_quality":{'), dropped,
        F.lit('"expectations":[{"name":"r1","dataset":"d'), _s(eid % 3),
        F.lit('","passed_records":'), _s(eid % 13),
        F.lit(',"failed_records":'), _s(eid % 4),
        F.lit('},{"name":"r2","dataset":"d0","passed_records":1,"failed_records":0}]}}}'),
    )
    return e.select(
        F.col("ts").alias("timestamp"),
        F.when(et.isin("view", "click"), "flow_progress").when(et == "signup", "update_progress")
        .when(et == "error", "cluster_resources").otherwise("planning_information").alias("event_type"),
        F.concat(F.lit("event "), _s(eid)).alias("message"),
        F.struct(
            F.concat(F.lit("u"), _s(F.col("user_id") % 20)).alias("update_id"),
            F.concat(F.lit("flow_"), _s(F.col("user_id") % 7)).alias("flow_name"),
        ).alias("origin"),
        details.alias("details"),
    )


def lineage_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table-lineage events (source table -> target table, event_time), one per ``events`` row."""
    e = read_table(spark, sf_dir, "events").select("ts", "user_id", "event_type")
    et, t = F.col("event_type"), F.col("user_id") % 4
    return e.select(
        F.lit("lakehouse").alias("source_table_catalog"),
        F.when(et.isin("view", "click", "signup"), "bronze").otherwise("silver").alias("source_table_schema"),
        F.when(et == "view", "pedidos_raw").when(et == "click", "clientes_raw").when(et == "signup", "produtos_raw")
        .when(et == "error", "pedidos").otherwise("clientes").alias("source_table_name"),
        F.lit("lakehouse").alias("target_table_catalog"),
        F.when(t < 2, "silver").otherwise("gold").alias("target_table_schema"),
        F.when(t == 0, "pedidos_eventos_validos").when(t == 1, "clientes_eventos_validos")
        .when(t == 2, "vendas_diarias_categoria").otherwise("clientes_valor").alias("target_table_name"),
        F.col("ts").alias("event_time"),
    )
