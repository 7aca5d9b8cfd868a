"""Streaming queries: hourly windows with a watermark, watermark dedup, validation fan-out.

Each query runs its stream to completion (availableNow) into a parquet sink
under the shared checkpoint folder and returns a batch read of the sink.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeutil import instant_to_ntz, ntz_to_instant
from ..operators.quality import split_valid
from ..sources import fixtures as fx
from ..sources.tables import read_table, table_path, stream_table
from ..streaming.runner import StreamTarget, partitions_for, read_sink, run_available_now
from ..streaming.windows import dedup_within_watermark, events_stream, order_creation_events, orders_per_hour
from . import oracle as O
from . import silver
from .registry import query, r2

HOURLY_SQL = """WITH p AS (
  SELECT ts, CASE user_id % 4 WHEN 0 THEN 'site' WHEN 1 THEN 'app' WHEN 2 THEN 'marketplace' ELSE 'loja_fisica' END AS canal, value
  FROM events WHERE event_type = 'purchase'),
wm AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR AS w FROM p),
hourly AS (
  SELECT * FROM (
    SELECT date_trunc('hour', ts) AS janela_inicio, date_trunc('hour', ts) + INTERVAL 1 HOUR AS janela_fim, canal,
           count(*) AS qtd_pedidos, round(sum(1 * value), 2) AS receita_estimada
    FROM p GROUP BY 1, 2, 3) g
  WHERE janela_fim <= (SELECT w FROM wm))
"""


def hourly_windows(spark, sf_dir):
    """Run the hourly-window stream over the events file; returns the sink as a batch frame."""
    target = StreamTarget.create(spark, "orders_per_hour")
    stream = orders_per_hour(order_creation_events(events_stream(spark, sf_dir)))
    run_available_now(stream, target)
    out = read_sink(spark, target)
    return out.select(
        instant_to_ntz("janela_inicio").alias("janela_inicio"),
        instant_to_ntz("janela_fim").alias("janela_fim"),
        "canal", "qtd_pedidos", r2("receita_estimada").alias("receita_estimada"),
    )


@query("orders_per_hour", HOURLY_SQL + "SELECT * FROM hourly")
def orders_per_hour_query(spark, sf_dir):
    return hourly_windows(spark, sf_dir)


@query("latest_windows", HOURLY_SQL + "SELECT * FROM hourly ORDER BY janela_inicio DESC, canal DESC LIMIT 20")
def latest_windows(spark, sf_dir):
    """The 20 most recent closed windows (a top-k report: the limit is the feature)."""
    return hourly_windows(spark, sf_dir).orderBy(F.col("janela_inicio").desc(), F.col("canal").desc()).limit(20)


def dedup_sink(spark, sf_dir):
    target = StreamTarget.create(spark, "stream_dedup")
    ev = events_stream(spark, sf_dir).withColumn("ts", ntz_to_instant("ts"))
    run_available_now(dedup_within_watermark(ev, ["user_id", "event_type"], "ts", "2 hours"), target)
    return read_sink(spark, target)


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """Keys kept by watermark dedup over one input file (one batch: every repeat is dropped)."""
    return dedup_sink(spark, sf_dir).select("user_id", "event_type")


@query(
    "stream_dedup_effect",
    "SELECT count(*) AS linhas, count(DISTINCT user_id) AS ids_distintos FROM (SELECT DISTINCT user_id, event_type FROM events) x",
)
def stream_dedup_effect(spark, sf_dir):
    return dedup_sink(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("linhas"), F.countDistinct("user_id").alias("ids_distintos")
    )


@query(
    "stream_quarantine",
    O.with_(O.ORDER_EVENTS, O.VALID_ORDERS, O.QUARANTINE)
    + """SELECT 'pedidos_eventos_validos' AS tabela, count(*) AS linhas FROM valid_orders
UNION ALL SELECT 'pedidos_quarentena', count(*) FROM quarantine""",
)
def stream_quarantine(spark, sf_dir):
    """One streaming source, two append queries (valid rows, quarantine), each with its own checkpoint.

    The line items arrive as a file stream and are joined to the static orders table.
    """
    li_schema = spark.read.parquet(table_path(sf_dir, "lineitem")).schema
    li = stream_table(spark, sf_dir, "lineitem", li_schema)
    events = fx.order_events(spark, sf_dir, lineitem=li)
    valid, quarantine = split_valid(events, silver.ORDER_RULES)
    tv = StreamTarget.create(spark, "pedidos_eventos_validos")
    tq = StreamTarget.create(spark, "pedidos_quarentena")
    # The files' footers tell the rows.
    n = partitions_for(spark, read_table(spark, sf_dir, "lineitem").count())
    run_available_now(valid, tv, state_partitions=n)
    run_available_now(quarantine.withColumn("regras_violadas", F.array_join("regras_violadas", ",")), tq, state_partitions=n)
    return read_sink(spark, tv).select(F.lit("pedidos_eventos_validos").alias("tabela")).unionByName(
        read_sink(spark, tq).select(F.lit("pedidos_quarentena").alias("tabela"))
    ).groupBy("tabela").agg(F.count(F.lit(1)).alias("linhas"))
