"""Event-time streaming operators: tumbling-window counts with a watermark, watermark dedup.

State stays bounded by the watermark: windows older than it are emitted
(append mode) and evicted; dedup keys older than it are dropped.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeutil import ntz_to_instant
from ..sources.fixtures import CHANNELS
from ..sources.tables import stream_table

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Order status each event type stands for in the order-creation stream.
EVENT_STATUS = (
    ("purchase", "CRIADO"),
    ("click", "PAGO"),
    ("view", "ENVIADO"),
    ("signup", "ENTREGUE"),
    ("error", "CANCELADO"),
)


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table as a file stream."""
    return stream_table(spark, sf_dir, "events", EVENTS_SCHEMA, max_files_per_trigger)


def order_creation_events(events: DataFrame) -> DataFrame:
    """Order events carried by ``events`` (stream or batch): one order per event.

    Watermarks need TIMESTAMP (not TIMESTAMP_NTZ), hence the cast.
    """
    status = None
    for et, st in EVENT_STATUS:
        status = (F.when(F.col("event_type") == et, st) if status is None else status.when(F.col("event_type") == et, st))
    canal = None
    for i, ch in enumerate(CHANNELS):
        canal = (F.when(F.col("user_id") % len(CHANNELS) == i, ch) if canal is None else canal.when(F.col("user_id") % len(CHANNELS) == i, ch))
    return events.select(
        F.col("event_id").alias("pedido_id"),
        F.col("user_id").alias("cliente_id"),
        F.lit(1).alias("quantidade"),
        F.col("value").alias("preco_unitario"),
        status.alias("status"),
        canal.alias("canal"),
        ntz_to_instant("ts").alias("pedido_ts"),
    )


def orders_per_hour(orders: DataFrame, delay: str = "2 hours", window: str = "1 hour") -> DataFrame:
    """Created orders and estimated revenue per tumbling window and channel (append mode)."""
    return (
        orders.withWatermark("pedido_ts", delay)
        .filter(F.col("status") == "CRIADO")
        .groupBy(F.window("pedido_ts", window).alias("janela"), "canal")
        .agg(
            F.count(F.lit(1)).alias("qtd_pedidos"),
            F.sum(F.col("quantidade") * F.col("preco_unitario")).alias("receita_estimada"),
        )
        .select(
            F.col("janela.start").alias("janela_inicio"),
            F.col("janela.end").alias("janela_fim"),
            "canal", "qtd_pedidos", "receita_estimada",
        )
    )


def dedup_within_watermark(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str = "2 hours") -> DataFrame:
    """Drop repeats of ``keys`` seen within the watermark delay (state bounded by the delay)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
