"""Layout queries: Z-order compaction and clustered gold writes (rows must be unchanged)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.layout import clustered
from ..operators.snapshots import SnapshotTable
from ..session import work_dir
from . import gold
from . import oracle as O
from . import silver
from .registry import query
from .q_cdc import ORD_OUT
from .q_gold import DAILY_OUT_SQL, _daily_out
from .q_snapshots import commit_time

ZORDER_COLS = ("cliente_id", "pedido_ts")


def optimized_snapshot(spark, sf_dir) -> SnapshotTable:
    t = SnapshotTable(spark, work_dir(spark, "orders_zorder"))
    t.create(silver.orders(spark, sf_dir), commit_time(0))
    t.optimize_zorder(ZORDER_COLS, commit_time(1))
    return t


@query("zorder_layout", O.with_(*O.ORD) + "SELECT * FROM scd1_orders")
def zorder_layout(spark, sf_dir):
    """OPTIMIZE ... ZORDER BY (cliente_id, pedido_ts): the rewritten version holds the same rows."""
    return optimized_snapshot(spark, sf_dir).read(1).select(*ORD_OUT)


@query("optimize_history")
def optimize_history(spark, sf_dir):
    """OPTIMIZE commits with their Z-order columns and file counts (file counts depend on the writer)."""
    h = optimized_snapshot(spark, sf_dir).history()
    return h.filter(F.col("operation") == "OPTIMIZE").select(
        "version", "operation",
        F.col("operationParameters")["zOrderBy"].alias("zorder_por"),
        F.col("operationMetrics")["numRemovedFiles"].cast("bigint").alias("arquivos_removidos"),
        F.col("operationMetrics")["numAddedFiles"].cast("bigint").alias("arquivos_criados"),
    )


@query("clustered_daily_sales", O.with_(*O.GOLD, O.DAILY) + DAILY_OUT_SQL)
def clustered_daily_sales(spark, sf_dir):
    """The daily sales dataset written CLUSTER BY (data_pedido, categoria_id) and read back."""
    path = work_dir(spark, "gold_vendas_diarias_categoria")
    daily = gold.daily_category_sales(gold.orders_enriched(spark, sf_dir))
    clustered(daily, ["data_pedido", "categoria_id"]).write.mode("errorifexists").parquet(path)
    return _daily_out(spark.read.parquet(path))
