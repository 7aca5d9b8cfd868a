"""Session construction and the shared work folder.

Everything this library materialises (stream checkpoints, sink tables, lineage
cuts) goes under the folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent *and* the master is local (tests, bench) do we
create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "changeflow") -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's session."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from the session; set a local one only where it is unset on a local master.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; on a cluster it must name a shared folder "
            "(streams and lineage cuts are written there)"
        )
    root = tempfile.mkdtemp(prefix="changeflow-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, root)
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir() or root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root for one job run."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, path: str):
    """Write ``df`` as a parquet table at ``path`` (under the shared folder) and read it back.

    The lineage is cut at the written table; downstream jobs scan it with column
    pruning and filter pushdown instead of recomputing its plan.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
