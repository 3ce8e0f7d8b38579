"""Session helpers.

The library never creates its own cluster settings behind the caller's back:
``get_session`` is for scripts, tests and the benchmark.  ``checkpoint_dir``
reads ``spark.checkpoint.dir`` from the running session and only falls back to
a fresh scratch folder when the setting is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallyframe") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TALLYFRAME_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``checkpoint_dir`` and read it back, so that what is
    computed from it several times is computed once and survives lost executors."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and versioned tables.

    On a cluster this must be set (``spark.checkpoint.dir``) to a folder every
    executor can reach; we only invent one when it is unset, which happens in
    local runs and tests.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="tallyframe-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    try:  # classic sessions: also point RDD/Dataset checkpoint() at it
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        pass
    return path
