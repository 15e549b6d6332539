"""Session settings the pipeline relies on, and the shared folder it may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Timestamps are kept without a zone; UTC keeps every detour over TIMESTAMP (date_trunc,
# watermarks) free of daylight-saving gaps. Adaptive execution picks broadcast or shuffle
# joins from measured sizes and splits hot join keys and oversized write partitions. Stream
# state goes to RocksDB: it may outgrow the executors' heap.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, and only when the setting is absent:
    on a cluster other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="badgeflow-")
    return f"{base.rstrip('/')}/badgeflow/{name}-{uuid.uuid4().hex}"
