"""Session defaults and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def local_session(name: str = "relaybook", cores: int | str = 8, **conf: str) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    shuffles = {"spark.sql.shuffle.partitions": str(cores)} if str(cores).isdigit() else {}
    for key, value in {**SETTINGS, **shuffles, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may do without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        base = tempfile.mkdtemp(prefix="relaybook-")
    return f"{base.rstrip('/')}/relaybook/{purpose}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows to the shared folder and read them back, so that lost executors cost no rerun."""
    path = work_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
