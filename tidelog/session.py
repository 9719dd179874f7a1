"""Session settings and the shared folder for data that must outlive a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, *, shuffle_partitions: int | None = None,
                  app: str = "tidelog", memory: str | None = None) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the deploy settings decide, and
    adaptive execution merges small partitions and splits skewed join partitions.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.ui.enabled", "false")
        # call sites for error texts cost the driver more than short queries take
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the shared folder.  Only a session that sets none (a test on one
    machine) gets a temporary folder, and that choice is kept for the rest of the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidelog-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
