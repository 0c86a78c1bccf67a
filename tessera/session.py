"""Session helpers: defaults for local runs and the shared checkpoint folder.

Library functions never build their own session; they take the caller's.
``local_session`` is for tests, the bench and the examples only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.driver.memory": "16g",
}


# Suggested settings for a large cluster (about 100 TB of parquet, ~1000 executors). Passed by
# the caller when building the session; the library never changes a running session.
CLUSTER_SETTINGS = {
    # AQE re-plans joins from real sizes, splits skewed join partitions and merges small ones
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # start wide (~100 TB / 256 MB would be 400k; AQE coalesces down), scans of 512 MB splits
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "512m",
    # static broadcasts only for genuinely small sides; AQE may still broadcast at run time
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # state of very many keys off-heap, checkpointed as changelogs
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # checkpoints are lineage cuts: remove their files once no plan refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", app: str = "tessera", **conf) -> SparkSession:
    """A ``local[cores]`` session with the settings the tests and bench assume."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session if needed.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file system
    that outlives executors). Only a local master without that setting gets a scratch
    folder of its own, because there every task runs in this one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (HDFS/S3/DBFS) before running "
                "operators that cut lineage"
            )
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new path below the session's checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: later steps reread it, so a lost executor
    costs a task of the last step only, and nothing upstream runs twice."""
    spark = df.sparkSession
    path = shared_folder(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
