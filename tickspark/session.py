"""Session construction and the shared folder used for lineage cuts and sinks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Conf applied on every session we build.  AQE re-plans joins and coalesces
# shuffle partitions at run time; UTC keeps timestamp arithmetic engine-neutral.
_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app_name: str = "tickspark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    sc = spark_context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scale_conf(input_bytes: int, total_cores: int,
               partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Conf for a cluster run sized from the bytes a job reads.

    Shuffle partitions start at about one per ``partition_bytes`` of input
    (at least two per core); AQE then coalesces small ones and splits
    skewed ones at run time.  File splits use the same target size.
    """
    parts = max(2 * total_cores, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # streaming state lives off-heap and checkpoints incrementally
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def spark_context(spark: SparkSession):
    """The SparkContext, or None on sessions without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster this setting names shared storage and is always read from
    the session (and missing it is an error).  Only in local mode, when it
    is unset (tests), do we create one.
    """
    sc = spark_context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store); "
                               "a machine-local folder does not survive executor loss")
        root = tempfile.mkdtemp(prefix="tickspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tickspark/{name}-{uuid.uuid4().hex}"
