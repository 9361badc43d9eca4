"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every harborlens session wants, whatever the cluster size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "harborlens", extra: dict | None = None, driver_memory: str = "8g") -> SparkSession:
    """Session for local runs and tests; on a cluster use the provided session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        spark.conf.set(k, conf[k])
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` as the cluster names it.  Only when it is
    unset and the master is local (tests) is a scratch folder created; on a
    cluster without the setting this raises, since executors would each write to
    their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="harborlens-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder, for written intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name) if "://" not in base else f"{base.rstrip('/')}/tables/{name}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a cut in its lineage that
    survives lost executors, for data that a plan reads more than once."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables this session has written to the shared folder.

    Call it when results that read them are no longer needed; a long-lived session
    would otherwise keep a copy of every staged input."""
    base = spark.sparkContext.getCheckpointDir()
    if base:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/tables")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cluster_settings(input_bytes: float, executors: int, cores_per_executor: int = 4,
                     target_partition_mb: int = 256) -> dict[str, str]:
    """Settings for a cluster run sized to the data, to pass to the session builder.

    Shuffle partitions: enough that each holds about ``target_partition_mb``
    of the input (the upper bound of what a shuffle moves here, since every
    operator aggregates or prunes before it shuffles), at least two waves of
    the cluster's cores; AQE then coalesces small ones and
    splits skewed ones.  Scan splits stay at 256 MB so one task's input fits
    comfortably in an executor core's share of memory."""
    cores = max(1, executors * cores_per_executor)
    by_size = int(input_bytes // (target_partition_mb * 2 ** 20)) + 1
    partitions = max(2 * cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 2 ** 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_mb * 2 ** 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 2 ** 20),
        "spark.sql.session.timeZone": "UTC",
        # stream state (E4, M6) on local disk with changelogs, not in executor memory
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
