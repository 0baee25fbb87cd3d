"""Session construction and the shared working folder.

All intermediate and published data goes below the folder the cluster names in
``spark.checkpoint.dir`` (a shared file system on a real cluster). Only a local
master without one gets a fresh folder under /tmp; on a cluster that is an
error, since other machines would not see it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; every one of them is a plain Spark SQL conf.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # large key counts in streaming state (dedup) live in RocksDB, not the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def build_session(master: str = "local[8]", shuffle_partitions: int | None = None,
                  app_name: str = "tierline", extra: dict | None = None) -> SparkSession:
    """A session with ``SCALE_CONF``. Sizes (shuffle partitions, driver memory)
    are chosen for local masters only; a cluster keeps its own unless given."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if is_local(master):
        b = b.config("spark.driver.memory", "8g")
        shuffle_partitions = shuffle_partitions or 8
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    return spark.sparkContext.getCheckpointDir()


def work_root(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run.

    Reads ``spark.checkpoint.dir`` from the session; a local master that names
    none (as in tests) gets a /tmp folder, any other raises.
    """
    base = _checkpoint_dir(spark)
    if not base:
        if not is_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tierline-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    return f"{base}/tierline/{name or 'run'}-{uuid.uuid4().hex[:12]}"


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the input paths from file-system metadata (no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return int(total)


def scale_conf(total_input_bytes: int, partition_bytes: int = 256 << 20,
               min_partitions: int = 200) -> dict:
    """Settings sized to the input: an initial shuffle partition count that
    keeps each shuffle partition near ``partition_bytes`` (AQE coalesces
    small ones and splits skewed ones at runtime), and scan splits of the
    same size. Returns a dict; apply with ``apply_conf``."""
    parts = max(min_partitions, -(-total_input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def apply_conf(spark: SparkSession, conf: dict) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
