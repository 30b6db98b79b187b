"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Rows of one key that may still be handled by one task (see operators.ordered).
GROUP_ROWS_CONF = "spark.streamlytics.maxGroupRows"
DEFAULT_GROUP_ROWS = 2_000_000

STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
_STORES = "org.apache.spark.sql.execution.streaming.state"
_HEAP_STATE_STORE = f"{_STORES}.HDFSBackedStateStoreProvider"
_DISK_STATE_STORE = f"{_STORES}.RocksDBStateStoreProvider"

ARROW_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARK_ARROW_BYTES = "67108864b"
#: Bytes of rows that go to a Python worker at once; a longer row goes alone.
ARROW_BYTES = 4 << 20

_local_dir: str | None = None


def build_session(cores: str = "*", app: str = "streamlytics", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster, spark-submit supplies one."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": "8",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings every query relies on; safe to call repeatedly."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # A hot join key must be split even when that costs one more shuffle.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Join a hot key's rows into sessions before they are shuffled.
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    if spark.conf.get(STATE_STORE_CONF) == _HEAP_STATE_STORE:
        # State outgrows the heap; keep it on disk and commit only its changes.
        spark.conf.set(STATE_STORE_CONF, _DISK_STATE_STORE)
        spark.conf.set(
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
        )
    if spark.conf.get(ARROW_BYTES_CONF) == _SPARK_ARROW_BYTES:
        # Batches stand several times in the memory of a worker and of its executor.
        spark.conf.set(ARROW_BYTES_CONF, str(ARROW_BYTES))
    sc = spark.sparkContext
    if sc.master.startswith("local") and not sc.getConf().contains("spark.sql.shuffle.partitions"):
        spark.conf.set("spark.sql.shuffle.partitions", str(sc.defaultParallelism))
    return spark


def size_shuffles(spark: SparkSession, input_dir: str, target_bytes: int = 256 << 20) -> None:
    """Choose the shuffle width from the input size, unless the job sets one.

    A partition should hold about ``target_bytes``; AQE merges what turns out small.
    """
    sc = spark.sparkContext
    if sc.master.startswith("local") or sc.getConf().contains("spark.sql.shuffle.partitions"):
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(input_dir)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    wanted = -(-fs.getContentSummary(path).getLength() // target_bytes)
    cores = sc.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(max(wanted, 2 * cores)))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see. Only an unset conf (tests) falls back to a local one."""
    global _local_dir
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="streamlytics-")
    return _local_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def pin(df):
    """Write ``df`` to the checkpoint folder and cut its lineage."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def max_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(GROUP_ROWS_CONF, str(DEFAULT_GROUP_ROWS)))
