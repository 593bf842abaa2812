"""Spark session defaults for emporia jobs.

Cluster deployments pass their own settings through spark-submit; the
builder below only fills in what is missing, so a cluster-provided
``spark.checkpoint.dir`` or shuffle-partition count always wins.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every emporia job relies on. AQE re-plans joins from measured
# shuffle sizes (a broadcast only happens behind that runtime check),
# coalesces small partitions and splits skewed join partitions. Tasks of
# 32 MB hold their rows in memory; larger ones spill beside others.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "emporia",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session, creating a local one when none exists."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("EMPORIA_DRIVER_MEM", "16g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage and keep streaming checkpoints.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Where it is
    unset a scratch folder serves sessions on one machine (``local`` master,
    as in tests); on a cluster that would be lost work, so it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="emporia-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def bounded_batches(spark: SparkSession) -> None:
    """Rows and bytes per Arrow batch: a Python worker then holds a few MB of texts at a time, or one longer text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


#: What a task of a job over the whole change log reads and shuffles. A shuffle writer or a sort holds these rows in memory
#: (some ten times their bytes in a Parquet file, four times those of a shuffle), for several steps at once.
TASK_BYTES = 32 << 20
#: A shuffle's bytes by those of its Parquet files, rounded up, and the most partitions that a session is given.
SHUFFLED, MOST_PARTITIONS = 4, 20_000

_filled: dict[str, str] = {}


def _fill(spark: SparkSession, key: str, value: str) -> None:
    """Set what nobody but this function has set."""
    if spark.conf.get(key, None) in (None, _filled.get(key)):
        spark.conf.set(key, value)
        _filled[key] = value


def bounded_tasks(spark: SparkSession, df: DataFrame) -> None:
    """Tasks of about ``TASK_BYTES``, for jobs that shuffle all rows of the stored table ``df``: what a task holds does
    not grow with the table, so writers and sorts need not spill. Settings that the session has are left alone."""
    size = int(df._jdf.queryExecution().analyzed().stats().sizeInBytes())
    _fill(spark, "spark.sql.files.maxPartitionBytes", str(TASK_BYTES))
    _fill(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTITIONS, -(-size * SHUFFLED // TASK_BYTES)))
    _fill(spark, "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Workers import the functions they run by module name; they find them
    whatever folder the driver was started in.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="emporia-code-"), "emporia_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
