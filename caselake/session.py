"""Session settings the library relies on, and the shared folder it may write to."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Results depend on the time zone. The skew settings keep hot keys from stalling a join. The JVM does
# not compile methods over 8000 bytes, so larger generated stages are better split into operators. Versioned
# tables have a folder per place: a few dozen are listed by the driver, more by 32 tasks and not one each. Shuffle
# files go when their query ends and not when the driver happens to collect garbage: a table that is built from
# shared tables would else keep what all of them shuffled.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "128",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# What a task holds follows its share of the rows, so the share is bounded and the number of tasks grows with the
# input: scans are cut, shuffles start with partitions enough (more would make every writer buffer and sort its rows)
# and are merged up to the size of one share. A session that cuts finer keeps its own values.
AT_MOST = {"spark.sql.files.maxPartitionBytes": "16m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}
AT_LEAST = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": 200}

_LOCAL_DIRS: dict[str, tempfile.TemporaryDirectory] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a running session (only where they differ) and hold it to the bounds on a task's share."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in AT_MOST.items():
        if _bytes(spark, spark.conf.get(key)) > _bytes(spark, value):
            spark.conf.set(key, value)
    for key, value in AT_LEAST.items():
        if int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions")) < value:
            spark.conf.set(key, str(value))
    return spark


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def side_by_side(*steps: Callable[[], object], at_once: int | None = None) -> list:
    """Results of independent steps whose jobs share the cluster; a step that fails lets the others finish first."""
    with ThreadPoolExecutor(at_once or len(steps)) as pool:
        return [held.result() for held in [pool.submit(s) for s in steps]]


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "caselake") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would exist on one machine only.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.TemporaryDirectory(prefix="caselake-", ignore_cleanup_errors=True)
    return _LOCAL_DIRS[app].name


def run_dir(spark: SparkSession) -> str:
    """Sub-folder of the shared folder that belongs to this application."""
    return f"{shared_dir(spark)}/caselake/{spark.sparkContext.applicationId}"
