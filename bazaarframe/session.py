"""Session settings the plans count on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from bazaarframe.operators.joins import require_exact_sizes
from bazaarframe.sources.files import folder_bytes

_PLAN_SETTINGS = {
    # Adaptive execution picks broadcast joins from measured sizes and sizes shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    # A hot key's partition is split even where that costs one more exchange of the join's result.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Wrong values must fail a job, not turn into NULL.
    "spark.sql.ansi.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session; safe to call again."""
    for key, value in _PLAN_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


SHUFFLE_BYTES = 128 << 20  # most input per shuffle partition; adaptive execution merges small ones
FINE_BYTES, FINE_PARTITIONS = 16 << 20, 2000  # wanted input a task, as Parquet unfolds tenfold; up to the number with exact sizes
SCAN_BYTES = 128 << 20  # Spark's own size of scan tasks
MERGED_BYTES = 16 << 20  # compressed shuffle data up to which partitions are merged: a task's memory holds several times as much
MAX_SHUFFLE_PARTITIONS = 20_000
MAX_SCAN_TASKS = 200_000


def partitions_for(
    input_bytes: int, shuffle_bytes: int = SHUFFLE_BYTES, most_partitions: int = MAX_SHUFFLE_PARTITIONS
) -> tuple[int, int]:
    """(initial shuffle partitions, bytes per scan task) for an input of the given size.

    A partition stands for ``FINE_BYTES`` of input until there are ``FINE_PARTITIONS``, then for ``shuffle_bytes`` at
    most until there are ``most_partitions``; beyond, partitions grow: at 100 TB the default of 20,000 makes them 5 GB of
    input each, so raise it as far as the driver can keep track of.
    """
    fine = min(input_bytes // min(FINE_BYTES, shuffle_bytes), FINE_PARTITIONS)
    shuffle = min(max(input_bytes // shuffle_bytes, fine, 1), most_partitions)
    return shuffle, max(SCAN_BYTES, input_bytes // MAX_SCAN_TASKS)


def size_for(
    spark: SparkSession, folder: str, shuffle_bytes: int = SHUFFLE_BYTES, most_partitions: int = MAX_SHUFFLE_PARTITIONS
) -> SparkSession:
    """Size shuffles and scan tasks for the data under a folder, never below what the session was set to.

    Scan tasks of Spark's own size become smaller where the input allows it: one that groups its rows by keys that hardly
    repeat, before they are shuffled, holds all of them.

    Adaptive execution can merge small shuffle partitions but not divide evenly large ones, so the
    initial number has to fit the input; see partitions_for.
    """
    input_bytes = folder_bytes(spark, folder)
    shuffle, scan_bytes = partitions_for(input_bytes, shuffle_bytes, most_partitions)
    if scan_bytes == SCAN_BYTES:
        scan_bytes = min(max(FINE_BYTES, input_bytes // FINE_PARTITIONS), SCAN_BYTES)
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(first, None) or 0))
    require_exact_sizes(spark, max(shuffle, now))
    if shuffle > now:
        spark.conf.set(first, str(shuffle))
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    scan = "spark.sql.files.maxPartitionBytes"
    if scan_bytes > as_bytes(spark.conf.get(scan)) or as_bytes(spark.conf.get(scan)) == SCAN_BYTES:
        spark.conf.set(scan, str(scan_bytes))
    merged = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if MERGED_BYTES < as_bytes(spark.conf.get(merged, None) or "64m"):
        spark.conf.set(merged, str(MERGED_BYTES))
    return spark


def local_session(cores: int | str = "*", name: str = "bazaarframe", **conf: str) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.shuffle.accurateBlockSkewedFactor", "5")
        # The test tables are single-task scans; a shuffle spreads what follows, a broadcast would not.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that starts in here go when it ends, not when the driver comes to collect its garbage.

    For queries that run once: a DataFrame that is asked again would shuffle again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: the cluster's checkpoint directory, or a local one in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
            raise ValueError("spark.checkpoint.dir is not set; name a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="bazaarframe-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
