"""Session settings the jobs are designed for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# Runtime settings; `tune` applies one only where the session has not set it.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The order-keyed joins feed an aggregation on the same key. Without this a
    # skewed join partition would be kept whole to save the extra shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What merged shuffle partitions hold at most. A task that joins, sorts and groups takes
    # some thirty times as much memory; with Spark's 64 MB that is 2 GB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # What a task reads of a file at most. Beyond 200 shuffle partitions a task keeps the rows
    # it sends in memory, some thirteen times the bytes it read; with Spark's 128 MB and 6 GB
    # of tables that is 1.6 GB.
    "spark.sql.files.maxPartitionBytes": "32m",
    # Shuffle files go when the statement that made them ends. Otherwise they stay until the
    # driver happens to collect its garbage, and a refresh keeps those of all its steps.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Ids and moments are text, which takes two thirds of the space of Spark's snappy.
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the session leaves open."""
    for key, value in RUNTIME_SETTINGS.items():
        if not _is_set(spark, key):
            spark.conf.set(key, value)
    return spark


# Shuffle sizing: input bytes per shuffle partition, so that a task's memory does not grow
# with the input, and the bytes beyond MANY_PARTITIONS of them. Spark merges partitions that
# turn out small at run time.
SHUFFLE_BYTES, LARGE_SHUFFLE_BYTES = 8 << 20, 256 << 20
MANY_PARTITIONS = 4096
SIZED_FOR = "spark.tradeloom.shuffle.sizedFor"
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BEGUN_FOR = "spark.tradeloom.shuffle.begunFor"


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Enough partitions for the bytes, at least one per core up to 200."""
    small, large = -(-input_bytes // SHUFFLE_BYTES), -(-input_bytes // LARGE_SHUFFLE_BYTES)
    return max(min(200, cores), min(small, MANY_PARTITIONS), large)


def _is_set(spark: SparkSession, key: str) -> bool:
    return spark.conf.get(key, None) is not None


def size_shuffles(spark: SparkSession, source: str, measure: Callable[[], int]) -> None:
    """Fit shuffle partitions to the input named by `source`.

    `measure` gives its bytes and is only called for a source not sized for yet. A
    session that sets `spark.sql.shuffle.partitions` itself keeps its setting.
    """
    partitions = "spark.sql.shuffle.partitions"
    sized_for = spark.conf.get(SIZED_FOR, "")
    if sized_for == source or (_is_set(spark, partitions) and not sized_for):
        return
    size = measure()
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set(partitions, str(shuffle_partitions_for(size, cores)))
    spark.conf.set(SIZED_FOR, source)


def fit_shuffles(spark: SparkSession, source: str, measure: Callable[[], int]) -> None:
    """`size_shuffles`, and enough partitions as well where the session sets their number.

    Its `spark.sql.shuffle.partitions` stays and holds wherever Spark doesn't merge
    partitions. Where it does, that number is only what a shuffle begins with; a small one
    would let the memory of a task grow with the input, so shuffles begin with as many as
    the input needs. A session that sets FIRST_PARTITIONS itself keeps its setting.
    """
    size_shuffles(spark, source, measure)
    if spark.conf.get(SIZED_FOR, ""):
        return
    given = spark.conf.get("spark.sql.shuffle.partitions")
    begun_for = spark.conf.get(BEGUN_FOR, "")
    if begun_for == f"{given} {source}" or (_is_set(spark, FIRST_PARTITIONS) and not begun_for):
        return
    needed = shuffle_partitions_for(measure(), cores=1)
    if needed > int(given):
        spark.conf.set(FIRST_PARTITIONS, str(needed))
    else:
        spark.conf.unset(FIRST_PARTITIONS)
    spark.conf.set(BEGUN_FOR, f"{given} {source}")


def build_session(
    app_name: str = "tradeloom",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session; leave `master` empty under spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Where the cluster names none, a local folder is used; that only works in
    local mode, so any other master is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="tradeloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_root(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def new_run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the one of this application."""
    return f"{run_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder below that of this application, once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_run_folders(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once its results are stored."""
    remove_folder(spark, run_root(spark))
