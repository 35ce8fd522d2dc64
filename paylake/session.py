"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024

#: Rows of a batch of a kept frame. Batches of records with text stay far below a MB: the JVM gives larger arrays whole regions
#: that no accounting sees, and a task that moves a frame to or from disk holds the last hundred batches.
KEPT_ROWS = 1000

# Adaptive execution picks join strategies from measured sizes, splits skewed
# join partitions and merges small ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Call-site capture on every column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shuffle_partitions(shuffled_bytes: int, partition_bytes: int = 256 * MIB) -> int:
    """Partitions that keep one reduce task near ``partition_bytes`` of input.

    Adaptive execution merges surplus partitions but cannot add missing ones for
    aggregations, so the number has to follow the data.
    """
    return max(200, -(-shuffled_bytes // partition_bytes))


def cluster_conf(shuffled_bytes: int) -> dict[str, str]:
    """Settings for a cluster job that shuffles about ``shuffled_bytes``."""
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions(shuffled_bytes)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB),
        "spark.sql.files.maxPartitionBytes": str(256 * MIB),
    }


def fit_partitions(spark: SparkSession, input_bytes: int, partition_bytes: int = 4 * MIB) -> None:
    """Raise the session's shuffle partitions so that one is made for each ``partition_bytes`` of compressed input.

    A session made for a small input would give each task of a large one a share that grows with it. Some
    memory of a task is a row's, not a byte's: compressed columns are many times larger as rows, and one task holds the
    sorts and hash tables of all joins on a key. Never lowers a setting.
    """
    wanted = -(-input_bytes // partition_bytes)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
        # Else adaptive execution merges them up to 64 MB again.
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(4 * partition_bytes))


def keep(df: DataFrame) -> DataFrame:
    """Persist a frame that several queries read on the executors' disks, with its small partitions merged.

    It takes no memory from sorts and hash tables, whatever its size; the system's file cache keeps a small one in reach.

    By default Spark caches all shuffle partitions as they are. A shuffle of the frame then has that number on both
    sides, and a write of it so many files: blocks that grow with the square of the input, however few the rows.
    """
    df.sparkSession.conf.set("spark.sql.inMemoryColumnarStorage.batchSize", str(KEPT_ROWS))
    df.sparkSession.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
    return df.persist(StorageLevel.DISK_ONLY)


def local_session(cores: int | str = "*", app: str = "paylake", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**BASE_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared folder that the session names.

    The setting ``spark.checkpoint.dir`` decides. Only a local session may do
    without it; there a temporary folder is used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{os.urandom(6).hex()}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"paylake-{name}-")
