"""Session settings for runs from one machine to a large cluster."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE does the skew work: hot join partitions are cut into slices, rebalanced
# writes are split, small shuffles are merged. A shuffled join whose lookup side
# fits in memory becomes a hash join, which spares sorting the order side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Building a plan is much quicker if Python does not note a call site per column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024
# By this factor input grows when shuffled as rows: packed columnar files grow, text does not.
ROW_EXPANSION = {"parquet": 4, "csv": 1}
# The driver keeps a status of every map task for every one of these; partitions
# grow past the size above instead, and spill.
MOST_SHUFFLE_PARTITIONS = 50_000


def build_session(
    app_name: str = "ordermill",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or reuse) a session with :data:`SETTINGS`, overridden by ``extra``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shuffle_partitions_for(input_bytes: int, kind: str = "parquet") -> int:
    """Shuffle partitions that keep each one near 256 MB for this much input of a kind,
    within what a driver can keep track of."""
    wanted = -(-input_bytes * ROW_EXPANSION[kind] // BYTES_PER_SHUFFLE_PARTITION)
    return min(max(1, wanted), MOST_SHUFFLE_PARTITIONS)


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total length of the files under the paths, from the file system alone."""
    total = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in files.globStatus(place) or []:
            total += files.getContentSummary(found.getPath()).getLength()
    return total


def size_shuffles(spark: SparkSession, *paths: str, kind: str = "parquet") -> int:
    """Raise ``spark.sql.shuffle.partitions`` to suit the size of the inputs.

    AQE merges partitions that turn out small but does not split plain ones, so
    the starting number has to fit the data. The setting is never lowered, and
    holds for the session from then on: every later query in it may use it.
    Returns the number in force.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = shuffle_partitions_for(input_bytes(spark, *paths), kind)
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it is; nothing happens if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder named in ``spark.checkpoint.dir``.

    Only a session without that setting (a local test) gets a local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "ordermill-scratch")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
