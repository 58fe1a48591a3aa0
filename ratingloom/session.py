"""Session settings for cluster jobs, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs want on a cluster; callers may override any of them. Shuffles start with many partitions, which AQE
# merges to the advisory size, so that one setting serves small inputs and 100 TB; larger scan tasks keep the number of
# map outputs the driver has to track within bounds at that size.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.session.timeZone": "UTC",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

# Streaming state has one entry per (movie, source) and never expires, so it must not live on the JVM heap.
STREAMING_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**CLUSTER_SETTINGS, **STREAMING_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session with another value of a setting, for the actions inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for a table that later stages read back.

    It lies in the folder the cluster names in `spark.checkpoint.dir`, which every executor sees. Only a local session
    may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="ratingloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/ratingloom/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether there is a file with data at or below `path`; files that begin with `_` or `.` are no data.

    Files are listed until the first one that counts, and none is opened.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not file_system.exists(hadoop_path):
        return False
    root = len(file_system.getFileStatus(hadoop_path).getPath().toString())
    files = file_system.listFiles(hadoop_path, True)
    while files.hasNext():
        file = files.next()
        parts = file.getPath().toString()[root:].split("/")
        if file.getLen() > 0 and not any(part.startswith(("_", ".")) for part in parts):
            return True
    return False


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files at or below `path`, from the listing; 0 if there is nothing."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.getContentSummary(hadoop_path).getLength() if file_system.exists(hadoop_path) else 0


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not file_system.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder unless it is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that is no longer needed."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def is_directory(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.exists(hadoop_path) and file_system.getFileStatus(hadoop_path).isDirectory()
