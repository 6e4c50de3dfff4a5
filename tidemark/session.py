"""Session settings the library depends on, and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# State on the executors' disks, of which a micro-batch saves its changes only.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows of a store costs a look-up for each row that is written.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
# A store is open while a task uses it, and all that are open share one limit of memory. A
# limit alone would not do: stores at rest keep it filled, and the others write small files.
UNLOADED = {
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}

_local_base: str | None = None


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone, so that text times and epochs mean UTC everywhere."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_base(spark: SparkSession) -> str:
    """The folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may go
    without, and then gets a temporary folder of its own, which goes with the process.
    """
    global _local_base
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _local_base, ignore_errors=True)
    return _local_base


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder (Spark creates it on first write)."""
    return f"{shared_base(spark).rstrip('/')}/tidemark/{purpose}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its terms."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.mkdirs(hadoop_path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    fs, root = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = file_system(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it appears whole, under a name of its own until then."""
    fs, file = file_system(spark, path)
    beside = file.getParent().getParent()
    unfinished = spark._jvm.org.apache.hadoop.fs.Path(beside, f"unfinished-{uuid.uuid4().hex}")
    stream = fs.create(unfinished, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.mkdirs(file.getParent())
    if not fs.rename(unfinished, file):
        fs.delete(unfinished, False)
        raise OSError(f"{path} is there already")


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)


def stream_settings(unload: bool = False) -> dict[str, str]:
    """Options for streams with state: the RocksDB store.

    The partitions of the state are the session's ``spark.sql.shuffle.partitions`` when
    the stream first starts; its checkpoint keeps that number. Each store, one a partition
    and stateful operator, holds memory outside the heap until its stream has long ended.
    With ``unload`` it is closed after each micro-batch and read again for the next one:
    memory goes by running tasks, not by stores, for more time a store and micro-batch.
    """
    return {**ROCKSDB, **UNLOADED} if unload else dict(ROCKSDB)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Set session options for a while; a started stream keeps its own copy."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
