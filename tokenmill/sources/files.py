"""File access inside tasks and existence checks, on whatever file system the path names."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

HADOOP_S3 = ("s3a://", "s3n://")


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow file system and inner path. Hadoop's names of the object store are Arrow's ``s3``."""
    for scheme in HADOOP_S3:
        path = "s3://" + path.removeprefix(scheme) if path.startswith(scheme) else path
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark itself takes where none is given, so tasks write where Spark looks."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = store.makeQualified(target).toString()
    return "file://" + full.removeprefix("file:") if full.startswith("file:/") and not full.startswith("file://") else full


def make_files(names: DataFrame, folder: str, content: bytes) -> None:
    """Makes a file for each (name); tasks make them, where Spark reads."""
    folder = qualified(names.sparkSession, folder)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, inner = filesystem(folder)
        store.create_dir(inner)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_output_stream(f"{inner}/{name}") as out:
                    out.write(content)
        yield from ()

    tasks = names.sparkSession.sparkContext.defaultParallelism
    names.select("name").repartition(tasks).mapInArrow(make, "name STRING").write.format("noop").mode("overwrite").save()


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of a path, and the path as it wants it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _hadoop(spark, path)
    return store.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Paths of what lies in a folder; none if it is not there."""
    store, target = _hadoop(spark, path)
    return [f.getPath().toString() for f in store.listStatus(target)] if store.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder if it is there."""
    store, target = _hadoop(spark, path)
    store.delete(target, True)


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Renames; False if there was nothing to rename."""
    store, target = _hadoop(spark, path)
    try:
        return store.rename(target, _hadoop(spark, to)[1])
    except Py4JJavaError as error:
        if "FileNotFoundException" in str(error.java_exception):
            return False
        raise


@contextmanager
def claimed(spark: SparkSession, path: str, stale: float) -> Iterator[bool]:
    """Whether this caller holds the claim ``path`` inside; it is refreshed meanwhile and removed at the end."""
    store, target = _hadoop(spark, path)
    if exists(spark, path):
        try:
            age = time.time() - store.getFileStatus(target).getModificationTime() / 1000
        except Py4JJavaError:  # removed meanwhile
            age = 0
        if age <= stale or not move(spark, path, f"{path}-{uuid.uuid4().hex}"):
            yield False
            return
    try:
        store.create(target, False).close()
    except Py4JJavaError:  # another one was first
        if not exists(spark, path):
            raise
        yield False
        return
    ended = threading.Event()

    def refresh() -> None:
        while not ended.wait(stale / 5):
            store.setTimes(target, int(time.time() * 1000), -1)

    keeper = threading.Thread(target=refresh, daemon=True)
    keeper.start()
    try:
        yield True
    finally:
        ended.set()
        keeper.join()
        remove(spark, path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")
