"""Session set-up and the folder that all executors can reach."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

_tables: ContextVar[str | None] = ContextVar("tables", default=None)


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench. On a cluster, bring the cluster's own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tokenmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local sessions."""
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="tokenmill-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path that nothing has used yet, under the shared folder or the open ``own_tables``."""
    return os.path.join(_tables.get() or shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables made inside go to a folder of their own, which is removed at the end.

    Frames that read them must be written or collected inside.
    """
    folder = os.path.join(shared_dir(spark), f"tables-{uuid.uuid4().hex}")
    outer = _tables.set(folder)
    try:
        yield folder
    finally:
        _tables.reset(outer)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, so later passes read it instead of redoing it.

    As Parquet, so that each pass reads its columns only; lost executors cost nothing.
    """
    path = fresh_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows over all cores, for work that is heavy per row.

    Only where the scan gives fewer partitions than there are cores, so a large input is never
    shuffled for this. ``df`` should be a scan with narrow steps; the keys should be unique.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming:
        return df
    # asking for partitions would run the stages below an exchange
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if re.search(r"\b(Join|Aggregate|Repartition\w*|Window|Sort)\b", plan) or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
