"""A metric log that stays small to read: a compacted snapshot and the appends since.

``appends/<name>`` holds what was logged, ``snapshots/<number>`` the resolved values of all appends that its ``included`` table
names, dealt into buckets by run and metric. A reader takes the newest committed snapshot and the appends that it does not include,
so appends that end while a snapshot is made are not lost. Appends and snapshots are removed only by ``vacuum``.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill import schemas
from tokenmill.operators.metrics import resolve_resumed
from tokenmill.session import cut_lineage
from tokenmill.sources.files import children, is_complete, remove

BUCKETS = 64


def append(log: DataFrame, path: str) -> str:
    """One more part of the log; its name. Parts that a reader sees have been committed."""
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    log.select("run", "step", "metric", "value", "logged_at").write.parquet(f"{path}/appends/{name}")
    return name


def _bucket(run, metric, buckets: int) -> Column:
    return F.pmod(F.xxhash64(run, metric), F.lit(buckets)).cast("int")


def _snapshot(spark: SparkSession, path: str) -> tuple[str | None, set[str]]:
    """Folder of the newest committed snapshot and the names that it includes, one for each append since the last vacuum."""
    done = [f for f in children(spark, f"{path}/snapshots") if is_complete(spark, f"{f}/included")]
    if not done:
        return None, set()
    newest = max(done, key=lambda f: int(f.rsplit("/", 1)[1]))
    return newest, {r["name"] for r in spark.read.schema("name STRING").parquet(f"{newest}/included").collect()}


def _open_appends(spark: SparkSession, path: str, included: set[str]) -> list[str]:
    named = {f.rsplit("/", 1)[1]: f for f in children(spark, f"{path}/appends")}
    return [f for name, f in sorted(named.items()) if name not in included and is_complete(spark, f)]


def read(spark: SparkSession, path: str, run: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The log: snapshot and tail. It resolves to the same values as all appends together; with ``run``, only its rows are read."""
    newest, included = _snapshot(spark, path)
    tail = _open_appends(spark, path, included)
    columns = ["run", "step", "metric", "value", "logged_at"]
    parts = []
    if newest:
        held = spark.read.schema(schemas.METRIC_LOG + ", bucket INT").parquet(f"{newest}/values")
        if run is not None:  # buckets are folders: the others are not listed
            metrics = spark.read.schema("run BIGINT, metric STRING").parquet(f"{newest}/series").where(F.col("run") == run)
            wanted = {r[0] for r in metrics.select(_bucket("run", "metric", buckets)).distinct().collect()}
            held = held.where(F.col("bucket").isin(*wanted) if wanted else F.lit(False))
        parts.append(held.select(columns))
    if tail:
        parts.append(spark.read.schema(schemas.METRIC_LOG).parquet(*tail).select(columns))
    if not parts:
        return spark.createDataFrame([], schemas.METRIC_LOG)
    log = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return log if run is None else log.where(F.col("run") == run)


def compact(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """A new snapshot of all that is there. It counts from when its last table, ``included``, is committed.

    The old snapshot is resolved already, so the work is that of the snapshot and the appends since, not of the whole history.
    """
    newest, included = _snapshot(spark, path)
    tail = _open_appends(spark, path, included)
    if not tail:
        return
    number = int(newest.rsplit("/", 1)[1]) + 1 if newest else 0
    target = f"{path}/snapshots/{number:08d}"
    remove(spark, target)  # of a compaction that broke off
    values = cut_lineage(resolve_resumed(read(spark, path)).withColumn("bucket", _bucket("run", "metric", buckets)))
    placed = values.repartition("bucket", F.pmod(F.xxhash64("step"), F.lit(8))).sortWithinPartitions("bucket", "run", "metric", "step")
    placed.write.partitionBy("bucket").parquet(f"{target}/values")
    values.select("run", "metric").distinct().write.parquet(f"{target}/series")
    names = [(name,) for name in included | {f.rsplit("/", 1)[1] for f in tail}]
    spark.createDataFrame(names, "name STRING").coalesce(1).write.parquet(f"{target}/included")


def vacuum(spark: SparkSession, path: str) -> None:
    """Removes what the newest snapshot replaces. Not while readers of an older one are at work."""
    newest, included = _snapshot(spark, path)
    for folder in children(spark, f"{path}/snapshots") if newest else []:
        if folder.rsplit("/", 1)[1] < newest.rsplit("/", 1)[1]:
            remove(spark, folder)
    for folder in children(spark, f"{path}/appends"):
        if folder.rsplit("/", 1)[1] in included:
            remove(spark, folder)
