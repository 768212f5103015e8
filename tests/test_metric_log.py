import os
import random

from pyspark.sql import functions as F

from tokenmill.operators import metrics
from tokenmill.sources import metric_log


def _rows(spark, rng, n):
    rows = [(rng.randrange(4), rng.randrange(30), rng.choice("ab"), rng.choice([None, rng.random()]), rng.randrange(99)) for _ in range(n)]
    log = spark.createDataFrame(rows, "run bigint, step bigint, metric string, value double, t int")
    return log.selectExpr("run", "step", "metric", "value", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,t) as logged_at")


def _resolved(log):
    return sorted(str(r) for r in metrics.resolve_resumed(log).collect())


def _latest(log):
    return sorted(str(r) for r in metrics.metric_latest(metrics.resolve_resumed(log)).collect())


def test_snapshot_and_tail_equal_the_full_log(spark, tmp_path):
    rng, path, parts = random.Random(2), f"{tmp_path}/log", []
    assert metric_log.read(spark, path).count() == 0
    metric_log.compact(spark, path)
    for k in range(100):
        part = _rows(spark, rng, 6)
        parts.append(part)
        metric_log.append(part, path)
        if k in (20, 21, 70):
            metric_log.compact(spark, path)
        if k == 70:
            metric_log.vacuum(spark, path)
    whole = spark.createDataFrame([r for p in parts for r in p.collect()], parts[0].schema)
    found = metric_log.read(spark, path)
    assert _resolved(found) == _resolved(whole) and _latest(found) == _latest(whole)
    assert found.count() < whole.count()
    assert len(os.listdir(f"{path}/appends")) < 40 and len([d for d in os.listdir(f"{path}/snapshots") if not d.startswith(".")]) == 1
    one = metric_log.read(spark, path, run=2)
    assert _resolved(one) == _resolved(whole.where("run = 2"))


def test_a_compaction_that_broke_off_counts_for_nothing(spark, tmp_path):
    rng, path = random.Random(3), f"{tmp_path}/log"
    first, second = (_rows(spark, rng, 9) for _ in range(2))
    metric_log.append(first, path)
    metric_log.compact(spark, path)
    metric_log.append(second, path)
    first.withColumn("bucket", F.lit(0)).write.parquet(f"{path}/snapshots/00000001/values")  # no list of what it includes
    whole = first.union(second)
    assert _resolved(metric_log.read(spark, path)) == _resolved(whole)
    metric_log.compact(spark, path)
    assert _resolved(metric_log.read(spark, path)) == _resolved(whole)
