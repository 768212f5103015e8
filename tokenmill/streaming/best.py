"""Best values per run and metric, kept as stream state across restarts: the current best, and a flag for each row."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tokenmill import constants as C

BEST = "run BIGINT, metric STRING, step BIGINT, value DOUBLE"
FLAGS = BEST + ", is_best BOOLEAN, is_saved BOOLEAN"
STRETCH = 1000  # steps in one entry of the state
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def best_so_far(log: DataFrame) -> DataFrame:
    """(run, metric, step, value): the lowest value, at the earliest step it was reached.

    NULL and NaN are never best; a metric without any other value has no row.
    """
    valued = log.where(F.col("value").isNotNull() & ~F.isnan("value"))
    best = valued.groupBy("run", "metric").agg(F.min(F.struct("value", "step")).alias("_best"))
    return best.select("run", "metric", F.col("_best.step").alias("step"), F.col("_best.value").alias("value"))


def track_best(log: DataFrame, target: str, checkpoint: str) -> None:
    """Write every changed best; a repeated batch replaces its own part."""
    _save_batches(best_so_far(log), target, checkpoint)


def _save_batches(rows: DataFrame, target: str, checkpoint: str) -> None:
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    query = (
        rows.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_best(spark: SparkSession, target: str) -> DataFrame:
    """The current best: values only fall, so the lowest written one is the latest."""
    return best_so_far(spark.read.schema(BEST).parquet(target))


class BestFlags(StatefulProcessor):
    """State of one (run, metric): the last step with the lowest value before it, and each step's latest value.

    A row behind the last step is flagged against the lowest value alone. One at or before it comes from a
    resumed run or a late file: it replaces its step's value if it was logged later, and the rows from
    there on whose flags change are given again. A call of the state costs more than a row, so steps that arrive together
    are kept together, as a stretch of [step, value, time, is best] under its first step.
    """

    def __init__(self, eval_every: int, save_every: int, start_step: int):
        self.eval_every, self.save_every, self.start_step = eval_every, save_every, start_step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getValueState("top", "step BIGINT, lowest DOUBLE")
        self.steps = handle.getMapState("stretches", "first BIGINT", "rows STRING")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        newest: dict[int, tuple] = {}
        for row in rows:
            own = row.value, row.logged_at
            if row.step not in newest or _order(row.logged_at, row.value) > _order(*newest[row.step][::-1]):
                newest[row.step] = own
        top = self.top.get()
        last, lowest = (top[0], top[1]) if top else (None, math.inf)
        steps, added = sorted(newest), []
        late = [step for step in steps if last is not None and step <= last]
        if late:
            stretches = {k[0]: json.loads(v[0]) for k, v in self.steps.iterator()}
            held = {row[0]: row for stretch in stretches.values() for row in stretch}
            changed = set()
            for step in late:
                value, logged_at = newest[step]
                row = held.get(step)
                if row is None:
                    row = held[step] = [step, None, None, None]
                    added.append(row)
                elif _order(logged_at, value) <= _order(row[2] and datetime.fromisoformat(row[2]), row[1]):
                    continue
                row[1:] = value, logged_at and logged_at.isoformat(), None
                changed.add(step)
            if changed:
                lowest = math.inf
                for step in sorted(held):
                    row = held[step]
                    best = self._is_best(step, row[1], lowest)
                    lowest = row[1] if best else lowest
                    if step in changed or best != row[3]:
                        row[3] = best
                        changed.add(step)
                        yield self._row(key, step, row[1], best)
                for first, stretch in stretches.items():
                    if any(row[0] in changed for row in stretch):
                        self.steps.updateValue((first,), (json.dumps(stretch),))
        for step in steps[len(late) :]:
            value, logged_at = newest[step]
            best = self._is_best(step, value, lowest)
            added.append([step, value, logged_at and logged_at.isoformat(), best])
            yield self._row(key, step, value, best)
            last, lowest = step, value if best else lowest
        for at in range(0, len(added), STRETCH):
            self.steps.updateValue((added[at][0],), (json.dumps(added[at : at + STRETCH]),))
        if last is not None:
            self.top.update((last, lowest))

    def _is_best(self, step: int, value: float | None, lowest: float) -> bool:
        return step % self.eval_every == 0 and value is not None and value < lowest

    def _row(self, key, step: int, value: float | None, best: bool) -> Row:
        saved = best or (step % self.save_every == 0 and step > self.start_step)
        return Row(run=key[0], metric=key[1], step=step, value=value, is_best=best, is_saved=saved)

    def close(self) -> None:
        pass


def _order(logged_at, value: float | None) -> tuple:
    """Order of logged values as Spark has it: by time, then value, NULL first, NaN last."""
    ranked = (0, 0.0) if value is None else (2, 0.0) if math.isnan(value) else (1, value)
    return (0,) + ranked if logged_at is None else (1, logged_at, *ranked)


def flag_best(
    log: DataFrame, eval_every: int = 1, save_every: int = C.SAVE_EVERY, start_step: int = 0
) -> DataFrame:
    """``best_checkpoints`` of a streamed log (run, step, metric, value, logged_at): a flag for each row as it arrives.

    State is keyed by run and metric and survives restarts; it holds the value of every step, since a resumed run may replace any.
    Needs the RocksDB state store (see ``track_flags``). Later rows of a step replace earlier ones.
    """
    rows = log.select("run", "metric", "step", "value", "logged_at").groupBy("run", "metric")
    return rows.transformWithState(
        statefulProcessor=BestFlags(eval_every, save_every, start_step),
        outputStructType=FLAGS,
        outputMode="Update",
        timeMode="None",
    )


def track_flags(log: DataFrame, target: str, checkpoint: str, **rules) -> None:
    """Write every new or changed flag; a repeated batch replaces its own part."""
    conf, name = log.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, ROCKS_DB)
    try:
        _save_batches(flag_best(log, **rules), target, checkpoint)
    finally:
        conf.set(name, before)


def read_flags(spark: SparkSession, target: str) -> DataFrame:
    """The latest flags of each step."""
    written = spark.read.schema(FLAGS + ", batch_id BIGINT").parquet(target)
    names = ["value", "is_best", "is_saved"]
    latest = written.groupBy("run", "metric", "step").agg(F.max_by(F.struct(*names), "batch_id").alias("_flags"))
    return latest.select("run", "metric", "step", *(f"_flags.{name}" for name in names))
