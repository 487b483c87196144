"""The batch folds on a stream: rows in time order by the slowest source that still speaks, late rows kept, state that expires.

A source is a partition of the topic. Each has a mark, its newest event time less the delay. A row is released when the
lowest mark of the sources that spoke lately has passed it, so a slow partition loses nothing, and a silent one stops
holding the others back after `idle`. Rows behind the mark that was reached before them are late: they go to an output of their own.

What a micro-batch works with are tables in a shared folder, one version per batch: marks, rows that wait, and the
state of each key that can still matter. The folds are those of the batch operators, over slices side by side, so a busy key is
not one task. Alerts and late rows are kept before they are delivered, and a log says what has been delivered: a batch
that is repeated after a failure gives the same rows, and each once.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sensorloom.functions.times import micros
from sensorloom.operators.cooldown import SLICE_COOLDOWNS
from sensorloom.operators.folds import BreachFold, CooldownFold, fold_from, still_needed
from sensorloom.operators.incidents import aqi_alert_rows, gridlock_alert_rows
from sensorloom.sinks.batch_log import BatchLog

MARKS = "source STRING, newest BIGINT, spoke BIGINT, mark BIGINT"


class FoldBatches:
    """A `foreachBatch` function that folds the rows of each key in time order.

    Batches hold `ts`, the tiebreak and the fold's columns; `keys` gives each key's name and value, not null, and `source` names the column
    of the partition. Rows that are not `only` move the marks and are not folded. `alerts(df)` turns rows picked into what `write(df,
    batch_id)` gets; `late(df, batch_id)` gets late rows and rows without a time as they came. `clock` gives the time in seconds, by which
    sources fall silent.
    """

    def __init__(self, folder: str, keys: dict[str, Column], ts: str, tiebreak: list[str], fold, write: Callable[[DataFrame, int], None],
                 late: Callable[[DataFrame, int], None] | None = None, alerts: Callable[[DataFrame], DataFrame] | None = None,
                 only: Column | None = None, source: str = "partition", delay: str = "30 seconds", idle: str = "1 minute", clock: Callable[[], float] = time.time):
        self.folder, self.key_columns, self.keys, self.ts, self.tiebreak, self.fold = folder, keys, list(keys), ts, tiebreak, fold
        self.only = F.lit(True) if only is None else only
        self.write, self.late, self.alerts, self.source = write, late, alerts, source
        self.delay, self.idle, self.clock = micros(delay), micros(idle), clock

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        book = BatchLog(batch.sparkSession, self.folder)
        if book.has(f"{batch_id}-done"):
            return
        if not book.has(f"{batch_id}-kept"):
            batch.persist()
            try:
                self._fold(batch, batch_id, book)
            finally:
                batch.unpersist()
            book.record(f"{batch_id}-kept")
        for name, deliver in (("alerts", self.write), ("late", self.late)):
            if deliver and not book.has(f"{batch_id}-{name}"):
                deliver(book.kept(f"{batch_id}/{name}"), batch_id)
                book.record(f"{batch_id}-{name}")
        book.record(f"{batch_id}-done")
        book.forget(str(batch_id - 1))

    def _marks(self, rows: DataFrame, before: list) -> tuple[list[tuple], int | None, int | None]:
        """(marks of the sources, the mark reached before this batch, the one reached now); a row per topic partition."""
        now = int(self.clock() * 1_000_000)
        known = {r.source: (r.newest, r.spoke) for r in before if r.newest is not None}
        old = before[0].mark if before else None
        for r in rows.groupBy(F.col(self.source).cast("string").alias("source")).agg(F.max("_us").alias("newest")).collect():
            if r.newest is not None:
                known[r.source] = (max(r.newest, known.get(r.source, (r.newest,))[0]), now)
        speaking = [newest for newest, spoke in known.values() if now - spoke <= self.idle]
        reached = min(speaking) - self.delay if speaking else None
        mark = max((m for m in (old, reached) if m is not None), default=None)
        return [(s, newest, spoke, mark) for s, (newest, spoke) in known.items()] or [(None, None, None, mark)], old, mark

    def _fold(self, batch: DataFrame, batch_id: int, book: BatchLog) -> None:
        spark, previous = batch.sparkSession, f"{batch_id - 1}"
        rows = batch.withColumns(self.key_columns | {"_us": F.unix_micros(self.ts)})
        first = not book.has(f"{previous}-kept")
        marks, old, mark = self._marks(rows, [] if first else book.kept(f"{previous}/marks").collect())
        behind = F.col("_us").isNull() if old is None else F.col("_us").isNull() | (F.col("_us") <= old)
        pool = rows.where(~behind & self.only)
        if not first:
            pool = pool.unionByName(book.kept(f"{previous}/waiting"))
        ripe = F.lit(False) if mark is None else F.col("_us") <= mark
        kinds = T.StructType([rows.schema[k] for k in self.keys] + [T.StructField("_state", T.StringType())])
        states = spark.createDataFrame([], kinds) if first else book.kept(f"{previous}/state")
        picked, after = fold_from(pool.where(ripe), self.keys, "_us", self.tiebreak, self.fold.pause * SLICE_COOLDOWNS, self.fold, states,
                                  None if mark is None else mark + 1)
        changed = states.join(after.select(*self.keys), self.keys, "left_anti").unionByName(after)
        picked = picked.drop("_us")
        book.keep(self.alerts(picked) if self.alerts else picked, f"{batch_id}/alerts")
        book.keep(rows.where(behind).drop("_us", *self.keys), f"{batch_id}/late")
        book.keep(pool.where(~ripe), f"{batch_id}/waiting")
        book.keep(changed if mark is None else still_needed(changed, self.fold, mark + 1), f"{batch_id}/state")
        book.keep(spark.createDataFrame(marks, MARKS), f"{batch_id}/marks")


def aqi_emergency_batches(folder: str, write, ts: str = "ts", tiebreak: str = "event_id", threshold: float = 300.0, pause: str = "120 seconds",
                          **options) -> FoldBatches:
    """Air quality alerts; give it all readings, so that quiet ones move the marks too."""
    return FoldBatches(folder, {"_sensor": F.coalesce("sensor_id", F.lit("unknown"))}, ts, [tiebreak], CooldownFold(micros(pause)), write,
                       alerts=lambda rows: aqi_alert_rows(rows, threshold), only=F.col("aqi") > threshold, **options)


def gridlock_batches(folder: str, write, ts: str = "ts", tiebreak: str = "event_id", threshold: float = 180.0, n: int = 3,
                     pause: str = "300 seconds", **options) -> FoldBatches:
    """Congestion alerts."""
    def alerts(rows: DataFrame) -> DataFrame:
        mean = F.aggregate("recent", F.lit(0.0), lambda a, b: a + b) / n
        return gridlock_alert_rows(rows.withColumn("recent_mean", mean), threshold, n)

    return FoldBatches(folder, {"_junction": F.coalesce("junction_id", F.lit("unknown"))}, ts, [tiebreak], BreachFold("avg_wait_sec", threshold, n, micros(pause)), write, alerts=alerts, **options)


def start(rows: DataFrame, batches: FoldBatches, checkpoint: str, name: str, available_now: bool = False) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(batches).option("checkpointLocation", checkpoint).queryName(name)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
