"""Folds over a key's rows in order, run in slices of time side by side.

A fold's effect on a slice depends on the state it enters with, which only the slices before it know. Here every
slice is run from the empty state first. Then each looks at what the slice before it left: slices that
entered with another state are run again, until none has. The first slice of a key is right after the first
round, the second after the second at the latest, so the end is the fold in order, exactly; and as a state
forgets (a pause passes, a clock runs out), slices many times as long as its memory leave the same state whatever they
entered with, so that a few rounds over a few slices are all there is after the first.

Only one row per (key, slice) is ever ordered by key alone.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sensorloom.operators.cooldown import grouped, record_batch
from sensorloom.operators.slices import SLICE
from sensorloom.sources.staging import materialize

_STATE, _OUT = "_state", "_left"


class CooldownFold:
    """Rows that come more than the pause after the last row picked. The state is that row's time."""

    columns: tuple[str, ...] = ()
    extra: T.StructType = T.StructType([])

    def __init__(self, pause_us: int):
        self.pause = pause_us

    def start(self) -> list:
        return [None]

    def _pick(self, state: list, us: np.ndarray) -> list[int]:
        hits, i = [], 0
        while True:
            if state[0] is not None:
                i = max(i, int(np.searchsorted(us, state[0] + self.pause, side="right")))
            if i >= len(us):
                return hits
            hits.append(i)
            state[0] = int(us[i])
            i += 1

    def advance(self, state: list, part: pa.RecordBatch):
        return self._pick(state, part.column("_us").to_numpy()), []

    def _last(self, state: list, end_us: int) -> int | None:
        return state[0] if state[0] is not None and end_us - state[0] <= self.pause else None

    def leave(self, state: list, end_us: int) -> str:
        return json.dumps([self._last(state, end_us)])

    def enter(self, text: str) -> list:
        return json.loads(text)


class BreachFold(CooldownFold):
    """Rows at which the last `n` values all exceed the threshold, with a pause; missing values are 0.

    `recent` gives the values. The state also has the last n - 1 of them, which no pause makes irrelevant.
    """

    extra = T.StructType([T.StructField("recent", T.ArrayType(T.DoubleType()))])

    def __init__(self, value: str, threshold: float, n: int, pause_us: int):
        super().__init__(pause_us)
        self.columns, self.threshold, self.n = (value,), threshold, n

    def start(self) -> list:
        return [None, []]

    def advance(self, state: list, part: pa.RecordBatch):
        own = pc.fill_null(part.column(self.columns[0]).cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
        values = np.concatenate([np.array(state[1], np.float64), own])
        if len(values) < self.n:
            state[1] = values.tolist()
            return [], [[]]
        runs = np.lib.stride_tricks.sliding_window_view(values, self.n)
        ends = np.arange(len(runs)) + self.n - 1 - len(state[1])  # the row at which each run ends
        over = np.flatnonzero((runs > self.threshold).all(1) & (ends >= 0))
        picked = self._pick(state, part.column("_us").to_numpy()[ends[over]])
        state[1] = values[len(values) - self.n + 1:].tolist() if self.n > 1 else []
        return ends[over][picked].tolist(), [runs[over[picked]].tolist()]

    def leave(self, state: list, end_us: int) -> str:
        return json.dumps([self._last(state, end_us), state[1]])


def _runs(batches, group: list[str], fold):
    """(new, key, entering state as text, its state object, part) for each part of the groups that have an entering state."""
    entered, state, key = None, None, None
    for new, key, part in grouped(batches, group):
        if new:
            entered = part.column(_STATE)[0].as_py()
            if entered is not None:
                state, part = fold.enter(entered) if entered else fold.start(), part.slice(1)
        if entered is not None:
            yield new, key, entered, state, part


def _leave(group: list[str], fold, width: int, until: int | None):
    def left(held) -> tuple:
        end = (held[0][-1] + 1) * width
        return *held[0], held[1], fold.leave(held[2], end if until is None else min(end, until))

    def run(batches):
        out, schema, held = [], None, None
        for new, key, entered, state, part in _runs(batches, group, fold):
            if schema is None:
                schema = pa.schema([*[part.schema.field(c) for c in group], pa.field(_STATE, pa.string()), pa.field(_OUT, pa.string())])
            if new and held is not None:
                out.append(left(held))
                if len(out) >= 20_000:
                    yield record_batch(out, schema)
                    out = []
            held = key, entered, state
            fold.advance(state, part)
        if held is not None:
            out.append(left(held))
        if out:
            yield record_batch(out, schema)

    return run


def _emit(group: list[str], fold, columns: list[str], types: list[pa.DataType]):
    def run(batches):
        for _, _, _, state, part in _runs(batches, group, fold):
            hits, extra = fold.advance(state, part)
            if hits:
                rows = part.select(columns).take(pa.array(hits))
                more = [pa.array(v, t) for v, t in zip(extra, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *more], [*columns, *fold.extra.fieldNames()])

    return run


def fold_slices(rows: DataFrame, keys: list[str], us: str, tiebreak: list[str], width: int, fold) -> DataFrame:
    """Rows that a fold picks, with its extra columns.

    `us` is the time in microseconds, `width` that of a slice; equal times go by `tiebreak`. Keys are not null. A fold has `columns` it
    reads beside the time, `extra` it adds, `start()`, `advance(state, batch)`, which changes the state and gives the rows picked and their extra
    columns, `leave(state, end)`, the state as text for rows from `end` on, and `enter(text)`. Rows are staged and rounds are counted, so jobs
    run when the query is built.
    """
    return fold_from(rows, keys, us, tiebreak, width, fold)[0]


def fold_from(rows: DataFrame, keys: list[str], us: str, tiebreak: list[str], width: int, fold, initial: DataFrame | None = None,
              until: int | None = None) -> tuple[DataFrame, DataFrame]:
    """As `fold_slices`, going on from `initial` (keys, _state); also gives (keys, _state) after the last row of each key of `rows`.

    No row that is to follow may be before `until`.
    """
    group = [*keys, SLICE]
    rows = materialize(rows.withColumn(SLICE, F.floor((F.col(us) - F.pmod(F.col(us), F.lit(width))) / width).cast("bigint")))
    schema = rows.schema
    left_type = T.StructType([*[schema[c] for c in group], T.StructField(_STATE, T.StringType()), T.StructField(_OUT, T.StringType())])

    def in_order(entering: DataFrame, of: DataFrame, columns: list[str]) -> DataFrame:
        both = of.select(*columns, F.lit(None).cast("string").alias(_STATE)).unionByName(
            entering.select(*group, _STATE), allowMissingColumns=True)
        return both.repartition(*group).sortWithinPartitions(*group, F.col(_STATE).isNull(), us, *tiebreak)

    needed = list(dict.fromkeys([*group, us, *tiebreak, *fold.columns]))
    slices = rows.select(*group).distinct()
    if initial is None:
        slices = slices.withColumn("_first", F.lit(""))
    else:
        slices = slices.join(initial.select(*keys, F.col(_STATE).alias("_first")), keys, "left").withColumn("_first", F.coalesce("_first", F.lit("")))
    before = Window.partitionBy(*keys).orderBy(SLICE)
    # The first slice of a key goes on from what was there, the others begin with nothing until they know better.
    slices = materialize(slices.withColumn("_first", F.when(F.row_number().over(before) == 1, F.col("_first")).otherwise("")))
    entering, known, again = slices.withColumnRenamed("_first", _STATE), None, rows
    while True:
        left = in_order(entering, again, needed).mapInArrow(_leave(group, fold, width, until), left_type)
        if known is not None:
            left = known.join(entering.select(*group), group, "left_anti").unionByName(left)
        known = materialize(left)
        seen = known.join(slices, group).withColumn("_sees", F.coalesce(F.lag(_OUT).over(before), F.col("_first")))
        entering = materialize(seen.where(F.col("_sees") != F.col(_STATE)).select(*group, F.col("_sees").alias(_STATE)))
        if entering.isEmpty():
            break
        again = rows.join(entering.select(*group), group, "left_semi")
    types = [f.type for f in to_arrow_schema(fold.extra)]
    picked = in_order(known, rows, rows.columns).mapInArrow(
        _emit(group, fold, rows.columns, types), T.StructType([*schema.fields, *fold.extra.fields])).drop(SLICE)
    return picked, known.groupBy(*keys).agg(F.max_by(_OUT, SLICE).alias(_STATE))


def still_needed(states: DataFrame, fold, end_us: int) -> DataFrame:
    """(keys, _state) as rows from `end_us` on see them, without those that are like having none."""
    nothing = fold.leave(fold.start(), end_us)

    def look(batches):
        for batch in batches:
            now = pa.array([fold.leave(fold.enter(s.as_py()), end_us) for s in batch.column(_STATE)], pa.string())
            at = batch.schema.get_field_index(_STATE)
            yield batch.set_column(at, batch.schema.field(at), now).filter(pc.not_equal(now, nothing))

    return states.mapInArrow(look, states.schema)
