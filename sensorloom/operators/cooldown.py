"""Alert cooldown: emit a row when nothing was emitted for its key in the last c time units.

Whether a row alerts depends on the previous alert, not the previous row, so this is a fold and
not a window frame. A fold in one task per key would put a hot key's rows through one task. Time
is therefore cut into slices of many cooldowns, and the fold runs in three steps:

1. Per (key, slice): which last alert the slice ends with, for every alert it could begin with.
   Whatever happened before, only a row within c of the slice's first row, or the next one after,
   can be its first alert; beginnings with the same ending are one line, so the table is short.
2. Per key: walk those tables in slice order, which gives the alert that precedes each slice.
3. Per (key, slice): emit the alerts, starting from that alert.

Steps 1 and 3 are spread over (key, slice); step 2 reads only the tables. Rows pass through Python
as Arrow batches, and a step jumps from alert to alert with a binary search in each batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.times import micros, slice_number
from sensorloom.operators.slices import SLICE
from sensorloom.sources.staging import materialize

SLICE_COOLDOWNS = 64

_US, _CARRY = "_us", "_carried"


def group_starts(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """Positions at which a new group begins in a batch sorted by `columns`; always holds 0."""
    changed = np.zeros(batch.num_rows, dtype=bool)
    changed[:1] = True
    for name in columns:
        col = batch.column(name)
        if batch.num_rows > 1:
            a, b = col.slice(1), col.slice(0, batch.num_rows - 1)
            differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
            changed[1:] |= differ.to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed)


def grouped(batches: Iterator[pa.RecordBatch], columns: list[str]):
    """Yield (is_new_group, part of a batch that lies within one group) in order."""
    previous = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        starts = group_starts(batch, columns)
        for begin, end in zip(starts, [*starts[1:], batch.num_rows]):
            part = batch.slice(begin, end - begin)
            key = tuple(part.column(c)[0].as_py() for c in columns)
            yield previous is None or key != previous, key, part
            previous = key


def exit_tables(group: list[str], cooldown: int):
    """Step 1. Emits (group, entry, exit): beginning at `entry` or at an earlier row not listed
    separately, the group's last alert is `exit`."""

    def flush(key, state, out):
        entries, origin, last = state
        exits = last[origin]
        keep = np.append(exits[1:] != exits[:-1], True)
        for e, x in zip(entries[keep], exits[keep]):
            out.append((*key, int(e), int(x)))

    def run(batches):
        state, current, out, schema, horizon = None, None, [], None, 0
        for new, key, part in grouped(batches, group):
            if schema is None:
                schema = pa.schema([*[part.schema.field(c) for c in group],
                                    pa.field("entry", pa.int64()), pa.field("exit", pa.int64())])
            if new:
                if state is not None:
                    flush(current, state, out)
                state, current = None, key
                if len(out) >= 50_000:
                    yield record_batch(out, schema)
                    out = []
            t = np.unique(part.column(_US).to_numpy())
            if new:
                horizon = int(t[0]) + cooldown
            state = _advance(state, t, horizon, cooldown)
        if state is not None:
            flush(current, state, out)
        if out:
            yield record_batch(out, schema)

    return run


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _advance(state, t: np.ndarray, horizon: int, cooldown: int):
    """Follow every possible beginning through the sorted distinct times `t`.

    State: the beginnings, for each the index of the course it has joined, and each course's last
    alert. Courses that alert on the same row are one from then on. The last possible beginning is
    the first row past the horizon: an earlier alert holds back no later row.
    """
    if state is None:
        entries, origin, last = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    else:
        entries, origin, last = state
    if not len(entries) or entries[-1] <= horizon:
        fresh = t[:np.searchsorted(t, horizon, side="right") + 1]
        if len(entries):
            fresh = fresh[fresh > entries[-1]]
        origin = np.concatenate([origin, len(last) + np.arange(len(fresh))])
        entries, last = np.concatenate([entries, fresh]), np.concatenate([last, fresh])
    while True:
        nxt = np.searchsorted(t, last + cooldown, side="right")
        moving = nxt < len(t)
        if not moving.any():
            break
        last = np.where(moving, t[np.minimum(nxt, len(t) - 1)], last)
        last, joined = np.unique(last, return_inverse=True)
        origin = joined[origin]
    return entries, origin, last


def _walk(keys: list[str], cooldown: int):
    """Step 2. Emits (keys, slice, carried): the last alert before the slice."""

    def run(batches):
        last, done, out, schema = None, True, [], None
        current = None
        for new, key, part in grouped(batches, [*keys, SLICE]):
            if schema is None:
                schema = pa.schema([*[part.schema.field(c) for c in [*keys, SLICE]],
                                    pa.field(_US, pa.int64())])
            if current is None or key[:-1] != current:
                last, current = None, key[:-1]
            if new:
                done = False
                if last is not None:
                    out.append((*key, last))
                    if len(out) >= 50_000:
                        yield record_batch(out, schema)
                        out = []
            if not done:
                entry = part.column("entry").to_numpy()
                i = 0 if last is None else int(np.searchsorted(entry, last + cooldown, side="right"))
                if i < len(entry):
                    last, done = int(part.column("exit")[i].as_py()), True
        if out:
            yield record_batch(out, schema)

    return run


def emit_alerts(group: list[str], cooldown: int, columns: list[str], ruled: bool = False):
    """Step 3. A group starts with its carried row, if it has one.

    With `ruled`, a group may go on with one row that an earlier step has ruled on: flagged
    `_ruled`, it alerts if the carried row says so (`_alerts`), and never otherwise.
    """

    def run(batches):
        last, verdict = None, False
        for new, _, part in grouped(batches, group):
            if new:
                last, verdict = None, False
            t = part.column(_US).to_numpy(zero_copy_only=False)
            i, hits = 0, []
            if part.column(_CARRY)[0].as_py():
                last = part.column(_US)[0].as_py()
                verdict = ruled and part.column("_alerts")[0].as_py()
                i = 1
            if ruled and i < len(t) and part.column("_ruled")[i].as_py():
                if verdict:
                    hits.append(i)
                i += 1
            while i < len(t):
                if last is not None:
                    i += int(np.searchsorted(t[i:], last + cooldown, side="right"))
                    if i >= len(t):
                        break
                hits.append(i)
                last = int(t[i])
                i += 1
            if hits:
                yield part.select(columns).take(pa.array(hits))

    return run


def cooldown(df: DataFrame, keys: list[str], ts: str, pause: str, tiebreak: list[str],
             slice_width: str | None = "auto") -> DataFrame:
    """Rows that alert: no earlier alert of the key, or more than `pause` after it (strict).

    Equal times are taken in `tiebreak` order. Filter to candidate rows first: they are staged, which runs a job when
    the query is built. `slice_width=None`
    folds each key in one task, which is right for keys known to be small.
    """
    c = micros(pause)
    columns = df.columns
    rows = df.where(F.col(ts).isNotNull()).withColumn(_US, F.unix_micros(ts))
    if slice_width is None:
        group = keys
        ready = rows.withColumn(_CARRY, F.lit(False))
    else:
        width = c * SLICE_COOLDOWNS if slice_width == "auto" else micros(slice_width)
        if width < c:
            raise ValueError("a slice must not be shorter than the pause")
        group = [*keys, SLICE]
        # Both steps over (key, slice) read the candidates; what makes them must not run twice.
        rows = materialize(rows.withColumn(SLICE, slice_number(ts, width)))
        table_type = T.StructType(
            [rows.schema[k] for k in group]
            + [T.StructField("entry", T.LongType()), T.StructField("exit", T.LongType())]
        )
        tables = (
            rows.select(*group, _US).repartition(*group).sortWithinPartitions(*group, _US)
            .mapInArrow(exit_tables(group, c), table_type)
        )
        carry_type = T.StructType([rows.schema[k] for k in group] + [T.StructField(_US, T.LongType())])
        carried = (
            tables.repartition(*keys).sortWithinPartitions(*group, "entry")
            .mapInArrow(_walk(keys, c), carry_type)
        )
        ready = rows.withColumn(_CARRY, F.lit(False)).unionByName(
            carried.withColumn(_CARRY, F.lit(True)), allowMissingColumns=True
        )
    ordered = ready.repartition(*group).sortWithinPartitions(
        *group, F.col(_CARRY).desc(), _US, *tiebreak
    )
    return ordered.mapInArrow(emit_alerts(group, c, columns), df.schema)
