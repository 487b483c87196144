"""Folds of the batch operators run over micro-batches: equal results, silent and slow sources, late rows, lost drivers."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sensorloom.adapters import shape
from sensorloom.operators import incidents
from sensorloom.operators.folds import BreachFold, CooldownFold, fold_slices
from sensorloom.streaming import folding

T0 = 1_767_225_600_000
READING = "sensor_id STRING, zone STRING, aqi DOUBLE, pm25 DOUBLE, pm10 DOUBLE, no2 DOUBLE, ms LONG, event_id LONG, partition INT"


def readings(spark, rows):
    """(sensor, seconds, aqi, id, partition)"""
    full = [(s, "Z", float(a), 1.0, 1.0, 1.0, None if t is None else T0 + int(t * 1000), i, p) for s, t, a, i, p in rows]
    return spark.createDataFrame(full, READING).withColumn("ts", F.timestamp_millis("ms"))


class Out:
    def __init__(self):
        self.alerts, self.late = [], []

    def write(self, df, batch_id):
        self.alerts += df.collect()

    def kept(self, df, batch_id):
        self.late += df.collect()


def seconds(alerts):
    return sorted((r.key_id, r.event_timestamp.timestamp() - T0 / 1000) for r in alerts)


def plain(rows, pause):
    last, out = {}, []
    for s, t, a, _, _ in sorted((r for r in rows if r[2] > 300), key=lambda r: (r[1], r[3])):
        if s not in last or t - last[s] > pause:
            last[s] = t
            out.append((s, t))
    return sorted(out)


def test_batches_equal_the_fold_over_the_table(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(f"S{rnd.randrange(4)}", rnd.randrange(0, 4000), rnd.choice([100, 301, 400]), i, rnd.randrange(3)) for i in range(600)]
    order = sorted(rows, key=lambda r: r[1] + rnd.uniform(0, 20))  # out of order by less than the delay
    out = Out()
    for i in range(6):
        put = folding.aqi_emergency_batches(str(tmp_path), out.write, late=out.kept, clock=lambda: 1000.0)
        put(readings(spark, order[i * 100:i * 100 + 100]), i)
    folding.aqi_emergency_batches(str(tmp_path), out.write, late=out.kept, clock=lambda: 1000.0)(
        readings(spark, [("END", 9000, 1, 10_000 + p, p) for p in range(3)]), 6)
    assert out.late == [] and seconds(out.alerts) == plain(rows, 120)
    want = incidents.aqi_emergency(readings(spark, rows)).collect()
    assert sorted(map(str, out.alerts)) == sorted(map(str, want))


def test_gridlock_batches_equal_the_batch_operator(spark, tmp_path):
    signals = shape(spark, SF_SMALL, "signals").withColumn("partition", (F.col("event_id") % 2).cast("int")).cache()
    bounds = signals.approxQuantile("event_id", [0.0, 0.3, 0.7, 1.0], 0.0)
    out = Out()
    parts = [signals.where((F.col("event_id") >= a) & (F.col("event_id") < b)) for a, b in zip(bounds, [*bounds[1:-1], bounds[-1] + 1])]
    end = signals.limit(2).withColumns({"event_id": F.monotonically_increasing_id() + 10**9, "ts": F.to_timestamp(F.lit("2031-01-01 00:00:00")),
                                        "junction_id": F.lit("END"), "avg_wait_sec": F.lit(0.0)})
    end = end.withColumn("partition", (F.row_number().over(Window.orderBy("event_id")) - 1).cast("int"))
    for i, part in enumerate([*parts, end]):
        folding.gridlock_batches(str(tmp_path), out.write, late=out.kept, threshold=40.0, pause="1 day", clock=lambda: 5.0)(part, i)
    want = incidents.gridlock(signals, threshold=40.0, pause="1 day").collect()
    assert len(want) > 10 and out.late == []
    assert sorted(map(str, out.alerts)) == sorted(map(str, want))


def test_a_slow_source_holds_back_and_a_silent_one_does_not(spark, tmp_path):
    out, now = Out(), [0.0]

    def put(rows, i):
        folding.aqi_emergency_batches(str(tmp_path), out.write, late=out.kept, clock=lambda: now[0])(readings(spark, rows), i)

    put([("A", 0, 400, 1, 0), ("A", 500, 100, 2, 0), ("B", 10, 100, 3, 1)], 0)
    assert out.alerts == []  # source 1 is at second 10
    now[0] = 30.0
    put([("A", 600, 100, 4, 0)], 1)
    assert out.alerts == []
    now[0] = 70.0  # more than a minute since source 1 spoke
    put([("A", 700, 100, 5, 0)], 2)
    assert seconds(out.alerts) == [("A", 0.0)]
    now[0] = 75.0  # it speaks again: its old rows are late, and are kept
    put([("B", 20, 400, 6, 1), ("B", 800, 400, 7, 1), ("A", 1000, 100, 8, 0), ("A", None, 400, 9, 0)], 3)
    assert sorted((r.sensor_id, r.event_id) for r in out.late) == [("A", 9), ("B", 6)]
    put([("B", 2000, 100, 10, 1), ("A", 2000, 100, 11, 0)], 4)
    assert seconds(out.alerts) == [("A", 0.0), ("B", 800.0)]


@pytest.mark.parametrize("lost", ["alerts", "late", "fold"])
def test_lost_driver(spark, tmp_path, lost, monkeypatch):
    rnd = random.Random(2)
    rows = [("S", 10 * i, 400, i, 0) for i in range(120)] + [("S", rnd.randrange(400), 301, 1000 + i, 0) for i in range(20)]
    parts, out, failing = [rows[:60], rows[60:], [("S", 9000, 1, 5000, 0)]], Out(), [True]

    def once(step):
        def run(df, batch_id):
            if lost == step and batch_id == 1 and failing:
                failing.pop()
                raise RuntimeError("lost")
            (out.write if step == "alerts" else out.kept)(df, batch_id)
        return run

    real = folding.still_needed

    def still_needed(*args):
        if lost == "fold" and failing and len(seen) == 1:
            failing.pop()
            raise RuntimeError("lost")
        seen.append(1)
        return real(*args)

    seen = []
    monkeypatch.setattr(folding, "still_needed", still_needed)
    for i, part in enumerate(parts):
        for _ in range(3):  # a batch that failed comes again, one that did not may
            try:
                folding.aqi_emergency_batches(str(tmp_path), once("alerts"), late=once("late"), clock=lambda: 0.0)(readings(spark, part), i)
            except RuntimeError:
                pass
    assert not failing
    released = 590 - 30  # mark after the first batch
    late = [r for r in rows[60:] if r[1] <= released]
    assert sorted(r.event_id for r in out.late) == sorted(r[3] for r in late)
    assert seconds(out.alerts) == plain([r for r in rows if r not in late], 120)


def test_state_of_silent_sensors_expires(spark, tmp_path):
    from sensorloom.sinks.batch_log import BatchLog

    out = Out()
    for i, at in enumerate((0, 5000)):
        rows = [(f"S{k}{i}", at + k, 400, 100 * i + k, 0) for k in range(9)] + [("T", at + 60, 1, 100 * i + 50, 0)]
        folding.aqi_emergency_batches(str(tmp_path), out.write, clock=lambda: 0.0)(readings(spark, rows), i)
    kept = BatchLog(spark, str(tmp_path)).kept("1/state").collect()
    assert len(out.alerts) == 18 and {r._sensor[-1] for r in kept} == {"1"}


def test_folds_over_slices_equal_plain_loops(spark):
    rnd = random.Random(3)
    rows = [(f"K{rnd.randrange(3)}", rnd.randrange(0, 3000) * 1_000_000, rnd.choice([None, 10.0, 200.0, 300.0]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k STRING, _us LONG, v DOUBLE, id LONG").repartition(4)
    for width in (40, 200, 100_000):
        got = fold_slices(df, ["k"], "_us", ["id"], width * 1_000_000, CooldownFold(90_000_000)).collect()
        last, want = {}, []
        for k, t, _, i in sorted(rows, key=lambda r: (r[1], r[3])):
            if k not in last or t - last[k] > 90_000_000:
                last[k] = t
                want.append(i)
        assert sorted(r.id for r in got) == sorted(want)
        got = fold_slices(df, ["k"], "_us", ["id"], width * 1_000_000, BreachFold("v", 100.0, 3, 90_000_000)).collect()
        last, recent, want = {}, {}, []
        for k, t, v, i in sorted(rows, key=lambda r: (r[1], r[3])):
            recent[k] = [*recent.get(k, []), v or 0.0][-3:]
            if len(recent[k]) == 3 and min(recent[k]) > 100 and (k not in last or t - last[k] > 90_000_000):
                last[k] = t
                want.append((i, tuple(recent[k])))
        assert sorted((r.id, tuple(r.recent)) for r in got) == sorted(want)
