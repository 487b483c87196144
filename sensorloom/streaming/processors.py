"""Keyed stateful operators of the incident detectors, for streams.

`OrderedFold` is the extension point: give it the state to open and what to do with one row, and it
takes care of order. In `event_time` order (the default) rows wait in state until the watermark has
passed them and are then released in time order, so the result is that of the batch operator on the
same rows. In `arrival` order each micro-batch is folded as it comes.

A processor sees plain columns and `_us`, the event time in microseconds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from sensorloom.functions.geo import EARTH_RADIUS_M
from sensorloom.functions.times import event_date, micros

ORDERS = ("event_time", "arrival")


class OrderedFold(StatefulProcessor):
    """Fold over the rows of one key in order."""

    def __init__(self, schema: T.StructType, tiebreak: list[str], order: str = "event_time"):
        if order not in ORDERS:
            raise ValueError(f"order must be one of {ORDERS}")
        self.schema, self.order = schema, order
        self.names = schema.fieldNames()
        self.us = self.names.index("_us")
        self.rank = [self.us] + [self.names.index(c) for c in tiebreak]

    # To be given by a detector.
    def open_state(self, handle) -> None:
        raise NotImplementedError

    def begin(self) -> None:
        """Called before the first row of a call, to read state."""

    def fold(self, key: tuple, row: dict) -> Iterator[tuple]:
        raise NotImplementedError

    def end(self) -> None:
        """Called after the last row of a call, to write state."""

    def init(self, handle) -> None:
        self.handle = handle
        if self.order == "event_time":
            self.waiting = handle.getListState("waiting", self.schema)
            self.timer = handle.getValueState("timer", "ms LONG")
        self.open_state(handle)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        values = [tuple(r[c] for c in self.names) for r in rows]
        if self.order == "arrival":
            yield from self._run(key, values)
            return
        self.waiting.appendList(values)
        self._wake_at(values, self.timer.get()[0] if self.timer.exists() else None)

    def _wake_at(self, values: list[tuple], pending: int | None) -> None:
        """Keep one timer per key, at its earliest waiting row."""
        due = min(-(-v[self.us] // 1000) for v in values)
        if pending is None or due < pending:
            self.handle.registerTimer(due)
            self.timer.update((due,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        ready, later = [], []
        for v in self.waiting.get():
            (ready if v[self.us] <= mark else later).append(tuple(v))
        if not ready:
            return
        if later:
            self.waiting.put(later)
            self._wake_at(later, None)
        else:
            self.waiting.clear()
            self.timer.clear()
        yield from self._run(key, ready)

    def _run(self, key, values: list[tuple]) -> Iterator[Row]:
        named = Row(*self.out_names)
        values.sort(key=lambda v: [v[i] for i in self.rank])
        self.begin()
        for v in values:
            for out in self.fold(key, dict(zip(self.names, v))):
                yield named(*out)
        self.end()


class Cooldown(OrderedFold):
    """Pass a row on when more than the pause has gone by since the last one passed on."""

    def __init__(self, schema, tiebreak, pause: str, order: str = "event_time"):
        super().__init__(schema, tiebreak, order)
        self.pause = micros(pause)

    def open_state(self, handle) -> None:
        self.last_alert = handle.getValueState("last_alert", "us LONG")

    def begin(self) -> None:
        self.last = self.last_alert.get()[0] if self.last_alert.exists() else None
        self.before = self.last

    def alerts(self, us: int) -> bool:
        if self.last is not None and us - self.last <= self.pause:
            return False
        self.last = us
        return True

    def fold(self, key, row):
        if self.alerts(row["_us"]):
            yield tuple(row[c] for c in self.names)

    def end(self) -> None:
        if self.last != self.before:
            self.last_alert.update((self.last,))


class ConsecutiveBreach(Cooldown):
    """Alert when the last n values all exceed the threshold, with a cooldown."""

    def __init__(self, schema, tiebreak, value: str, threshold: float, n: int, pause: str,
                 order: str = "event_time"):
        super().__init__(schema, tiebreak, pause, order)
        self.value, self.threshold, self.n = value, threshold, n

    def open_state(self, handle) -> None:
        super().open_state(handle)
        self.recent_values = handle.getValueState("recent", "v ARRAY<DOUBLE>")

    def begin(self) -> None:
        super().begin()
        self.recent = list(self.recent_values.get()[0]) if self.recent_values.exists() else []

    def fold(self, key, row):
        v = row[self.value]
        self.recent = [*self.recent, 0.0 if v is None else float(v)][-self.n:]
        if len(self.recent) == self.n and min(self.recent) > self.threshold and self.alerts(row["_us"]):
            yield (*[row[c] for c in self.names], list(self.recent), sum(self.recent) / self.n)

    def end(self) -> None:
        super().end()
        self.recent_values.update((self.recent,))


def _metres(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    a = (math.sin(math.radians(lat2 - lat1) / 2) ** 2
         + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * EARTH_RADIUS_M * math.atan2(math.sqrt(a), math.sqrt(1 - a))


class Bunching(Cooldown):
    """Alert when two buses of a route stay near each other; state is bounded by the fleet.

    Positions are indexed by latitude band while a call runs. A new position is compared with the
    buses in its own and the neighbouring bands, and with those it is currently paired with.
    """

    def __init__(self, schema, tiebreak, distance: float, duration: str, pause: str,
                 order: str = "event_time"):
        super().__init__(schema, tiebreak, pause, order)
        self.distance, self.duration = distance, micros(duration)
        self.band = math.degrees(distance / EARTH_RADIUS_M) * 1.001

    def open_state(self, handle) -> None:
        super().open_state(handle)
        self.position_of = handle.getMapState("positions", "bus STRING", "lat DOUBLE, lon DOUBLE")
        self.since_of = handle.getMapState("together", "a STRING, b STRING", "us LONG")

    def begin(self) -> None:
        super().begin()
        self.at = {k[0]: (v[0], v[1]) for k, v in self.position_of.iterator()}
        self.since = {tuple(k): v[0] for k, v in self.since_of.iterator()}
        self.old_at, self.old_since = dict(self.at), dict(self.since)
        self.in_band, self.partners = {}, {}
        for bus, (lat, _) in self.at.items():
            self.in_band.setdefault(self._band(lat), set()).add(bus)
        for a, b in self.since:
            self.partners.setdefault(a, set()).add(b)
            self.partners.setdefault(b, set()).add(a)

    def _band(self, lat: float) -> int:
        return math.floor(lat / self.band)

    def _part(self, a: str, b: str) -> None:
        del self.since[min(a, b), max(a, b)]
        self.partners[a].discard(b)
        self.partners[b].discard(a)

    def fold(self, key, row):
        bus, lat, lon, now = row["bus"], row["lat"], row["lon"], row["_us"]
        if bus in self.at:
            self.in_band[self._band(self.at[bus][0])].discard(bus)
        here = self._band(lat)
        self.at[bus] = (lat, lon)
        self.in_band.setdefault(here, set()).add(bus)
        others = set().union(*(self.in_band.get(b, ()) for b in (here - 1, here, here + 1)))
        others |= self.partners.get(bus, set())
        others.discard(bus)
        for other in sorted(others, key=lambda o: f"{min(bus, o)}|{max(bus, o)}"):
            pair = (min(bus, other), max(bus, other))
            away = _metres(lat, lon, *self.at[other])
            if away >= self.distance:
                if pair in self.since:
                    self._part(*pair)
                continue
            if pair not in self.since:
                self.since[pair] = now
                self.partners.setdefault(bus, set()).add(other)
                self.partners.setdefault(other, set()).add(bus)
                continue
            length = now - self.since[pair]
            if length > self.duration and self.alerts(now):
                self._part(*pair)
                at = [dict(zip(("lat", "lon"), self.at[b])) for b in pair]
                yield (row["route"], now, row["id"], *pair, away, *at, length)

    def end(self) -> None:
        super().end()
        for bus, p in self.at.items():
            if self.old_at.get(bus) != p:
                self.position_of.updateValue((bus,), p)
        for pair, us in self.since.items():
            if self.old_since.get(pair) != us:
                self.since_of.updateValue(pair, (us,))
        for pair in self.old_since.keys() - self.since.keys():
            self.since_of.removeKey(pair)


def _payload(df: DataFrame, ts: str, columns: list[str]) -> DataFrame:
    """Columns for a processor, and the event time column that carries the watermark."""
    return df.where(F.col(ts).isNotNull()).select(F.col(ts), *columns, F.unix_micros(ts).alias("_us"))


def _schema(df: DataFrame, columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(df.schema[c].name, df.schema[c].dataType) for c in [*columns, "_us"]])


def _apply(df: DataFrame, keys: list[str], processor: OrderedFold, out: T.StructType) -> DataFrame:
    processor.out_names = out.fieldNames()
    mode = "EventTime" if processor.order == "event_time" else "None"
    folded = df.groupBy(*keys).transformWithState(processor, out, "Append", mode)
    return folded.withColumn("ts", F.timestamp_micros("_us")).drop("_us")


def cooldown_stream(df: DataFrame, keys: list[str], ts: str, pause: str, tiebreak: list[str],
                    columns: list[str], order: str = "event_time") -> DataFrame:
    """Rows that alert; `columns` are passed through, the event time comes out as `ts`."""
    rows = _payload(df, ts, columns)
    schema = _schema(rows, columns)
    return _apply(rows, keys, Cooldown(schema, tiebreak, pause, order), schema)


class RunningWindow(StatefulProcessor):
    """A window's figures as they stand after each of its rows, and once more when the watermark has passed its end.

    Rows of a call are taken in time order; nothing waits. The state is five numbers, and goes with the last row.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.figures = handle.getValueState("figures", "n LONG, low DOUBLE, high DOUBLE, power_factors DOUBLE, peak DOUBLE")

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key, event_id, us, f) -> Row:
        return Row("ward_id", "window_start", "window_end", "event_id", "_us", "total_kwh_consumed", "avg_power_factor", "peak_voltage", "final")(
            key[0], key[1], key[2], event_id, us, f[2] - f[1], f[3] / f[0], f[4], event_id is None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        f = tuple(self.figures.get()) if self.figures.exists() else None
        if f is None:
            self.handle.registerTimer(key[2] // 1000)
        for r in sorted(rows, key=lambda r: (r["_us"], r["event_id"])):
            kwh, voltage = float(r["kwh_reading"]), float(r["voltage"])
            n, low, high, power_factors, peak = f or (0, kwh, kwh, 0.0, voltage)
            f = n + 1, min(low, kwh), max(high, kwh), power_factors + float(r["power_factor"]), max(peak, voltage)
            yield self._row(key, r["event_id"], r["_us"], f)
        self.figures.update(f)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.figures.exists():
            yield self._row(key, None, key[2], tuple(self.figures.get()))
            self.figures.clear()


def ward_running_stream(meters: DataFrame, ts: str = "ts", width: str = "15 minutes") -> DataFrame:
    """The ward rollup after every single event, and a final row per window: `event_id` is null and `final` true there.

    As `rollups.ward_running` on the same rows, as long as no batch holds rows before those of an earlier one in the same window.
    """
    columns = ["ward_id", "kwh_reading", "power_factor", "voltage"]
    whole = meters
    for c in columns:
        whole = whole.where(F.col(c).isNotNull())
    bounds = F.window(ts, width)
    rows = _payload(whole, ts, [*columns, "event_id"]).select(
        "*", F.unix_micros(bounds["start"]).alias("_start"), F.unix_micros(bounds["end"]).alias("_end"))
    out = T.StructType.fromDDL("ward_id STRING, window_start LONG, window_end LONG, event_id LONG, _us LONG, total_kwh_consumed DOUBLE, "
                               "avg_power_factor DOUBLE, peak_voltage DOUBLE, final BOOLEAN")
    emitted = rows.groupBy("ward_id", "_start", "_end").transformWithState(RunningWindow(), out, "Append", "EventTime")
    return emitted.select(
        "ward_id", F.timestamp_micros("window_start").alias("window_start"), F.timestamp_micros("window_end").alias("window_end"), "event_id",
        F.timestamp_micros("_us").alias("ts"), event_date(F.timestamp_micros("window_start")).alias("date"),
        "total_kwh_consumed", "avg_power_factor", "peak_voltage", F.lit("SPEED").alias("source_layer"), "final")


def aqi_emergency_stream(air: DataFrame, ts: str = "ts", tiebreak: str = "event_id",
                         threshold: float = 300.0, pause: str = "120 seconds",
                         order: str = "event_time") -> DataFrame:
    from sensorloom.operators.incidents import aqi_alert_rows

    # The condition names the event time so that it stays above the watermark: readings below the
    # threshold must move the watermark too, or alerts would wait for the next breach.
    over = air.where(F.when(F.col(ts).isNotNull(), F.col("aqi") > threshold)).withColumn(
        "_sensor", F.coalesce("sensor_id", F.lit("unknown")))
    # State needs a key; the alert keeps the id as it came.
    columns = list(dict.fromkeys(["_sensor", "sensor_id", "zone", "aqi", "pm25", "pm10", "no2", tiebreak]))
    return aqi_alert_rows(cooldown_stream(over, ["_sensor"], ts, pause, [tiebreak], columns, order), threshold)


def gridlock_stream(signals: DataFrame, ts: str = "ts", tiebreak: str = "event_id",
                    threshold: float = 180.0, n: int = 3, pause: str = "300 seconds",
                    order: str = "event_time") -> DataFrame:
    from sensorloom.operators.incidents import gridlock_alert_rows

    columns = list(dict.fromkeys(
        ["_junction", "junction_id", "zone", "vehicle_count", "avg_wait_sec", "signal_phase", tiebreak]))
    named = signals.withColumn("_junction", F.coalesce("junction_id", F.lit("unknown")))
    rows = _payload(named, ts, columns)
    schema = _schema(rows, columns)
    out = T.StructType([*schema.fields, T.StructField("recent", T.ArrayType(T.DoubleType())),
                        T.StructField("recent_mean", T.DoubleType())])
    processor = ConsecutiveBreach(schema, [tiebreak], "avg_wait_sec", threshold, n, pause, order)
    return gridlock_alert_rows(_apply(rows, ["_junction"], processor, out), threshold, n)


def bus_bunching_stream(buses: DataFrame, ts: str = "ts", tiebreak: str = "event_id",
                        distance: float = 200.0, duration: str = "300 seconds",
                        pause: str = "600 seconds", order: str = "event_time") -> DataFrame:
    from sensorloom.operators.proximity import bunching_alert_rows

    known = buses.where(F.col("bus_id").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    rows = _payload(
        known.select(ts, F.coalesce("route_id", F.lit("unknown")).alias("route"), F.col("bus_id").alias("bus"),
                     "lat", "lon", F.col(tiebreak).alias("id")),
        ts, ["route", "bus", "lat", "lon", "id"],
    )
    schema = _schema(rows, ["route", "bus", "lat", "lon", "id"])
    point = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])
    out = T.StructType([
        schema["route"], schema["_us"], schema["id"], T.StructField("bus_id_1", T.StringType()),
        T.StructField("bus_id_2", T.StringType()), T.StructField("distance_metres", T.DoubleType()),
        T.StructField("bus_1_position", point), T.StructField("bus_2_position", point),
        T.StructField("_length", T.LongType()),
    ])
    processor = Bunching(schema, ["id"], distance, duration, pause, order)
    return bunching_alert_rows(_apply(rows, ["route"], processor, out), distance, duration)
