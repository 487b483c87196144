"""Vehicles near each other: pairs within a distance, and bunching alerts.

Every update of a vehicle is compared with the last known position of the others on its route. A
position is known from its own update to the vehicle's next one, so the comparison is a join of
updates with position intervals:

* on the route, the grid cell and a node of time, which keeps a busy route spread over many tasks and
  leaves out vehicles that are elsewhere or were there at another time;
* then exactly on the interval and the great-circle distance.

Time has levels, each with nodes four times as long as the one below. An interval is filed at the level whose
nodes are just as long as itself, so it lies in two of them at most, whether it lasts a second or a month; an
update looks into its own node of every level that its route uses. A vehicle has only a few intervals of one
level in a node, so what is looked at follows what is found, at any mixture of reporting intervals. Time does not tell
apart what happens within a second, or at one instant; intervals that short are filed alike by the numbers of the updates in
their second, which is right however many there are.

A cell is at least the distance wide, so a position is filed in its own cell and the eight around it. Cells of a
band go round the globe, so the 180th meridian is no border, and a band near a pole is one cell.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.geo import EARTH_RADIUS_M, haversine
from sensorloom.functions.times import micros
from sensorloom.functions.values import pair_key, round_half_up
from sensorloom.operators.cooldown import SLICE_COOLDOWNS
from sensorloom.operators.folds import fold_slices
from sensorloom.operators.incidents import incident_id
from sensorloom.operators.sequence import DEFAULT_SLICE
from sensorloom.operators.slices import SLICE, add_slice, neighbour_keys, ordering, running_number
from sensorloom.sources.staging import materialize

METRES_PER_DEGREE = math.pi * EARTH_RADIUS_M / 180.0
# Above the arc-versus-chord difference for any cell this module makes.
_MARGIN = 1.002


def _band(lat: Column, distance: float) -> Column:
    return F.floor(lat / F.lit(distance * _MARGIN / METRES_PER_DEGREE)).cast("bigint")


def _strip(band: Column, lon: Column, distance: float, step: Column | int = 0) -> Column:
    """Cell number along a band, `step` cells on; a whole number of cells goes round, fewer towards the poles."""
    side = distance * _MARGIN / METRES_PER_DEGREE
    top = (F.abs(band) + 2) * F.lit(side)
    cells = F.when(top >= 89.0, F.lit(1)).otherwise(
        F.greatest(F.floor(F.cos(F.radians(top)) * (360.0 / side)), F.lit(1))).cast("bigint")
    return F.pmod(F.floor((lon + 180.0) / 360.0 * cells).cast("bigint") + step, cells)


def positions(df: DataFrame, route: str = "route_id", bus: str = "bus_id", ts: str = "ts",
              tiebreak: str = "event_id", lat: str = "lat", lon: str = "lon",
              slice_width: str = DEFAULT_SLICE) -> DataFrame:
    """Updates with their number among the bus's updates and the key of the bus's next update."""
    rows = df.where(
        F.col(bus).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(ts).isNotNull()
    ).select(
        F.coalesce(F.col(route), F.lit("unknown")).alias("route"), F.col(bus).alias("bus"),
        F.col(ts).alias("ts"), F.col(tiebreak).alias("id"), F.col(lat).alias("lat"), F.col(lon).alias("lon"),
    )
    keys, order = ["route", "bus"], ["ts", "id"]
    sliced = add_slice(rows, "ts", slice_width)
    # One row per (bus, slice) carries what the slice needs from the others.
    summary = sliced.groupBy(*keys, SLICE).agg(
        F.count("*").alias("_rows"), F.min(F.struct(*order)).alias("_first")
    )
    by_bus = Window.partitionBy(*keys).orderBy(SLICE)
    around = summary.select(
        *keys, SLICE, F.lead("_first").over(by_bus).alias("_next_first"),
        F.coalesce(F.sum("_rows").over(by_bus.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
    )
    w = Window.partitionBy(*keys, SLICE).orderBy(*ordering(order))
    return sliced.join(around, [*keys, SLICE]).select(
        *rows.columns,
        F.coalesce(F.lead(F.struct(*order)).over(w), F.col("_next_first")).alias("next"),
        (F.row_number().over(w) + F.col("_offset")).alias("n"),
    )


PLACE = ["_second", "_at", "_rows"]  # an update's second, its number among the route's updates there, and how many there are


def placed(known: DataFrame) -> DataFrame:
    """Positions with their place in their second."""
    there = Window.partitionBy("route", "_second")
    return known.withColumn("_second", time_node(F.unix_micros("ts"), F.lit(0))).withColumn(
        "_at", F.row_number().over(there.orderBy(*ordering(["ts", "id"])))).withColumn("_rows", F.count("*").over(there))


LEVEL_STEP = 2  # a level's nodes are two to this power as long as those of the level below
FINEST = 1_000_000  # microseconds of a node at level 0


def time_level(length: Column, finest: int = FINEST) -> Column:
    """The lowest level whose nodes are as long as `length`, in microseconds unless `finest`, a node at level 0, is in other units."""
    above = F.ceil(F.log2(F.greatest(length, F.lit(1)) / F.lit(finest)) / LEVEL_STEP)
    return F.greatest(above, F.lit(0)).cast("int")


def time_node(us: Column, level: Column, finest: int = FINEST) -> Column:
    size = F.call_function("shiftleft", F.lit(finest).cast("bigint"), (level * LEVEL_STEP).cast("int"))
    return F.floor((us - F.pmod(us, size)) / size).cast("bigint")


def held_intervals(known: DataFrame, ttl: str | None = None) -> DataFrame:
    """Positions as intervals of time in which they are known: (route, level, from, until, p), one row each.

    The last position of a vehicle is known up to the newest update of its route.
    """
    us = F.unix_micros("ts")
    newest = known.groupBy("route").agg(F.max(us).alias("_end"))
    until = F.coalesce(F.unix_micros("next.ts"), F.col("_end"))
    if ttl is not None:
        until = F.least(until, us + F.lit(micros(ttl)))
    return known.join(newest, "route").select(
        "route", us.alias("_from"), until.alias("_until"), F.struct("bus", "ts", "id", "lat", "lon", "n", "next").alias("p")
    ).withColumn("_level", time_level(F.col("_until") - F.col("_from")))


def filed(held: DataFrame, distance: float) -> DataFrame:
    """Intervals in the nodes and cells at which updates look: two by nine rows for each at most."""
    nodes = F.sequence(time_node(F.col("_from"), F.col("_level")), time_node(F.col("_until"), F.col("_level")))
    return _in_cells(held.select("route", "_level", F.explode(nodes).alias("_node"), "p"), distance)


def _in_cells(held: DataFrame, distance: float) -> DataFrame:
    band, lon = _band(F.col("p.lat"), distance), F.col("p.lon")
    return held.select("*", F.explode(F.array(*[band + d for d in (-1, 0, 1)])).alias("_band")).select(
        "*", F.explode(F.array_distinct(F.array(*[_strip(F.col("_band"), lon, distance, d) for d in (-1, 0, 1)]))).alias("_strip"))


def brief() -> Column:
    """Whether the vehicle's next update comes within a second."""
    return F.coalesce(F.unix_micros("next.ts") - F.unix_micros("ts") <= F.lit(FINEST), F.lit(False))


def brief_intervals(places: DataFrame) -> DataFrame:
    """Brief intervals as the updates of the route between their ends: (route, _second, _low, _high, p, _level).

    One row for each second that they touch, two at most; `_low` and `_high` are numbers of updates there. Intervals without an
    update between their ends have no row.
    """
    after = places.select("route", "bus", (F.col("n") - 1).alias("n"), F.col("_second").alias("_then"), F.col("_at").alias("_next_at"))
    ends = places.where(brief()).join(after, ["route", "bus", "n"])

    def part(second: str, low: Column, high: Column) -> Column:
        return F.struct(F.col(second).alias("_second"), low.cast("long").alias("_low"), high.cast("long").alias("_high"))

    begin, end = F.col("_at") + 1, F.col("_next_at") - 1
    parts = F.when(F.col("_then") == F.col("_second"), F.array(part("_second", begin, end))).otherwise(
        F.array(part("_second", begin, F.col("_rows")), part("_then", F.lit(1), end)))
    cut = ends.select("route", F.struct("bus", "ts", "id", "lat", "lon", "n", "next").alias("p"), F.inline(parts))
    return cut.where(F.col("_low") <= F.col("_high")).withColumn("_level", time_level(F.col("_high") - F.col("_low"), 1))


def brief_candidates(places: DataFrame, distance: float) -> DataFrame:
    """(route, u, p): updates and brief intervals in whose node of updates and cells they are."""
    held = brief_intervals(places)
    nodes = F.sequence(time_node(F.col("_low"), F.col("_level"), 1), time_node(F.col("_high"), F.col("_level"), 1))
    kept = _in_cells(held.select("route", "_second", "_level", F.explode(nodes).alias("_node"), "p"), distance)
    levels = held.groupBy("route", "_second").agg(F.collect_set("_level").alias("_levels"))
    band = _band(F.col("lat"), distance)
    looks = places.join(levels.hint("merge"), ["route", "_second"]).select(
        "route", "_second", F.explode("_levels").alias("_level"), band.alias("_band"), _strip(band, F.col("lon"), distance).alias("_strip"),
        F.struct("bus", "ts", "id", "lat", "lon", "n").alias("u"), "_at"
    ).withColumn("_node", time_node(F.col("_at").cast("long"), F.col("_level"), 1))
    return looks.join(kept.hint("merge"), ["route", "_second", "_level", "_node", "_band", "_strip"]).select("route", "u", "p")


def near_observations(df: DataFrame, distance: float = 200.0, ttl: str | None = None,
                      slice_width: str = DEFAULT_SLICE, **columns: str) -> DataFrame:
    """One row for each (update, other bus of the route) less than `distance` metres apart.

    `step` counts the updates of both buses so far: two observations of a pair with consecutive
    steps have no update between them at which the pair was apart. `ttl` forgets positions; without
    it they are kept until replaced. Positions are staged, which runs a job when the query is built.
    """
    places = materialize(placed(positions(df, slice_width=slice_width, **columns)))
    known = places.drop(*PLACE)
    held = held_intervals(known.where(~brief()), ttl)  # the newest update of a route has none after it, so it is there
    levels = held.groupBy("route").agg(F.collect_set("_level").alias("_levels"))
    band = _band(F.col("lat"), distance)
    looks = known.join(levels, "route").select(
        "route", F.explode("_levels").alias("_level"), band.alias("_band"), _strip(band, F.col("lon"), distance).alias("_strip"),
        F.struct("bus", "ts", "id", "lat", "lon", "n").alias("u")
    ).withColumn("_node", time_node(F.unix_micros("u.ts"), F.col("_level")))
    when = F.struct("u.ts", "u.id")
    holds = (F.struct("p.ts", "p.id") < when) & (F.col("p.next").isNull() | (when < F.col("p.next")))
    if ttl is not None:
        holds = holds & (F.unix_micros("u.ts") - F.unix_micros("p.ts") <= F.lit(micros(ttl)))
    metres = haversine("u.lat", "u.lon", "p.lat", "p.lon")
    # Both sides grow with the data, and size estimates do not see the copies made above; a sorted
    # merge spills and lets adaptive execution split a crowded cell.
    met = looks.join(filed(held, distance).hint("merge"), ["route", "_level", "_node", "_band", "_strip"]).select(
        "route", "u", "p").unionByName(brief_candidates(places, distance)).where(
        (F.col("u.bus") != F.col("p.bus")) & holds & (metres < distance)
    )
    u_first = F.col("u.bus") < F.col("p.bus")
    u_at, p_at = (F.struct(F.col(f"{s}.lat").alias("lat"), F.col(f"{s}.lon").alias("lon")) for s in "up")
    return met.select(
        "route", F.col("u.ts").alias("ts"), F.col("u.id").alias("id"),
        pair_key("u.bus", "p.bus").alias("pair"),
        F.least("u.bus", "p.bus").alias("bus_id_1"), F.greatest("u.bus", "p.bus").alias("bus_id_2"),
        metres.alias("distance_metres"), (F.col("u.n") + F.col("p.n")).alias("step"),
        F.when(u_first, u_at).otherwise(p_at).alias("bus_1_position"),
        F.when(u_first, p_at).otherwise(u_at).alias("bus_2_position"),
    )


def long_meetings(near: DataFrame, duration_us: int, slice_width: str = DEFAULT_SLICE) -> DataFrame:
    """Near observations that belong to a meeting longer than the duration.

    Adds `since`, when the meeting began, and `episode`. Within an unbroken meeting `step` grows by one per observation, so
    step minus position is constant there: it names the meeting. Meetings shorter than the
    duration drop out in the join.
    """
    keys = ["route", "pair"]
    numbered = running_number(add_slice(near, "ts", slice_width), keys, ["step"], "_position").withColumn(
        "episode", F.col("step") - F.col("_position")
    ).drop("_position", SLICE)
    meetings = numbered.groupBy(*keys, "episode").agg(
        F.min("ts").alias("since"), F.max("ts").alias("_until")
    ).where(F.unix_micros("_until") - F.unix_micros("since") > duration_us).drop("_until")
    return numbered.join(meetings, [*keys, "episode"])


class BunchingFold:
    """Which observations of a route alert, in order: the route's pause, and for each pair that alerted its restarted clock.

    The state is the last alert and the clocks that can still hold a row back.
    """

    columns = ("pair", "episode", "_since", "_again")
    extra = T.StructType([])

    def __init__(self, duration_us: int, pause_us: int):
        self.duration, self.pause = duration_us, pause_us

    def start(self):
        return [None, {}]

    def advance(self, state, part: pa.RecordBatch) -> tuple[list[int], list]:
        """The rows that alert, and no columns with them; changes the state."""
        us, hits, i = part.column("_us").to_numpy(), [], 0
        while True:
            if state[0] is not None:
                i = max(i, int(np.searchsorted(us, state[0] + self.pause, side="right")))
            if i >= len(us):
                return hits, []
            pair, episode, began, again = (part.column(c)[i].as_py() for c in self.columns)
            clock = state[1].get(pair)
            if clock and clock[0] == episode:
                began = max(began, clock[1])
            if int(us[i]) - began > self.duration:
                hits.append(i)
                state[0] = int(us[i])
                if again is None:
                    state[1].pop(pair, None)
                else:
                    state[1][pair] = (episode, again)
            i += 1

    def leave(self, state, end_us: int) -> str:
        """The state as rows from `end_us` on see it, as text; states that act alike read alike."""
        last = state[0] if state[0] is not None and end_us - state[0] <= self.pause else None
        return json.dumps([last, {p: c for p, c in sorted(state[1].items()) if end_us - c[1] <= self.duration}])

    def enter(self, text: str):
        return json.loads(text)


def bunching_alerts(near: DataFrame, duration: str = "300 seconds", pause: str = "600 seconds",
                    slice_width: str = DEFAULT_SLICE, route_slice: str = "auto") -> DataFrame:
    """Near observations at which a bunching alert is raised, with `_length` of the meeting.

    A pair must have been together longer than `duration`; the pause is per route, and an alert
    restarts its pair's clock: it runs again from the pair's next observation. The fold over a route
    is `fold_slices` over (route, slice), with a slice many times as long as the pause and the duration.
    """
    d, c = micros(duration), micros(pause)
    width = max(c, d) * SLICE_COOLDOWNS if route_slice == "auto" else micros(route_slice)
    meetings = long_meetings(materialize(near), d, slice_width)
    observed = neighbour_keys(add_slice(meetings, "ts", slice_width), ["route", "pair", "episode"], ["step", "ts"])
    rows = observed.select(
        *near.columns, "episode", F.unix_micros("ts").alias("_us"), F.unix_micros("since").alias("_since"),
        F.unix_micros("_next.ts").alias("_again"),
    ).where(F.col("_us") - F.col("_since") > d)
    alerts = fold_slices(rows, ["route"], "_us", ["id", "pair"], width, BunchingFold(d, c))
    # The clock of a pair that has alerted before in the meeting runs from its next observation.
    meeting = Window.partitionBy("route", "pair", "episode").orderBy("step")
    started = F.coalesce(F.lag("_again").over(meeting), F.col("_since"))
    return alerts.select(*near.columns, (F.col("_us") - started).alias("_length"))


def bunching_alert_rows(alerts: DataFrame, distance: float, duration: str) -> DataFrame:
    return alerts.select(
        incident_id("BUS_BUNCHING", "route", "ts").alias("incident_id"),
        F.lit("BUS_BUNCHING").alias("incident_type"),
        F.lit("MEDIUM").alias("severity"),
        F.col("route").alias("key_id"),
        F.col("route").alias("route_id"),
        "bus_id_1", "bus_id_2",
        round_half_up("distance_metres", 1).alias("distance_metres"),
        round_half_up(F.col("_length") / 1e6, 0).alias("duration_seconds"),
        F.lit(float(distance)).alias("threshold_distance_m"),
        F.lit(micros(duration) / 1e6).alias("threshold_duration_sec"),
        "bus_1_position", "bus_2_position",
        F.col("ts").alias("event_timestamp"),
        F.concat(
            F.lit("BUS BUNCHING on route "), "route", F.lit(": "), "bus_id_1", F.lit(" and "), "bus_id_2",
            F.lit(" are "), round_half_up("distance_metres", 0).cast("bigint").cast("string"),
            F.lit("m apart."),
        ).alias("description"),
    )


def bus_bunching(df: DataFrame, distance: float = 200.0, duration: str = "300 seconds",
                 pause: str = "600 seconds", ttl: str | None = None,
                 slice_width: str = DEFAULT_SLICE, **columns: str) -> DataFrame:
    """Medium alert when two buses of a route stay within `distance` for longer than `duration`."""
    near = near_observations(df, distance, ttl, slice_width, **columns)
    return bunching_alert_rows(bunching_alerts(near, duration, pause, slice_width), distance, duration)
