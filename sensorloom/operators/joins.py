"""Lookups against reference tables, and the offset match.

No join carries a broadcast hint. Spark broadcasts a side when its measured size is under
`spark.sql.autoBroadcastJoinThreshold` (re-checked from shuffle statistics by adaptive execution)
and otherwise sorts and merges, splitting a hot key's partition; a dimension that outgrows the
threshold therefore changes the plan, not the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What an event on an unknown route carries.
UNKNOWN = {
    "route_name": "UNKNOWN_ROUTE",
    "terminal": "UNKNOWN_TERMINAL",
    "scheduled_arrival_time": "N/A",
}


def enrich_inner(stream: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner equi join with a static table; rows without a match drop out."""
    return stream.join(dim, key)


def nest_schedule(schedule: DataFrame, route: str = "route_id", seq: str = "stop_sequence",
                  time: str = "scheduled_arrival_time") -> DataFrame:
    """One row per route: the first stop's metadata, sorted distinct times, and the stop list.

    Bounded by the timetable, not by traffic: stop sequences are unique within a route and a time
    of day has at most 86,400 values.
    """
    first = F.min_by(F.struct("route_name", "terminal", "direction", time), seq).alias("first")
    stops = F.array_sort(F.collect_list(F.struct(seq, "stop_id", time))).alias("stops")
    times = F.array_sort(F.collect_set(time)).alias("times")
    return schedule.groupBy(route).agg(first, stops, times).select(
        route,
        F.col("first.route_name").alias("route_name"),
        F.col("first.terminal").alias("terminal"),
        F.col("first.direction").alias("direction"),
        F.col(f"first.{time}").alias("first_time"),
        "times", "stops",
    )


def next_scheduled(now: Column, times: str = "times", first_time: str = "first_time") -> Column:
    """Smallest scheduled time of day at or after `now`; past the last one, the first stop's."""
    later = F.filter(F.col(times), lambda t: t >= now)
    return F.coalesce(F.try_element_at(later, F.lit(1)), F.col(first_time))


def enrich_route(events: DataFrame, nested: DataFrame, now: Column, route: str = "route_id") -> DataFrame:
    """Left lookup of the nested schedule, with defaults for routes it does not know.

    `matched` tells hits from misses and feeds the hit rate.
    """
    dim = nested.select(route, "route_name", "terminal", "times", "first_time")
    joined = events.join(dim, route, "left")
    return joined.select(
        *[F.col(c) for c in events.columns],
        F.coalesce("route_name", F.lit(UNKNOWN["route_name"])).alias("route_name"),
        F.coalesce("terminal", F.lit(UNKNOWN["terminal"])).alias("terminal"),
        F.when(F.col("first_time").isNull(), F.lit(UNKNOWN["scheduled_arrival_time"]))
        .otherwise(next_scheduled(now)).alias("scheduled_arrival_time"),
        F.col("first_time").isNotNull().alias("matched"),
    )


def offsets_against_heads(heads: DataFrame, committed: DataFrame, keys: list[str]) -> DataFrame:
    """Committed offset beside the head of each partition; never committed counts as 0."""
    joined = heads.join(committed, keys, "left")
    return joined.withColumn("committed", F.greatest(F.lit(0), F.coalesce("committed", F.lit(0))))
