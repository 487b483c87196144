"""Threshold and congestion detectors, and the common incident row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom import schemas
from sensorloom.functions.values import round_half_up
from sensorloom.operators.cooldown import cooldown
from sensorloom.operators.sequence import DEFAULT_SLICE, consecutive_breach


def incident_id(kind: str, key: str, ts: str):
    return F.hex(F.xxhash64(F.lit(kind), F.col(key), F.col(ts)))


def aqi_alert_rows(hits: DataFrame, threshold: float, ts: str = "ts") -> DataFrame:
    """Alert columns for readings that alerted; batch and streaming share them."""
    return hits.select(
        incident_id("AQI_EMERGENCY", "sensor_id", ts).alias("incident_id"),
        F.lit("AQI_EMERGENCY").alias("incident_type"),
        F.lit("CRITICAL").alias("severity"),
        F.col("sensor_id").alias("key_id"),
        "sensor_id", "zone",
        F.col("aqi").alias("aqi_value"),
        "pm25", "pm10", "no2",
        F.lit(float(threshold)).alias("threshold"),
        F.col(ts).alias("event_timestamp"),
        F.concat(
            F.lit("HAZARDOUS AQI ("), F.round("aqi", 0).cast("bigint").cast("string"),
            F.lit(") detected at sensor "), F.coalesce("sensor_id", F.lit("None")),
            F.lit(" in "), F.coalesce("zone", F.lit("None")), F.lit("."),
        ).alias("description"),
    )


def aqi_emergency(air: DataFrame, ts: str = "ts", tiebreak: str = "event_id",
                  threshold: float = 300.0, pause: str = "120 seconds",
                  slice_width: str | None = "auto") -> DataFrame:
    """Critical alert on a reading above the threshold, with a cooldown per sensor."""
    over = air.where(F.col("aqi") > threshold)
    hits = cooldown(over, ["sensor_id"], ts, pause, [tiebreak], slice_width)
    return aqi_alert_rows(hits, threshold, ts)


def gridlock_alert_rows(hits: DataFrame, threshold: float, n: int, ts: str = "ts") -> DataFrame:
    return hits.select(
        incident_id("TRAFFIC_GRIDLOCK", "junction_id", ts).alias("incident_id"),
        F.lit("TRAFFIC_GRIDLOCK").alias("incident_type"),
        F.lit("HIGH").alias("severity"),
        F.col("junction_id").alias("key_id"),
        "junction_id", "zone",
        F.lit(n).alias("consecutive_cycles"),
        F.col("recent").alias("wait_times"),
        round_half_up("recent_mean", 1).alias("average_wait_sec"),
        F.lit(float(threshold)).alias("threshold"),
        "vehicle_count", "signal_phase",
        F.col(ts).alias("event_timestamp"),
        F.concat(
            F.lit("GRIDLOCK at junction "), F.coalesce("junction_id", F.lit("None")),
            F.lit(" in "), F.coalesce("zone", F.lit("None")), F.lit(". Average wait "),
            round_half_up("recent_mean", 0).cast("bigint").cast("string"),
            F.lit(f"s over {n} cycles."),
        ).alias("description"),
    )


def gridlock(signals: DataFrame, ts: str = "ts", tiebreak: str = "event_id",
             threshold: float = 180.0, n: int = 3, pause: str = "300 seconds",
             breach_slice: str = DEFAULT_SLICE, slice_width: str | None = "auto") -> DataFrame:
    """High alert when the last n waits of a junction all exceed the threshold, with a cooldown."""
    runs = consecutive_breach(signals, ["junction_id"], [ts, tiebreak], "avg_wait_sec", threshold,
                              n, ts, breach_slice)
    hits = cooldown(runs, ["junction_id"], ts, pause, [tiebreak], slice_width)
    return gridlock_alert_rows(hits, threshold, n, ts)


def as_incidents(alerts: DataFrame) -> DataFrame:
    """Bring alerts of one kind to the common incident columns."""
    present = set(alerts.columns)
    fields = T.StructType.fromDDL(schemas.INCIDENT).fields
    return alerts.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fields
    ])


def incident_feed(*alerts: DataFrame) -> DataFrame:
    """One feed of all incident kinds; columns of the other kinds are null."""
    return reduce(lambda a, b: a.unionByName(b), [as_incidents(a) for a in alerts])
