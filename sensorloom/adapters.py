"""Shapes general tables like telemetry.

Each shape is one SELECT over `ev` that both Spark and an ANSI engine read the same way, so the
check queries start from the very rows the operators start from.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.times import format_iso

# `ev` for an ANSI engine; `events()` builds the same columns in Spark.
EV_SQL = """
SELECT event_id, user_id, event_type, value,
       date_trunc('millisecond', ts) AS ts,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso
FROM events"""

_SIGNAL_PHASE = "CASE event_id % 3 WHEN 0 THEN 'RED' WHEN 1 THEN 'GREEN' ELSE 'AMBER' END"

SHAPES = {
    "air": """
SELECT event_id, ts, concat('S', user_id) AS sensor_id, concat('Z', user_id % 25) AS zone,
       CAST(value * 0.4 AS DOUBLE) AS pm25, CAST(value * 0.6 AS DOUBLE) AS pm10,
       CAST(value * 0.15 AS DOUBLE) AS no2,
       CASE WHEN event_id % 20 = 0 THEN NULL ELSE CAST(value * 3 AS DOUBLE) END AS aqi
FROM ev""",
    "signals": f"""
SELECT event_id, ts, concat('J', user_id) AS junction_id,
       CASE WHEN event_id % 40 = 7 THEN NULL ELSE concat('Z', user_id % 25) END AS zone,
       CASE WHEN event_id % 30 = 11 THEN NULL ELSE k END AS vehicle_count,
       CASE WHEN event_id % 35 = 13 THEN NULL ELSE value END AS avg_wait_sec,
       {_SIGNAL_PHASE} AS signal_phase
FROM ev""",
    "bus": """
SELECT event_id, ts, event_type AS route_id, concat('B', user_id % 12) AS bus_id,
       CAST(18.85 + k * 0.0005 AS DOUBLE) AS lat,
       CAST(72.70 + (event_id % 10) * 0.0005 AS DOUBLE) AS lon,
       CAST(value - 5 AS DOUBLE) AS speed_kmh, k AS occupancy_pct
FROM ev""",
    "trips": """
SELECT event_id, ts, concat('R', user_id) AS route_id, concat('B', user_id % 12) AS bus_id,
       CAST(value - 5 AS DOUBLE) AS speed_kmh, k AS occupancy_pct
FROM ev""",
    "meters": """
SELECT event_id, ts, concat('M', user_id) AS meter_id, concat('W', user_id % 20) AS ward_id,
       CAST(500 + event_id * 0.5 AS DOUBLE) AS kwh_reading,
       CAST(200 + k * 0.5 AS DOUBLE) AS voltage,
       CASE WHEN event_id % 60 = 17 THEN NULL ELSE CAST(0.7 + k * 0.003 AS DOUBLE) END
           AS power_factor
FROM ev""",
    # Wire messages of all four streams; every 25th block of four carries one kind of fault.
    "envelope": f"""
SELECT event_id, event_type AS key, ts AS timestamp,
       CASE event_id % 4 WHEN 0 THEN 'bus_gps' WHEN 1 THEN 'air_quality'
            WHEN 2 THEN 'traffic_signals' ELSE 'smart_meters' END AS topic,
       CAST(event_id % 6 AS INTEGER) AS partition,
       CAST(floor(event_id / 6) AS BIGINT) AS offset,
       CASE WHEN fault = 5 THEN concat('{{"broken": ', event_id)
            WHEN fault = 8 THEN concat('[', event_id, ']')
            ELSE concat('{{', body, CASE WHEN fault = 6 THEN '"timestamp": "yesterday"'
                 WHEN fault = 4 THEN concat('"timestamp": "2099', substring(iso, 5), '"')
                 WHEN fault = 9 THEN '"timestamp": ""'
                 ELSE concat('"timestamp": "', iso, '"') END, '}}') END AS value
FROM (
  SELECT *,
    CASE event_id % 4
      WHEN 0 THEN concat('"bus_id": "B', user_id % 12, '", "route_id": "', event_type, '", ',
        CASE WHEN fault = 1 THEN '' ELSE concat('"lat": ',
          CASE WHEN fault = 2 THEN '28.61' WHEN fault = 3 THEN '"north"'
               ELSE CAST(CAST(18.85 + k * 0.0005 AS DECIMAL(8,4)) AS STRING) END, ', ') END,
        '"lon": ', CASE WHEN fault = 7 THEN 'null'
               ELSE CAST(CAST(72.70 + (event_id % 10) * 0.0005 AS DECIMAL(8,4)) AS STRING) END,
        ', "speed_kmh": ', CAST(CAST(value - 1 AS DECIMAL(12,2)) AS STRING),
        ', "occupancy_pct": ', k, ', ')
      WHEN 1 THEN concat('"sensor_id": "S', user_id, '", ',
        CASE WHEN fault = 1 THEN '' ELSE concat('"zone": "Z', user_id % 25, '", ') END,
        '"pm25": ', CAST(CAST(value AS DECIMAL(12,2)) AS STRING),
        ', "pm10": ', k, ', "no2": 0.5, "aqi": ',
        CASE WHEN fault = 2 THEN '640.5' WHEN fault = 3 THEN '"high"' WHEN fault = 7 THEN 'null'
             ELSE CAST(CAST(value AS DECIMAL(12,2)) AS STRING) END, ', ')
      WHEN 2 THEN concat('"junction_id": "J', user_id, '", ',
        CASE WHEN fault = 1 THEN '' ELSE concat('"zone": "Z', user_id % 25, '", ') END,
        '"vehicle_count": ', CASE WHEN fault = 2 THEN '-3' WHEN fault = 3 THEN '"many"'
             WHEN fault = 7 THEN 'null' ELSE CAST(k AS STRING) END,
        ', "avg_wait_sec": ', CAST(CAST(value AS DECIMAL(12,2)) AS STRING),
        ', "signal_phase": "', {_SIGNAL_PHASE}, '", ')
      ELSE concat('"meter_id": "M', user_id, '", ',
        CASE WHEN fault = 1 THEN '' ELSE concat('"ward_id": "W', user_id % 20, '", ') END,
        '"kwh_reading": ', event_id, '.5, "voltage": ', 200 + k, ', "power_factor": ',
        CASE WHEN fault = 2 THEN '1.25' WHEN fault = 3 THEN '"good"' WHEN fault = 7 THEN 'null'
             ELSE CAST(CAST(0.7 + k * 0.003 AS DECIMAL(6,3)) AS STRING) END, ', ')
    END AS body
  FROM (SELECT *, CAST(floor(event_id / 4) AS BIGINT) % 25 AS fault FROM ev) numbered
) filled""",
    # Messages of an incident topic: any of three detectors' keys, times missing, empty or in another field, and broken text.
    "incident_messages": """
SELECT event_id, 'incidents' AS topic, CAST(event_id % 3 AS INTEGER) AS partition, event_id AS offset,
  CASE WHEN event_id % 17 = 0 THEN concat('{"incident_type": ', event_id)
       ELSE concat('{"incident_id": "I', event_id, '", "incident_type": "', event_type, '", "severity": "',
    CASE event_id % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'CRITICAL' END, '", "description": "reading ', k, '"',
    CASE event_id % 4 WHEN 0 THEN concat(', "sensor_id": "S', user_id, '"') WHEN 1 THEN concat(', "sensor_id": "", "junction_id": "J', user_id, '"')
         WHEN 2 THEN concat(', "route_id": "R', user_id, '"') ELSE ', "sensor_id": null' END,
    CASE event_id % 5 WHEN 0 THEN concat(', "timestamp": "', iso, '"') WHEN 1 THEN concat(', "timestamp": "", "event_timestamp": "', iso, '"')
         WHEN 2 THEN concat(', "event_timestamp": "', iso, '"') WHEN 3 THEN ', "event_timestamp": ""' ELSE '' END, '}') END AS value
FROM ev""",
    # Status lines of streaming processes, in the forms their programs print.
    "logs": """
SELECT event_id, ts, k, form, big,
  CASE form WHEN 0 THEN 'producer_a' WHEN 1 THEN 'producer_b' WHEN 2 THEN 'priority' WHEN 3 THEN 'standard'
    WHEN 4 THEN 'standard' WHEN 5 THEN 'router' WHEN 6 THEN 'report' WHEN 7 THEN 'enrichment'
    WHEN 8 THEN CASE WHEN k % 3 > 0 THEN 'detector' END WHEN 9 THEN 'batch' WHEN 10 THEN 'standard' ELSE 'producer_b' END AS process,
  CASE form
    WHEN 0 THEN concat('Progress: ', big, ' events sent | Rate: ', k, ' evt/s | Errors: ', k % 7)
    WHEN 1 THEN concat(CASE WHEN k % 2 = 0 THEN 'Progress: ' ELSE 'Status: ' END, big, ' events | Rate: ', k, '/s | Null AQI: ', k % 11, ' (5.0%)')
    WHEN 2 THEN concat('HIGH_PRIORITY Stats | Processed: ', big, ' | Rate: ', k, '/s | Lag: ', k - 1, ' | Latency: 0.1ms')
    WHEN 3 THEN concat('STANDARD Consumer-1 | Processed: ', big, ' | Rate: ', k, '/s | Zones: 4')
    WHEN 4 THEN concat('STANDARD Consumer-2 LAG: Total=', big, ' | Partitions=[P0:1]')
    WHEN 5 THEN concat('DLQ Router | Validated: ', big, ' | Invalid: ', k, ' (0.5%) | DLQ Sent: ', k)
    WHEN 6 THEN concat('Collected ', big, ' DLQ messages (30s / 300s)')
    WHEN 7 THEN concat('Enrichment Status: ', big, ' processed | Joined: ', k, ' | Misses: ', k % 5)
    WHEN 8 THEN '{"incident_type": "AQI_EMERGENCY"}'
    WHEN 9 THEN concat('[Stage ', k, ':====>      (', k % 4, ' + ', k % 3, ') / ', k % 4 + 2, ']')
    WHEN 10 THEN 'Connected to broker'
    ELSE concat('Status: ', big, ' sent | ', k, ' evts/s | Null AQI: 5.0% | Spikes: 4') END AS line
FROM (SELECT *, event_id % 12 AS form, concat(event_id % 9 + 1, ',', lpad(CAST(k AS STRING), 3, '0')) AS big FROM ev) numbered""",
}

# Small tables that describe the keys above, from the other tables of the data set.
DIMENSIONS = {
    "profile": """
SELECT concat('Z', n_nationkey) AS zone, n_name AS zone_name,
       CAST(coalesce(c.n, 0) AS INTEGER) AS population,
       CAST(coalesce(s.n, 0) AS INTEGER) AS num_schools,
       CAST(n_nationkey AS INTEGER) AS num_hospitals
FROM nation
LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey) c
       ON c.c_nationkey = n_nationkey
LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey) s
       ON s.s_nationkey = n_nationkey""",
    # One stop per hour of day in which the route was seen; at most 24 for a route.
    "schedule": """
SELECT route_id, concat('P', stop_sequence) AS stop_id, stop_sequence, scheduled_arrival_time,
       s_name AS route_name, concat('T', s_nationkey) AS terminal, 'UP' AS direction
FROM (SELECT user_id, concat('R', user_id) AS route_id,
             CAST(substring(iso, 12, 2) AS INTEGER) + 1 AS stop_sequence,
             min(substring(iso, 12, 8)) AS scheduled_arrival_time
      FROM ev GROUP BY user_id, substring(iso, 12, 2)) seen
JOIN supplier ON s_suppkey = user_id""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `ev` columns; unused ones are pruned before the scan."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value",
        F.date_trunc("millisecond", ts).alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        format_iso(ts).alias("iso"),
    )


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of SHAPES over the events table."""
    return _over_tables(spark, sf_dir, SHAPES[name])


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of DIMENSIONS."""
    return _over_tables(spark, sf_dir, DIMENSIONS[name])


def _over_tables(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run a SELECT with its table names bound to DataFrames, without registering views."""
    text = text.replace("{", "{{").replace("}", "}}")
    bound = {}
    for name in ("ev", "nation", "customer", "supplier"):
        named = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
        if named != text:
            bound[name] = events(spark, sf_dir) if name == "ev" else table(spark, sf_dir, name)
            text = named
    return spark.sql(text, **bound)


def check_views(*names: str, recursive: bool = False) -> str:
    """WITH clause that defines the named shapes for an ANSI engine."""
    parts = [f"ev AS ({EV_SQL})"]
    parts += [f"{n} AS ({(SHAPES | DIMENSIONS)[n]})" for n in names]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts)
