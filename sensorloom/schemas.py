"""Row types of the telemetry streams and of the tables derived from them.

Schemas are DDL strings: `from_json`, `spark.read.schema` and `readStream.schema` all take them.
"""

from __future__ import annotations

# What a topic reader delivers. A file of such rows stands in for a broker in tests.
ENVELOPE = (
    "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

BUS_GPS = (
    "bus_id STRING, route_id STRING, lat DOUBLE, lon DOUBLE, speed_kmh DOUBLE, "
    "occupancy_pct INT, timestamp STRING"
)
AIR_QUALITY = (
    "sensor_id STRING, zone STRING, pm25 DOUBLE, pm10 DOUBLE, no2 DOUBLE, aqi DOUBLE, "
    "timestamp STRING"
)
TRAFFIC_SIGNALS = (
    "junction_id STRING, zone STRING, vehicle_count INT, avg_wait_sec DOUBLE, "
    "signal_phase STRING, timestamp STRING"
)
SMART_METERS = (
    "meter_id STRING, ward_id STRING, kwh_reading DOUBLE, voltage DOUBLE, power_factor DOUBLE, "
    "timestamp STRING"
)

WIRE = {
    "bus_gps": BUS_GPS,
    "air_quality": AIR_QUALITY,
    "traffic_signals": TRAFFIC_SIGNALS,
    "smart_meters": SMART_METERS,
}

ZONE_PROFILE = (
    "zone STRING, zone_name STRING, population INT, num_schools INT, num_hospitals INT, "
    "area_sq_km DOUBLE"
)
ROUTE_SCHEDULE = (
    "route_id STRING, stop_id STRING, stop_sequence INT, scheduled_arrival_time STRING, "
    "route_name STRING, terminal STRING, direction STRING"
)

WARD_SUMMARY = (
    "window_start TIMESTAMP, window_end TIMESTAMP, ward_id STRING, date STRING, "
    "total_kwh_consumed DOUBLE, avg_power_factor DOUBLE, peak_voltage DOUBLE, source_layer STRING"
)

DEAD_LETTER = (
    "source_topic STRING, source_partition INT, source_offset BIGINT, original_message STRING, "
    "error_count INT, errors ARRAY<STRUCT<error_type: STRING, error_message: STRING>>, "
    "error_reason STRING, dlq_timestamp TIMESTAMP"
)

# One superset for the three detectors; columns of the other types are null.
INCIDENT = (
    "incident_id STRING, incident_type STRING, severity STRING, key_id STRING, zone STRING, "
    "event_timestamp TIMESTAMP, threshold DOUBLE, description STRING, "
    "sensor_id STRING, aqi_value DOUBLE, pm25 DOUBLE, pm10 DOUBLE, no2 DOUBLE, "
    "junction_id STRING, consecutive_cycles INT, wait_times ARRAY<DOUBLE>, "
    "average_wait_sec DOUBLE, vehicle_count INT, signal_phase STRING, "
    "route_id STRING, bus_id_1 STRING, bus_id_2 STRING, distance_metres DOUBLE, "
    "duration_seconds DOUBLE, threshold_distance_m DOUBLE, threshold_duration_sec DOUBLE, "
    "bus_1_position STRUCT<lat: DOUBLE, lon: DOUBLE>, "
    "bus_2_position STRUCT<lat: DOUBLE, lon: DOUBLE>"
)

# Columns of the relational tables, by stream: (name, type).
RELATIONAL = {
    "air_quality": (
        "air_quality_telemetry",
        "timestamp TIMESTAMP, sensor_id STRING, zone STRING, pm25 DOUBLE, pm10 DOUBLE, "
        "no2 DOUBLE, aqi DOUBLE",
    ),
    "traffic_signals": (
        "traffic_signal_telemetry",
        "timestamp TIMESTAMP, junction_id STRING, zone STRING, vehicle_count INT, "
        "avg_wait_sec DOUBLE, signal_phase STRING",
    ),
    "bus_gps": (
        "bus_gps_telemetry",
        "timestamp TIMESTAMP, bus_id STRING, route_id STRING, lat DOUBLE, lon DOUBLE, "
        "speed_kmh DOUBLE, occupancy_pct INT",
    ),
    "smart_meters": (
        "smart_meter_telemetry",
        "timestamp TIMESTAMP, meter_id STRING, ward_id STRING, kwh_reading DOUBLE, "
        "voltage DOUBLE, power_factor DOUBLE",
    ),
    "incidents": (
        "urban_incidents",
        "timestamp TIMESTAMP, incident_id STRING, incident_type STRING, key_id STRING, "
        "severity STRING, description STRING",
    ),
}
