"""Ready-made queries: alert cooldown, proximity and the three detectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.adapters import check_views, events, shape
from sensorloom.operators import incidents, proximity
from sensorloom.operators.cooldown import cooldown
from sensorloom.plans.registry import query, rounded


def _alerts(source: str, key: str, pause: str) -> str:
    """Greedy alert chain over `source`: from each alert to the first row past the pause."""
    return f"""
chain AS (
  SELECT {key}, min(ts) AS ts FROM {source} GROUP BY {key}
  UNION ALL
  SELECT c.{key}, (SELECT min(s.ts) FROM {source} s WHERE s.{key} = c.{key} AND s.ts > c.ts + INTERVAL {pause}) AS ts
  FROM chain c WHERE c.ts IS NOT NULL),
alerts AS (SELECT s.* FROM {source} s JOIN chain c ON c.{key} = s.{key} AND c.ts = s.ts
           QUALIFY row_number() OVER (PARTITION BY s.{key}, s.ts ORDER BY s.event_id) = 1)"""


@query("alert_cooldown", check_views(recursive=True) + ",\nsrc AS (SELECT * FROM ev WHERE value > 60),"
       + _alerts("src", "user_id", "3 DAY") + "SELECT event_id, user_id, ts FROM alerts")
def alert_cooldown(spark, sf):
    over = events(spark, sf).where(F.col("value") > 60).select("event_id", "user_id", "ts")
    return cooldown(over, ["user_id"], "ts", "3 days", ["event_id"], slice_width="10 days")


_AQI_COLUMNS = ["incident_type", "severity", "key_id", "zone", "aqi_value", "pm25", "pm10", "no2", "threshold",
                "event_timestamp", "description"]


def aqi(spark, sf):
    return incidents.aqi_emergency(shape(spark, sf, "air"), pause="1 day", slice_width="6 days")


_AQI_CHECK = "\nsrc AS (SELECT * FROM air WHERE aqi > 300)," + _alerts("src", "sensor_id", "1 DAY")


@query("aqi_emergency", check_views("air", recursive=True) + "," + _AQI_CHECK + """
SELECT 'AQI_EMERGENCY' AS incident_type, 'CRITICAL' AS severity, sensor_id AS key_id, zone, aqi AS aqi_value,
       pm25, pm10, no2, CAST(300 AS DOUBLE) AS threshold, ts AS event_timestamp,
       concat('HAZARDOUS AQI (', CAST(round(aqi) AS BIGINT), ') detected at sensor ', sensor_id, ' in ', zone, '.')
           AS description FROM alerts""")
def aqi_emergency(spark, sf):
    return aqi(spark, sf).select(*_AQI_COLUMNS)


def jam(spark, sf):
    return incidents.gridlock(shape(spark, sf, "signals"), threshold=60.0, pause="1 day",
                              breach_slice="2 days", slice_width="6 days")


_JAM_CHECK = """
src AS (SELECT * FROM (
  SELECT event_id, ts, junction_id, zone, vehicle_count, signal_phase, count(*) OVER w AS c,
         min(coalesce(avg_wait_sec, 0)) OVER w AS lo, avg(coalesce(avg_wait_sec, 0)) OVER w AS m FROM signals
  WINDOW w AS (PARTITION BY junction_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) t
  WHERE c = 3 AND lo > 60),""" + _alerts("src", "junction_id", "1 DAY")


@query("gridlock", check_views("signals", recursive=True) + "," + _JAM_CHECK + f"""
SELECT 'TRAFFIC_GRIDLOCK' AS incident_type, 'HIGH' AS severity, junction_id AS key_id, zone, vehicle_count, signal_phase,
       CAST(3 AS INTEGER) AS consecutive_cycles, {rounded('m', 1)} AS average_wait_sec, lo AS lowest_wait,
       ts AS event_timestamp,
       concat('GRIDLOCK at junction ', junction_id, ' in ', coalesce(zone, 'None'), '. Average wait ',
              CAST({rounded('m', 0)} AS BIGINT), 's over 3 cycles.') AS description FROM alerts""")
def gridlock(spark, sf):
    return jam(spark, sf).select(
        "incident_type", "severity", "key_id", "zone", "vehicle_count", "signal_phase", "consecutive_cycles",
        "average_wait_sec", F.array_min("wait_times").alias("lowest_wait"), "event_timestamp", "description",
    )


# Every update against the other buses' positions as of that update.
_NEAR_CHECK = """
pos AS (SELECT route_id AS route, bus_id AS bus, event_id AS id, ts, lat, lon,
               row_number() OVER (PARTITION BY route_id, bus_id ORDER BY event_id) AS n FROM bus),
fleet AS (SELECT DISTINCT route, bus FROM pos),
asked AS (SELECT p.*, f.bus AS other FROM pos p JOIN fleet f ON f.route = p.route AND f.bus <> p.bus),
pairs AS (SELECT a.route, a.id, a.ts, least(a.bus, a.other) AS bus_id_1, greatest(a.bus, a.other) AS bus_id_2,
                 concat(least(a.bus, a.other), '|', greatest(a.bus, a.other)) AS pair, a.n + o.n AS step,
                 2 * 6371000 * asin(sqrt(power(sin((o.lat - a.lat) * pi() / 360), 2)
                   + cos(a.lat * pi() / 180) * cos(o.lat * pi() / 180) * power(sin((o.lon - a.lon) * pi() / 360), 2))) AS d
          FROM asked a ASOF JOIN pos o ON o.route = a.route AND o.bus = a.other AND a.id > o.id),
near AS (SELECT * FROM pairs WHERE d < 500)"""


def near(spark, sf):
    return proximity.near_observations(shape(spark, sf, "bus"), 500.0, slice_width="2 days")


@query("proximity_pairs", check_views("bus") + "," + _NEAR_CHECK + """
SELECT route AS route_id, id AS event_id, bus_id_1, bus_id_2, round(d, 2) AS distance_metres FROM near""")
def proximity_pairs(spark, sf):
    return near(spark, sf).select(
        F.col("route").alias("route_id"), F.col("id").alias("event_id"), "bus_id_1", "bus_id_2",
        F.round("distance_metres", 2).alias("distance_metres"),
    )


# The fold as a recursion: the state is the route's last alert and, for each alert so far, its pair
# with the time at which that pair's clock started again.
_BUNCHING_CHECK = _NEAR_CHECK + """,
stepped AS (SELECT *, step - lag(step) OVER w AS gap, lead(ts) OVER w AS again FROM near
            WINDOW w AS (PARTITION BY route, pair ORDER BY step)),
begun AS (SELECT *, max(CASE WHEN gap IS DISTINCT FROM 1 THEN step END) OVER (PARTITION BY route, pair ORDER BY step) AS ep
          FROM stepped),
cand AS (SELECT * FROM (SELECT *, min(ts) OVER (PARTITION BY route, pair, ep) AS since FROM begun) b
         WHERE epoch_ms(ts) - epoch_ms(since) > 300000),
fold AS (
  SELECT route, TIMESTAMP '1970-01-01' AS last_ts, CAST(NULL AS BIGINT) AS id, CAST(NULL AS VARCHAR) AS pair,
         CAST(NULL AS BIGINT) AS len, [{'p': '', 't': TIMESTAMP '1970-01-01'}] AS resets FROM (SELECT DISTINCT route FROM cand) r
  UNION ALL
  SELECT route, ts, id, pair, len, list_append(resets, {'p': pair, 't': again}) FROM (
    SELECT c.route, c.ts, c.id, c.pair, c.again, f.resets,
           epoch_ms(c.ts) - greatest(epoch_ms(c.since),
             coalesce(list_max(list_transform(list_filter(f.resets, lambda x: x.p = c.pair), lambda x: epoch_ms(x.t))), 0)) AS len,
           row_number() OVER (PARTITION BY c.route ORDER BY c.ts, c.id, c.pair) AS i
    FROM fold f JOIN cand c ON c.route = f.route AND c.ts > f.last_ts + INTERVAL 1 DAY
     AND epoch_ms(c.ts) - greatest(epoch_ms(c.since),
             coalesce(list_max(list_transform(list_filter(f.resets, lambda x: x.p = c.pair), lambda x: epoch_ms(x.t))), 0)) > 300000
  ) t WHERE i = 1),
bunched AS (SELECT f.route, f.id, f.last_ts, n.bus_id_1, n.bus_id_2, n.d, f.len FROM fold f
            JOIN near n ON n.route = f.route AND n.id = f.id AND n.pair = f.pair)"""


def bunching(spark, sf):
    return proximity.bunching_alert_rows(
        proximity.bunching_alerts(near(spark, sf), pause="1 day", slice_width="2 days"), 500.0, "300 seconds"
    )


@query("bus_bunching", check_views("bus", recursive=True) + "," + _BUNCHING_CHECK + f"""
SELECT 'BUS_BUNCHING' AS incident_type, 'MEDIUM' AS severity, route AS key_id, bus_id_1, bus_id_2,
       {rounded('d', 1)} AS distance_metres, {rounded('len / 1000.0', 0)} AS duration_seconds,
       last_ts AS event_timestamp FROM bunched""")
def bus_bunching(spark, sf):
    return bunching(spark, sf).select(
        "incident_type", "severity", "key_id", "bus_id_1", "bus_id_2", "distance_metres", "duration_seconds",
        "event_timestamp",
    )


@query("incident_union", check_views("air", "signals", "bus", recursive=True) + "," + _AQI_CHECK
       + "," + _JAM_CHECK.replace("src ", "jam_src ").replace("chain", "jam_chain").replace("alerts AS", "jam_alerts AS")
       .replace("FROM src", "FROM jam_src") + "," + _BUNCHING_CHECK + """
SELECT 'AQI_EMERGENCY' AS incident_type, sensor_id AS key_id, ts AS event_timestamp, zone FROM alerts
UNION ALL SELECT 'TRAFFIC_GRIDLOCK', junction_id, ts, zone FROM jam_alerts
UNION ALL SELECT 'BUS_BUNCHING', route, last_ts, NULL FROM bunched""")
def incident_union(spark, sf):
    feed = incidents.incident_feed(aqi(spark, sf), jam(spark, sf), bunching(spark, sf))
    return feed.select("incident_type", "key_id", "event_timestamp", "zone")
