"""Ready-made queries: sources, sinks' row forms, filters and scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.adapters import check_views, dimension, events, shape
from sensorloom.functions import times, values
from sensorloom.functions.geo import haversine
from sensorloom.operators import filters, joins
from sensorloom.plans.registry import query, rounded
from sensorloom.sinks import relational
from sensorloom.sinks.topics import to_envelope
from sensorloom.sources import offsets, topics
from sensorloom.sources.staging import staging_dir

ENVELOPE_COLUMNS = ["topic", "partition", "offset"]


def _good(text: str) -> str:
    return f"CASE WHEN json_valid({text}) THEN {text} END"


@query("multi_topic_scan", check_views("envelope") + """
SELECT topic, partition, offset, key FROM envelope WHERE topic IN ('bus_gps', 'air_quality')""")
def multi_topic_scan(spark, sf):
    two = topics.select_topics(shape(spark, sf, "envelope"), ["bus_gps", "air_quality"])
    return two.select(*ENVELOPE_COLUMNS, "key")


@query("tail_per_partition", check_views("envelope") + """
SELECT topic, partition, e.offset AS offset, key
FROM envelope e JOIN (SELECT topic, partition, max(offset) + 1 AS high FROM envelope GROUP BY topic, partition) h
USING (topic, partition) WHERE e.offset >= h.high - 100""")
def tail_per_partition(spark, sf):
    return topics.tail(shape(spark, sf, "envelope"), 100).select(*ENVELOPE_COLUMNS, "key")


@query("tail_total", check_views("envelope") + """,
h AS (SELECT topic, partition, max(offset) + 1 AS high FROM envelope GROUP BY topic, partition),
s AS (SELECT topic, greatest(CAST(floor(250 / count(*)) AS BIGINT), 1) AS n FROM h GROUP BY topic)
SELECT e.topic, e.partition, e.offset, e.key FROM envelope e
JOIN h ON h.topic = e.topic AND h.partition = e.partition JOIN s ON s.topic = e.topic
WHERE e.offset >= h.high - s.n""")
def tail_total(spark, sf):
    return topics.tail_total(shape(spark, sf, "envelope"), 250).select(*ENVELOPE_COLUMNS, "key")


@query("tail_indexed", check_views("envelope") + """,
h AS (SELECT topic, partition, max(offset) + 1 AS high FROM envelope GROUP BY topic, partition)
SELECT topic, partition, e.offset AS offset, key FROM envelope e JOIN h USING (topic, partition)
WHERE topic IN ('bus_gps', 'smart_meters') AND e.offset >= h.high - 100""")
def tail_indexed(spark, sf):
    """Topics written to a folder, and their tails by the index of its files."""
    folder = f"{staging_dir(spark)}/topic-{uuid.uuid4().hex}"
    rows = shape(spark, sf, "envelope").select("key", "value", "topic", "partition", "offset", F.lit(None).cast("timestamp").alias("timestamp"))
    offsets.write_topic(rows, folder, 20)
    return offsets.tail_of(spark, folder, ["bus_gps", "smart_meters"], n=100).select(*ENVELOPE_COLUMNS, "key")


@query("capped_sample", check_views("envelope") + """
SELECT topic, partition, offset, key FROM envelope ORDER BY topic, partition, offset LIMIT 5000""")
def capped_sample(spark, sf):
    rows = shape(spark, sf, "envelope").select(*ENVELOPE_COLUMNS, "key")
    return topics.capped(rows, 5000, ENVELOPE_COLUMNS)


@query("decode_telemetry", check_views("envelope") + """
SELECT partition, offset,
       json_extract_string(value, '$.sensor_id') AS sensor_id, json_extract_string(value, '$.zone') AS zone,
       CAST(json_extract(value, '$.pm25') AS DOUBLE) AS pm25,
       TRY_CAST(json_extract_string(value, '$.aqi') AS DOUBLE) AS aqi,
       TRY_CAST(json_extract_string(value, '$.timestamp') AS TIMESTAMP) AS event_timestamp,
       strftime(TRY_CAST(json_extract_string(value, '$.timestamp') AS TIMESTAMP), '%Y-%m-%d') AS date
FROM envelope WHERE topic = 'air_quality' AND json_valid(value)
UNION ALL
SELECT partition, offset, NULL, NULL, NULL, NULL, NULL, NULL
FROM envelope WHERE topic = 'air_quality' AND NOT json_valid(value)""")
def decode_telemetry(spark, sf):
    air = topics.select_topics(shape(spark, sf, "envelope"), ["air_quality"])
    decoded = topics.decode(air, schemas.AIR_QUALITY, keep=["partition", "offset"])
    return decoded.select("partition", "offset", "sensor_id", "zone", "pm25", "aqi", "event_timestamp", "date")


@query("to_envelope", check_views("meters") + """
SELECT ward_id AS key, concat('{"ward_id":"', ward_id, '","event_id":', event_id, '}') AS value,
       'ward_energy_summary' AS topic FROM meters""")
def envelope_out(spark, sf):
    return to_envelope(shape(spark, sf, "meters"), "ward_id", ["ward_id", "event_id"], "ward_energy_summary")


@query("topic_catalog", check_views("envelope") + """
SELECT topic, starts_with(topic, 'traffic') AS selected FROM (
  SELECT DISTINCT topic FROM envelope UNION SELECT DISTINCT concat('__', topic) FROM envelope WHERE partition = 0
) t WHERE NOT starts_with(topic, '__') ORDER BY topic""")
def topic_catalog(spark, sf):
    rows = shape(spark, sf, "envelope")
    internal = rows.where("partition = 0").select(F.concat(F.lit("__"), "topic").alias("topic"))
    return filters.topic_catalog(rows.select("topic").unionByName(internal), prefix="traffic")


# One projection per relational table. An absent event time becomes the record's own time.
_TABLE_COLUMNS = {
    "air_quality": """json_extract_string(value, '$.sensor_id') AS sensor_id,
        json_extract_string(value, '$.zone') AS zone, TRY_CAST(json_extract_string(value, '$.pm25') AS DOUBLE) AS pm25,
        TRY_CAST(json_extract_string(value, '$.pm10') AS DOUBLE) AS pm10,
        TRY_CAST(json_extract_string(value, '$.no2') AS DOUBLE) AS no2,
        TRY_CAST(json_extract_string(value, '$.aqi') AS DOUBLE) AS aqi""",
    "traffic_signals": """json_extract_string(value, '$.junction_id') AS junction_id,
        json_extract_string(value, '$.zone') AS zone,
        TRY_CAST(json_extract_string(value, '$.vehicle_count') AS INTEGER) AS vehicle_count,
        TRY_CAST(json_extract_string(value, '$.avg_wait_sec') AS DOUBLE) AS avg_wait_sec,
        json_extract_string(value, '$.signal_phase') AS signal_phase""",
    "bus_gps": """json_extract_string(value, '$.bus_id') AS bus_id, json_extract_string(value, '$.route_id') AS route_id,
        TRY_CAST(json_extract_string(value, '$.lat') AS DOUBLE) AS lat,
        TRY_CAST(json_extract_string(value, '$.lon') AS DOUBLE) AS lon,
        TRY_CAST(json_extract_string(value, '$.speed_kmh') AS DOUBLE) AS speed_kmh,
        TRY_CAST(json_extract_string(value, '$.occupancy_pct') AS INTEGER) AS occupancy_pct""",
    "smart_meters": """json_extract_string(value, '$.meter_id') AS meter_id,
        json_extract_string(value, '$.ward_id') AS ward_id,
        TRY_CAST(json_extract_string(value, '$.kwh_reading') AS DOUBLE) AS kwh_reading,
        TRY_CAST(json_extract_string(value, '$.voltage') AS DOUBLE) AS voltage,
        TRY_CAST(json_extract_string(value, '$.power_factor') AS DOUBLE) AS power_factor""",
}


def _register_projection(stream: str, columns: str) -> None:
    only = "WHERE aqi IS NOT NULL" if stream == "air_quality" else ""

    @query(f"ingest_project_{stream}", check_views("envelope") + f"""
SELECT * FROM (SELECT coalesce(TRY_CAST(json_extract_string(value, '$.timestamp') AS TIMESTAMP),
                      TIMESTAMP '2024-02-01 00:00:00') AS timestamp, {columns}
FROM (SELECT value FROM envelope WHERE topic = '{stream}' AND json_valid(value) AND json_type(value) = 'OBJECT') good
) p {only}""")
    def project(spark, sf):
        at = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
        return relational.project(shape(spark, sf, "envelope"), stream, at)


for _stream, _columns in _TABLE_COLUMNS.items():
    _register_projection(_stream, _columns)


@query("ingest_project_incidents", check_views("incident_messages") + """
SELECT coalesce(TRY_CAST(nullif(json_extract_string(value, '$.timestamp'), '') AS TIMESTAMP),
                TRY_CAST(nullif(json_extract_string(value, '$.event_timestamp'), '') AS TIMESTAMP), TIMESTAMP '2024-02-01 00:00:00') AS timestamp,
       json_extract_string(value, '$.incident_id') AS incident_id, json_extract_string(value, '$.incident_type') AS incident_type,
       json_extract_string(value, '$.severity') AS severity,
       coalesce(nullif(json_extract_string(value, '$.sensor_id'), ''), nullif(json_extract_string(value, '$.junction_id'), ''),
                nullif(json_extract_string(value, '$.route_id'), '')) AS key_id,
       json_extract_string(value, '$.description') AS description
FROM incident_messages WHERE json_valid(value)""")
def ingest_project_incidents(spark, sf):
    at = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    return relational.project(shape(spark, sf, "incident_messages"), "incidents", at)


# ---- filters -------------------------------------------------------------------------------

@query("filter_not_null", check_views("air") + "SELECT event_id, sensor_id, aqi FROM air WHERE aqi IS NOT NULL")
def filter_not_null(spark, sf):
    return filters.not_null(shape(spark, sf, "air"), "aqi").select("event_id", "sensor_id", "aqi")


@query("threshold_filter", check_views("air", "signals") + """
SELECT 'aqi' AS measure, event_id, aqi AS reading FROM air WHERE aqi > 300
UNION ALL SELECT 'wait', event_id, avg_wait_sec FROM signals WHERE avg_wait_sec > 180""")
def threshold_filter(spark, sf):
    air = shape(spark, sf, "air").where(filters.above("aqi", 300))
    wait = shape(spark, sf, "signals").where(filters.above("avg_wait_sec", 180))
    return air.select(F.lit("aqi").alias("measure"), "event_id", F.col("aqi").alias("reading")).unionByName(
        wait.select(F.lit("wait").alias("measure"), "event_id", F.col("avg_wait_sec").alias("reading"))
    )


@query("guard_all_not_null", check_views("meters") + """
SELECT event_id, ward_id, kwh_reading, voltage, power_factor FROM meters
WHERE ward_id IS NOT NULL AND kwh_reading IS NOT NULL AND voltage IS NOT NULL AND power_factor IS NOT NULL""")
def guard_all_not_null(spark, sf):
    columns = ["ward_id", "kwh_reading", "voltage", "power_factor"]
    return filters.all_present(shape(spark, sf, "meters"), columns).select("event_id", *columns)


@query("advisory_bands", check_views("air") + """
SELECT event_id, aqi, CASE WHEN aqi > 300 THEN 'HAZARDOUS' WHEN aqi > 200 THEN 'VERY_UNHEALTHY'
       ELSE 'UNHEALTHY' END AS advisory_level FROM air WHERE aqi > 150""")
def advisory_bands(spark, sf):
    over = shape(spark, sf, "air").where(filters.above("aqi", 150))
    return filters.classify(over, "aqi").select("event_id", "aqi", "advisory_level")


_LAYER = "CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'NaN' WHEN 3 THEN 'None' WHEN 4 THEN 'null' ELSE 'BATCH' END"


@query("normalize_nulllike", check_views() + f"""
SELECT event_id, CASE WHEN lower(coalesce(s, '')) IN ('', 'nan', 'none', 'null') THEN 'SPEED' ELSE s END AS source_layer
FROM (SELECT event_id, {_LAYER} AS s FROM ev) t""")
def normalize_nulllike(spark, sf):
    tagged = events(spark, sf).select("event_id", F.expr(_LAYER).alias("source_layer"))
    return filters.default_layer(tagged)


# ---- scalar functions ----------------------------------------------------------------------

_RAD = "pi() / 180"


@query("haversine", check_views("bus") + f"""
SELECT event_id, round(2 * 6371000 * atan2(sqrt(a), sqrt(1 - a)), 3) AS metres,
       round(2 * 6371 * atan2(sqrt(a), sqrt(1 - a)), 6) AS km
FROM (SELECT event_id, power(sin((19.1 - lat) * {_RAD} / 2), 2)
        + cos(lat * {_RAD}) * cos(19.1 * {_RAD}) * power(sin((72.9 - lon) * {_RAD} / 2), 2) AS a FROM bus) t""")
def haversine_query(spark, sf):
    from sensorloom.functions.geo import EARTH_RADIUS_KM

    to = (F.lit(19.1), F.lit(72.9))
    return shape(spark, sf, "bus").select(
        "event_id", F.round(haversine("lat", "lon", *to), 3).alias("metres"),
        F.round(haversine("lat", "lon", *to, radius=EARTH_RADIUS_KM), 6).alias("km"),
    )


_WIRE_FORMS = """CASE event_id % 5 WHEN 0 THEN iso WHEN 1 THEN replace(iso, 'Z', '+05:30')
 WHEN 2 THEN replace(iso, 'Z', '') WHEN 3 THEN 'not a time' ELSE replace(iso, 'T', ' ') END"""


@query("parse_iso", check_views() + f"""
SELECT event_id, CASE event_id % 5 WHEN 3 THEN NULL WHEN 1 THEN ts - INTERVAL 330 MINUTE ELSE ts END AS event_timestamp,
       CASE event_id % 5 WHEN 1 THEN ts - INTERVAL 330 MINUTE ELSE ts END AS with_fallback FROM ev""")
def parse_iso_query(spark, sf):
    text = F.expr(_WIRE_FORMS)
    return events(spark, sf).select(
        "event_id", times.parse_iso(text).alias("event_timestamp"), times.parse_iso(text, "ts").alias("with_fallback")
    )


@query("format_iso", check_views() + "SELECT event_id, iso AS event_time, substr(iso, 1, 10) AS date FROM ev")
def format_iso_query(spark, sf):
    return events(spark, sf).select(
        "event_id", times.format_iso("ts").alias("event_time"), times.event_date("ts").alias("date")
    )


@query("epoch_floor", check_views() + """
SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start FROM ev""")
def epoch_floor_query(spark, sf):
    return events(spark, sf).select("event_id", times.epoch_floor("ts", "15 minutes").alias("window_start"))


@query("tz_render", check_views() + """
SELECT event_id, CASE event_id % 4 WHEN 2 THEN 'n/a' WHEN 3 THEN ''
  ELSE strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S.000+05:30') END AS local_time FROM ev""")
def tz_render(spark, sf):
    text = F.expr("CASE event_id % 4 WHEN 0 THEN iso WHEN 1 THEN replace(iso, 'Z', '') WHEN 2 THEN 'n/a' END")
    return events(spark, sf).select("event_id", times.render_in_zone(text).alias("local_time"))


@query("pair_key", check_views("bus") + """
SELECT event_id, CASE WHEN bus_id < o THEN concat(bus_id, '|', o) ELSE concat(o, '|', bus_id) END AS pair,
       least(bus_id, o) AS bus_id_1, greatest(bus_id, o) AS bus_id_2
FROM (SELECT event_id, bus_id, concat('B', occupancy_pct % 12) AS o FROM bus) t""")
def pair_key_query(spark, sf):
    pair = values.pair_key("bus_id", F.concat(F.lit("B"), (F.col("occupancy_pct") % 12).cast("string")))
    both = values.split_pair("pair")
    return shape(spark, sf, "bus").select("event_id", pair.alias("pair")).select(
        "event_id", "pair", both[0].alias("bus_id_1"), both[1].alias("bus_id_2")
    )


@query("round_half_up", check_views() + f"""
SELECT event_id, {rounded('value', 1)} AS to_1, {rounded('-value', 0)} AS to_0,
       {rounded('k / 8', 2)} AS to_2 FROM ev""")
def round_half_up_query(spark, sf):
    return events(spark, sf).select(
        "event_id", values.round_half_up("value", 1).alias("to_1"),
        values.round_half_up(-F.col("value"), 0).alias("to_0"),
        values.round_half_up(F.col("k") / 8, 2).alias("to_2"),
    )


@query("coalesce_key", check_views() + """
SELECT event_id, coalesce(nullif(a, ''), nullif(b, ''), nullif(c, '')) AS key_id
FROM (SELECT event_id, CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('S', user_id) END AS a,
             CASE k % 4 WHEN 0 THEN '' ELSE concat('J', user_id) END AS b,
             CASE k % 5 WHEN 0 THEN '' ELSE event_type END AS c FROM ev) t""")
def coalesce_key(spark, sf):
    key = values.first_non_empty(
        F.expr("CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('S', user_id) END"),
        F.expr("CASE k % 4 WHEN 0 THEN '' ELSE concat('J', user_id) END"),
        F.expr("CASE k % 5 WHEN 0 THEN '' ELSE event_type END"),
    )
    return events(spark, sf).select("event_id", key.alias("key_id"))


@query("preview", """
SELECT doc_id, CASE WHEN length(text) > 100 THEN concat(substring(text, 1, 100), '...') ELSE text END AS preview
FROM documents""")
def preview_query(spark, sf):
    from sensorloom.adapters import table

    return table(spark, sf, "documents").select("doc_id", values.preview("text", 100).alias("preview"))


# ---- reference tables ----------------------------------------------------------------------

@query("schedule_nest", check_views("schedule") + """
SELECT route_id, arg_min(route_name, stop_sequence) AS route_name, arg_min(terminal, stop_sequence) AS terminal,
       arg_min(scheduled_arrival_time, stop_sequence) AS first_time, count(*) AS stops,
       string_agg(concat(stop_id, '@', scheduled_arrival_time), ',' ORDER BY stop_sequence) AS stop_list
FROM schedule GROUP BY route_id""")
def schedule_nest(spark, sf):
    stop = F.transform("stops", lambda s: F.concat(s["stop_id"], F.lit("@"), s["scheduled_arrival_time"]))
    return joins.nest_schedule(dimension(spark, sf, "schedule")).select(
        "route_id", "route_name", "terminal", "first_time", F.size("stops").cast("bigint").alias("stops"),
        F.array_join(stop, ",").alias("stop_list"),
    )


_ENRICHED = """,
first AS (SELECT route_id, arg_min(route_name, stop_sequence) AS route_name, arg_min(terminal, stop_sequence) AS terminal,
          arg_min(scheduled_arrival_time, stop_sequence) AS t0 FROM schedule GROUP BY route_id),
enriched AS (
  SELECT t.event_id, t.route_id, coalesce(f.route_name, 'UNKNOWN_ROUTE') AS route_name,
         coalesce(f.terminal, 'UNKNOWN_TERMINAL') AS terminal,
         coalesce((SELECT min(s.scheduled_arrival_time) FROM schedule s WHERE s.route_id = t.route_id
                   AND s.scheduled_arrival_time >= strftime(t.ts, '%H:%M:%S')), f.t0, 'N/A') AS scheduled_arrival_time,
         f.route_id IS NOT NULL AS matched
  FROM trips t LEFT JOIN first f ON f.route_id = t.route_id)"""


def enriched_trips(spark, sf):
    nested = joins.nest_schedule(dimension(spark, sf, "schedule"))
    return joins.enrich_route(shape(spark, sf, "trips"), nested, F.date_format("ts", times.TIME_OF_DAY))


@query("route_enrich", check_views("trips", "schedule") + _ENRICHED + """
SELECT event_id, route_id, route_name, terminal, scheduled_arrival_time, matched FROM enriched""")
def route_enrich(spark, sf):
    return enriched_trips(spark, sf).select(
        "event_id", "route_id", "route_name", "terminal", "scheduled_arrival_time", "matched"
    )


@query("next_scheduled", check_views("trips", "schedule") + _ENRICHED + """
SELECT event_id, scheduled_arrival_time FROM enriched WHERE matched""")
def next_scheduled(spark, sf):
    nested = joins.nest_schedule(dimension(spark, sf, "schedule"))
    now = F.date_format("ts", times.TIME_OF_DAY)
    return shape(spark, sf, "trips").join(nested, "route_id").select(
        "event_id", joins.next_scheduled(now).alias("scheduled_arrival_time")
    )


@query("enrich_hit_rate", check_views("trips", "schedule") + """
SELECT count(*) AS processed, count(*) FILTER (WHERE m) AS enriched, count(*) FILTER (WHERE NOT m) AS unenriched,
       """ + rounded("count(*) FILTER (WHERE m) * 100.0 / greatest(1, count(*))", 1) + """ AS join_rate
FROM (SELECT event_id, route_id IN (SELECT route_id FROM schedule) AS m FROM trips) t""")
def enrich_hit_rate(spark, sf):
    from sensorloom.operators.rollups import hit_rate

    return hit_rate(enriched_trips(spark, sf))


@query("stream_static_enrich", check_views("air", "profile") + """
SELECT a.event_id, a.zone, p.zone_name, p.population, p.num_schools, p.num_hospitals
FROM air a JOIN profile p ON p.zone = a.zone WHERE a.aqi IS NOT NULL""")
def stream_static_enrich(spark, sf):
    air = filters.not_null(shape(spark, sf, "air"), "aqi")
    joined = joins.enrich_inner(air, dimension(spark, sf, "profile"), "zone")
    return joined.select("event_id", "zone", "zone_name", "population", "num_schools", "num_hospitals")
