"""Ready-made queries: aggregations, sequences, validation, serving and logs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sensorloom.functions.values import round_half_up
from sensorloom.adapters import check_views, dimension, events, shape
from sensorloom.operators import filters, logs, quality, rollups, sequence, serving
from sensorloom.sources import offsets
from sensorloom.sources.staging import staging_dir
from sensorloom.plans.registry import query, rounded

# Events are sparse (one every few minutes), so windows here are hours and pauses are days.
WIDE = "6 hours"
_WINDOW = "time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01')"

# ---- rollups -------------------------------------------------------------------------------

_ROLLUP = f"""
SELECT {_WINDOW} AS window_start, {_WINDOW} + INTERVAL 6 HOUR AS window_end, ward_id,
       strftime(ts, '%Y-%m-%d') AS date,
       {rounded('max(kwh_reading) - min(kwh_reading)', 2)} AS total_kwh_consumed,
       {rounded('avg(power_factor)', 3)} AS avg_power_factor, {rounded('max(voltage)', 1)} AS peak_voltage,
       'BATCH' AS source_layer
FROM meters GROUP BY ALL"""


@query("tumbling_rollup", check_views("meters") + _ROLLUP)
def tumbling_rollup(spark, sf):
    return rollups.ward_rollup(shape(spark, sf, "meters"), width=WIDE)


@query("tumbling_rollup_15min", check_views("meters") + _ROLLUP.replace("6 HOUR", "15 MINUTE"))
def tumbling_rollup_15min(spark, sf):
    return rollups.ward_rollup(shape(spark, sf, "meters"))


@query("tumbling_rollup_per_meter", check_views("meters") + f"""
SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, ward_id, date,
       {rounded('sum(spread)', 2)} AS total_kwh_consumed, {rounded('sum(s) / nullif(sum(n), 0)', 3)} AS avg_power_factor,
       {rounded('max(v)', 1)} AS peak_voltage, 'BATCH' AS source_layer
FROM (SELECT {_WINDOW} AS window_start, ward_id, strftime(ts, '%Y-%m-%d') AS date, meter_id,
             max(kwh_reading) - min(kwh_reading) AS spread, sum(power_factor) AS s, count(power_factor) AS n,
             max(voltage) AS v FROM meters GROUP BY ALL) m
GROUP BY window_start, ward_id, date""")
def tumbling_rollup_per_meter(spark, sf):
    return rollups.ward_rollup(shape(spark, sf, "meters"), width=WIDE, per_meter="meter_id")


_RUNNING = f"""
SELECT event_id, {_WINDOW} AS window_start, ward_id,
       max(kwh_reading) OVER w - min(kwh_reading) OVER w AS total_kwh_consumed,
       avg(power_factor) OVER w AS avg_power_factor, max(voltage) OVER w AS peak_voltage
FROM meters WHERE power_factor IS NOT NULL
WINDOW w AS (PARTITION BY {_WINDOW}, ward_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""


@query("tumbling_running", check_views("meters") + f"""
SELECT event_id, window_start, window_start + INTERVAL 6 HOUR AS window_end, ward_id, total_kwh_consumed,
       {rounded('avg_power_factor', 6)} AS avg_power_factor, peak_voltage, 'SPEED' AS source_layer
FROM ({_RUNNING}) r""")
def tumbling_running(spark, sf):
    running = rollups.ward_running(shape(spark, sf, "meters"), ["ts", "event_id"], width=WIDE)
    return running.select(
        "event_id", "window_start", "window_end", "ward_id", "total_kwh_consumed",
        F.round("avg_power_factor", 6).alias("avg_power_factor"), "peak_voltage", "source_layer",
    )


@query("sliding_advisory", check_views("air", "profile") + f""",
w AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '1970-01-01') - to_minutes(CAST(i AS INTEGER)) AS window_start,
             zone, aqi, pm25, pm10, no2
      FROM air, range(10) steps(i) WHERE aqi IS NOT NULL)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, w.zone, zone_name, population, num_schools,
       num_hospitals, {rounded('avg(aqi)', 1)} AS rolling_avg_aqi, {rounded('avg(pm25)', 1)} AS rolling_avg_pm25,
       {rounded('avg(pm10)', 1)} AS rolling_avg_pm10, {rounded('avg(no2)', 1)} AS rolling_avg_no2,
       CASE WHEN avg(aqi) > 300 THEN 'HAZARDOUS' WHEN avg(aqi) > 200 THEN 'VERY_UNHEALTHY' ELSE 'UNHEALTHY' END
           AS advisory_level
FROM w JOIN profile p ON p.zone = w.zone
GROUP BY window_start, w.zone, zone_name, population, num_schools, num_hospitals HAVING avg(aqi) > 150""")
def sliding_advisory(spark, sf):
    return rollups.sliding_advisory(shape(spark, sf, "air"), dimension(spark, sf, "profile"))


_ZONE = """coalesce(zone, 'unknown') AS zone, count(*) AS events,
       {v} AS avg_vehicle_count, {w} AS avg_wait_sec,
       greatest(0, max(coalesce(avg_wait_sec, 0))) AS max_wait_sec,
       count(*) FILTER (WHERE coalesce(avg_wait_sec, 0) > 180) AS gridlock_count""".format(
    v=rounded("avg(coalesce(vehicle_count, 0))", 1), w=rounded("avg(coalesce(avg_wait_sec, 0))", 1))


@query("zone_stats", check_views("signals") + f"SELECT {_ZONE} FROM signals GROUP BY coalesce(zone, 'unknown')")
def zone_stats(spark, sf):
    return rollups.zone_stats(shape(spark, sf, "signals"))


@query("hourly_zone_stats", check_views("signals") + f"""
SELECT date_trunc('hour', ts) AS window_start, {_ZONE} FROM signals
GROUP BY date_trunc('hour', ts), coalesce(zone, 'unknown')""")
def hourly_zone_stats(spark, sf):
    hourly = rollups.zone_stats(shape(spark, sf, "signals"), window=F.window("ts", "1 hour"))
    return hourly.select(F.col("window.start").alias("window_start"), *[c for c in hourly.columns if c != "window"])


@query("breach_counts", check_views("signals") + """
SELECT count(*) AS events_processed, count(*) FILTER (WHERE avg_wait_sec > 180) AS breaches FROM signals""")
def breach_counts(spark, sf):
    return rollups.breach_counts(shape(spark, sf, "signals"), "avg_wait_sec", 180)


def _committed(envelope):
    """Offsets a reader group could have committed: behind the head, and for some partitions none."""
    from sensorloom.operators.rollups import partition_heads

    heads = partition_heads(envelope, ["topic", "partition"])
    return heads, heads.where(F.col("partition") != 3).select(
        F.lit("dashboard").alias("group_id"), "topic", "partition",
        F.when(F.col("partition") == 5, F.col("high") + 10)
        .otherwise(F.col("high") - F.col("partition") * 7).alias("committed"),
    )


@query("consumer_lag", check_views("envelope") + """,
h AS (SELECT topic, partition, max(offset) + 1 AS high FROM envelope GROUP BY topic, partition),
c AS (SELECT topic, partition, CASE WHEN partition = 5 THEN high + 10 ELSE high - partition * 7 END AS committed
      FROM h WHERE partition <> 3),
l AS (SELECT h.topic, h.partition, greatest(0, coalesce(c.committed, 0)) AS committed, h.high,
             greatest(0, h.high - greatest(0, coalesce(c.committed, 0))) AS lag
      FROM h LEFT JOIN c ON c.topic = h.topic AND c.partition = h.partition)
SELECT topic, partition, CAST(sum(committed) AS BIGINT) AS committed, CAST(sum(high) AS BIGINT) AS high,
       CAST(sum(lag) AS BIGINT) AS lag
FROM l GROUP BY GROUPING SETS ((topic, partition), (topic))""")
def consumer_lag(spark, sf):
    heads, committed = _committed(shape(spark, sf, "envelope"))
    return rollups.lag_report(
        heads.select("topic", "partition", "high"), committed.drop("group_id"), ["topic", "partition"], "partition"
    )


@query("partition_stats", check_views("envelope") + """
SELECT topic, partition, count(*) AS partitions, min(lo) AS earliest, max(hi) AS latest,
       CAST(sum(hi - lo) AS BIGINT) AS messages
FROM (SELECT topic, partition, min(offset) AS lo, max(offset) + 1 AS hi FROM envelope GROUP BY topic, partition) p
GROUP BY GROUPING SETS ((topic, partition), (topic))""")
def partition_stats(spark, sf):
    return rollups.partition_stats(shape(spark, sf, "envelope"))


@query("feed_quality", check_views("air") + f"""
SELECT count(*) AS sent, count(*) FILTER (WHERE aqi IS NULL) AS null_aqi, count(*) FILTER (WHERE aqi > 300) AS spikes,
       {rounded('count(*) FILTER (WHERE aqi IS NULL) * 100.0 / greatest(1, count(*))', 1)} AS null_percent FROM air""")
def feed_quality(spark, sf):
    return rollups.feed_quality(shape(spark, sf, "air"))


@query("throughput", check_views() + """
SELECT event_type, count(*) AS records, (epoch_ms(max(ts)) - epoch_ms(min(ts))) / 1000.0::DOUBLE AS elapsed_sec,
       """ + rounded("count(*) / greatest(1, (epoch_ms(max(ts)) - epoch_ms(min(ts))) / 1000.0::DOUBLE)", 6) + """
           AS records_per_sec FROM ev GROUP BY event_type""")
def throughput(spark, sf):
    return rollups.throughput(events(spark, sf), key="event_type")


@query("latency_stats", check_views() + f"""
SELECT event_type, count(*) AS events_processed, {rounded('avg(k * 10)', 3)} AS avg_latency_ms,
       max(k * 10)::BIGINT AS max_latency_ms FROM ev GROUP BY event_type""")
def latency_stats(spark, sf):
    done = events(spark, sf).withColumn(
        "done", F.timestamp_micros(F.unix_micros("ts") + F.col("k").cast("bigint") * 10_000)
    )
    return rollups.latency_stats(done, "ts", "done", "event_type")


@query("distinct_over_time", check_views("meters") + """
SELECT ward_id, count(DISTINCT meter_id) AS meters, TRUE AS sketch_agrees FROM meters
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY ward_id""")
def distinct_over_time(spark, sf):
    """Distinct meters of a span from archived sketches of its windows, held against a count of the rows."""
    since, until = "2024-01-05 00:00:00", "2024-01-20 00:00:00"
    meters = shape(spark, sf, "meters")
    path = f"{staging_dir(spark)}/sketches-{uuid.uuid4().hex}"
    rollups.distinct_sketches(meters, "meter_id", ["ward_id"], width="6 hours").write.partitionBy("date").parquet(path)
    sketched = rollups.distinct_over(spark.read.parquet(path), ["ward_id"], since, until)
    exact = meters.where((F.col("ts") >= F.lit(since)) & (F.col("ts") < F.lit(until))).groupBy("ward_id").agg(
        F.count_distinct("meter_id").alias("meters"))
    return exact.join(sketched, "ward_id").select(
        "ward_id", "meters", (F.abs(F.col("distinct_values") - F.col("meters")) <= F.greatest(F.col("meters") * 0.02, F.lit(0.5))).alias("sketch_agrees"))


@query("distinct_keys", check_views("signals", "trips") + """
SELECT 'zone' AS key, count(DISTINCT zone) AS n FROM signals
UNION ALL SELECT 'junction_id', count(DISTINCT junction_id) FROM signals""")
def distinct_keys(spark, sf):
    return rollups.distinct_keys(shape(spark, sf, "signals"), ["zone", "junction_id"])


@query("calendar_rollup", check_views("meters") + f""",
d1 AS ({_ROLLUP}),
weekly AS (SELECT ward_id, date_trunc('month', window_start) AS month, date_trunc('week', window_start) AS week,
           total_kwh_consumed, peak_voltage FROM d1)
SELECT ward_id, CAST(month AS TIMESTAMP) AS month, CAST(week AS TIMESTAMP) AS week,
       {rounded('sum(total_kwh_consumed)', 2)} AS total_kwh_consumed, max(peak_voltage) AS peak_voltage,
       count(*) AS windows
FROM weekly GROUP BY GROUPING SETS ((ward_id, month, week), (ward_id, month))""")
def calendar_rollup(spark, sf):
    return rollups.calendar_rollup(tumbling_rollup(spark, sf))


# ---- sequences -----------------------------------------------------------------------------

@query("consecutive_breach", check_views() + f"""
SELECT event_id, user_id, {rounded('m', 6)} AS recent_mean, lo AS lowest
FROM (SELECT *, count(*) OVER w AS c, min(value) OVER w AS lo, avg(value) OVER w AS m FROM ev
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) t
WHERE c = 3 AND lo > 60""")
def consecutive_breach(spark, sf):
    runs = sequence.consecutive_breach(
        events(spark, sf).select("event_id", "user_id", "ts", "value"),
        ["user_id"], ["ts", "event_id"], "value", 60.0, slice_width="2 days",
    )
    return runs.select(
        "event_id", "user_id", F.round("recent_mean", 6).alias("recent_mean"), F.array_min("recent").alias("lowest")
    )


@query("dwell_episodes", check_views() + """,
marked AS (SELECT *, value > 20 AS near, count(*) FILTER (WHERE value <= 20) OVER w AS brk FROM ev
           WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS observations,
       (epoch_ms(max(ts)) - epoch_ms(min(ts))) / 1000.0::DOUBLE AS duration_sec
FROM marked WHERE near GROUP BY user_id, brk""")
def dwell_episodes(spark, sf):
    return sequence.dwell_episodes(
        events(spark, sf).select("event_id", "user_id", "ts", "value"),
        ["user_id"], ["ts", "event_id"], F.col("value") > 20, slice_width="2 days",
    )


@query("last_position", check_views("bus") + """
SELECT route_id, bus_id, max(ts) AS ts, max(event_id) AS event_id, arg_max(lat, event_id) AS lat,
       arg_max(lon, event_id) AS lon FROM bus GROUP BY route_id, bus_id""")
def last_position(spark, sf):
    return sequence.last_position(
        shape(spark, sf, "bus"), ["route_id", "bus_id"], ["ts", "event_id"], ["lat", "lon"]
    )


@query("cumulative_count", check_views() + """
SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY ts NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) AS total
FROM (SELECT event_id, CASE WHEN event_id % 9 > 0 THEN event_type END AS event_type, CASE WHEN event_id % 11 > 0 THEN ts END AS ts FROM ev) t""")
def cumulative_count(spark, sf):
    # Rows without a type or a time count too.
    rows = events(spark, sf).select(
        "event_id", F.expr("CASE WHEN event_id % 9 > 0 THEN event_type END AS event_type"), F.expr("CASE WHEN event_id % 11 > 0 THEN ts END AS ts"))
    counted = sequence.cumulative_count(rows, ["event_type"], ["ts", "event_id"], slice_width="1 day")
    return counted.select("event_id", "event_type", "total")


@query("elapsed_series", check_views() + """
SELECT event_id, user_id, CAST(round((epoch_ms(ts) - min(epoch_ms(ts)) OVER (PARTITION BY user_id)) / 1000.0::DOUBLE, 0) AS BIGINT)
    AS elapsed_sec FROM (SELECT event_id, CASE WHEN user_id % 7 > 0 THEN user_id END AS user_id, ts FROM ev) t""")
def elapsed_series(spark, sf):
    points = events(spark, sf).select("event_id", F.expr("CASE WHEN user_id % 7 > 0 THEN user_id END AS user_id"), "ts")
    return sequence.elapsed_in_series(points, ["user_id"]).select("event_id", "user_id", "elapsed_sec")


@query("latest_record", check_views("meters") + """
SELECT event_id, ward_id, meter_id, kwh_reading FROM meters
QUALIFY row_number() OVER (PARTITION BY ward_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_record(spark, sf):
    rows = shape(spark, sf, "meters").select("event_id", "ts", "ward_id", "meter_id", "kwh_reading")
    return sequence.latest_record(rows, ["ts", "event_id"], ["ward_id"]).drop("ts")


@query("impute_neighbours", check_views("air") + f"""
SELECT event_id, zone, {rounded('''coalesce(aqi, avg(aqi) OVER (PARTITION BY zone ORDER BY ts
       RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND CURRENT ROW))''', 4)} AS imputed FROM air""")
def impute_neighbours(spark, sf):
    rows = shape(spark, sf, "air").select("event_id", "ts", "zone", "aqi")
    filled = sequence.impute_from_neighbours(rows, ["zone"], "aqi", slice_width="6 hours")
    return filled.select("event_id", "zone", F.round("imputed", 4).alias("imputed"))


# ---- validation ----------------------------------------------------------------------------

AS_OF = "2024-02-01 00:00:00"


def _t(k):
    return f"json_type(value, '$.{k}')"


def _s(k):
    return f"json_extract_string(value, '$.{k}')"


def _n(k):
    return f"(CASE WHEN {_t(k)} IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN TRY_CAST({_s(k)} AS DOUBLE) END)"


def _empty(k):
    return f"coalesce({_t(k)}, 'NULL') = 'NULL'"


def _text(k):
    return f"coalesce({_t(k)}, 'NULL') NOT IN ('NULL', 'DOUBLE', 'BIGINT', 'UBIGINT')"


def _err(when, kind):
    return f"CASE WHEN {when} THEN '{kind}' END"


def _missing(stream):
    return [_err(f"{_t(k)} IS NULL", "MISSING_FIELD") for k in quality.REQUIRED_KEYS[stream]]


_CHECK_RULES = {
    "air_quality": [
        _err(_empty("aqi"), "NULL_AQI"), _err(_text("aqi"), "AQI_INVALID_TYPE"),
        _err(f"{_n('aqi')} < 0 OR {_n('aqi')} > 500", "AQI_OUT_OF_RANGE"), *_missing("air_quality")],
    "bus_gps": [
        _err(f"{_empty('lat')} OR {_empty('lon')}", "MISSING_GPS"),
        _err(f"NOT ({_empty('lat')} OR {_empty('lon')}) AND ({_text('lat')} OR {_text('lon')})", "INVALID_TYPE"),
        _err(f"NOT ({_empty('lat')} OR {_empty('lon')}) AND ({_n('lat')} NOT BETWEEN 18.85 AND 19.35 "
             f"OR {_n('lon')} NOT BETWEEN 72.70 AND 73.10)", "IMPOSSIBLE_GPS"),
        _err(_text("speed_kmh"), "INVALID_TYPE"), _err(f"{_n('speed_kmh')} < 0", "NEGATIVE_SPEED"),
        *_missing("bus_gps")],
    "traffic_signals": [
        *_missing("traffic_signals"),
        _err(f"{_t('vehicle_count')} IS NOT NULL AND {_n('vehicle_count')} IS NULL", "INVALID_TYPE"),
        _err(f"{_n('vehicle_count')} < 0", "NEGATIVE_VEHICLE_COUNT")],
    "smart_meters": [
        *_missing("smart_meters"), _err(_text("power_factor"), "INVALID_TYPE"),
        _err(f"{_n('power_factor')} NOT BETWEEN 0 AND 1", "POWER_FACTOR_OUT_OF_RANGE")],
}
_TS = f"TRY_CAST({_s('timestamp')} AS TIMESTAMP)"
_GIVEN = f"{_t('timestamp')} IS NOT NULL AND {_s('timestamp')} <> ''"
_TIME_RULES = [
    _err(f"{_GIVEN} AND {_TS} > TIMESTAMP '{AS_OF}' + INTERVAL 300 SECOND", "FUTURE_TIMESTAMP"),
    _err(f"{_GIVEN} AND {_TS} IS NULL", "INVALID_TIMESTAMP"),
]
_LISTS = " ".join(
    f"WHEN topic = '{t}' THEN [{', '.join([*rules, *_TIME_RULES])}]" for t, rules in _CHECK_RULES.items()
)
# The rules are read on valid objects only: the outer CASE guards the JSON functions.
VALIDATED = f""",
objects AS (SELECT *, json_valid(value) AND coalesce(json_type(CASE WHEN json_valid(value) THEN value END), '') = 'OBJECT'
            AS ok FROM envelope),
validated AS (
  SELECT topic, partition, offset, timestamp, raw AS value,
         CASE WHEN ok THEN list_filter(CASE {_LISTS} END, lambda x: x IS NOT NULL) ELSE ['JSON_PARSE_ERROR'] END AS errors
  FROM (SELECT * EXCLUDE (value), value AS raw, CASE WHEN ok THEN value ELSE '{{}}' END AS value FROM objects) o),
dead AS (SELECT topic AS source_topic, partition AS source_partition, offset AS source_offset, timestamp AS dlq_timestamp,
                value AS original_message, len(errors) AS error_count, errors, errors[1] AS error_reason
         FROM validated WHERE len(errors) > 0)"""


def validated(spark, sf):
    return quality.validate(shape(spark, sf, "envelope"), F.to_timestamp(F.lit(AS_OF)))


def dead(spark, sf):
    return quality.dead_letters(validated(spark, sf), F.col("timestamp"))


@query("dlq_route", check_views("envelope") + VALIDATED + """
SELECT source_topic, source_partition, source_offset, original_message, CAST(error_count AS INTEGER) AS error_count,
       error_reason, array_to_string(errors, ',') AS error_types FROM dead""")
def dlq_route(spark, sf):
    return dead(spark, sf).select(
        "source_topic", "source_partition", "source_offset", "original_message", "error_count", "error_reason",
        F.array_join("errors.error_type", ",").alias("error_types"),
    )


@query("valid_route", check_views("envelope") + VALIDATED + """
SELECT topic, partition, offset, value FROM validated WHERE len(errors) = 0""")
def valid_route(spark, sf):
    return quality.valid_rows(validated(spark, sf)).select("topic", "partition", "offset", "value")


@query("dlq_errors", check_views("envelope") + VALIDATED + """
SELECT topic, partition, offset, CAST(i - 1 AS INTEGER) AS position, errors[i] AS error_type
FROM (SELECT *, unnest(generate_series(1, len(errors))) AS i FROM validated) t""")
def dlq_errors(spark, sf):
    return quality.error_rows(validated(spark, sf)).drop("error_message")


@query("validation_stats", check_views("envelope") + VALIDATED + f""",
marks AS (SELECT 'validated' AS measure FROM validated UNION ALL SELECT 'invalid' FROM dead
          UNION ALL SELECT unnest(errors) FROM validated)
SELECT measure, count(*) AS n, {rounded("count(*) * 100.0 / (SELECT count(*) FROM validated)", 2)} AS percent
FROM marks GROUP BY measure""")
def validation_stats(spark, sf):
    return quality.validation_stats(validated(spark, sf))


def _share(column):
    return f"""
SELECT {column}, count(*) AS n, {rounded('count(*) * 100.0 / (SELECT count(*) FROM dead)', 2)} AS percent
FROM dead GROUP BY {column} ORDER BY n DESC, {column}"""


@query("dlq_by_reason", check_views("envelope") + VALIDATED + _share("error_reason"))
def dlq_by_reason(spark, sf):
    return rollups.distribution(dead(spark, sf), "error_reason", "UNKNOWN")


@query("dlq_by_source", check_views("envelope") + VALIDATED + _share("source_topic"))
def dlq_by_source(spark, sf):
    return rollups.distribution(dead(spark, sf), "source_topic", "unknown")


@query("samples_per_group", check_views("envelope") + VALIDATED + """
SELECT error_reason, source_topic, source_partition, source_offset, CAST(sample AS INTEGER) AS sample FROM (
  SELECT *, row_number() OVER (PARTITION BY error_reason ORDER BY dlq_timestamp, source_topic, source_partition,
                               source_offset) AS sample FROM dead) t WHERE sample <= 3""")
def samples_per_group(spark, sf):
    order = ["dlq_timestamp", "source_topic", "source_partition", "source_offset"]
    picked = sequence.samples_per_group(dead(spark, sf), ["error_reason"], order)
    return picked.select("error_reason", *order[1:], "sample")


@query("dlq_report_lines", check_views("envelope") + VALIDATED + """,
c AS (SELECT error_reason AS reason, source_topic AS origin, grouping_id(error_reason, source_topic) AS g, count(*) AS n,
             (SELECT count(*) FROM dead) AS total FROM dead GROUP BY GROUPING SETS ((error_reason), (source_topic), ())),
r AS (SELECT *, coalesce(reason, origin) AS name, format('{:,}', n) AS shown, (n * 2000 + total) // greatest(2 * total, 1) AS tenths,
             row_number() OVER (PARTITION BY g ORDER BY n DESC, coalesce(reason, origin)) AS i FROM c),
t AS (SELECT *, concat(tenths // 10, '.', tenths % 10, ' %') AS share FROM r),
p AS (SELECT *, concat(rpad(name, 32, ' '), lpad(shown, 12, ' '), lpad(share, 9, ' ')) AS per FROM t WHERE g < 3),
s AS (SELECT *, row_number() OVER (PARTITION BY error_reason ORDER BY dlq_timestamp, source_topic, source_partition, source_offset) AS k,
             dense_rank() OVER (ORDER BY error_reason) AS d FROM dead),
every AS (
SELECT 0 AS section, 0 AS position, 0 AS detail, concat('Dead letters: ', shown, ' from dlq in 5.0 minutes') AS line FROM t WHERE g = 3
UNION ALL SELECT 1, i, 0, concat(per, '  ', repeat('█', n * 50 // greatest(total, 1))) FROM p WHERE g = 1
UNION ALL SELECT 2, i, 0, per FROM p WHERE g = 2
UNION ALL SELECT 3, d * 100 + k, 0, concat(error_reason, ' #', k, ' at ', source_topic, '/', source_partition, '/', source_offset)
          FROM s WHERE k <= 3
UNION ALL SELECT 3, d * 100 + k, 2, concat('  value: ', CASE WHEN length(original_message) > 100
          THEN concat(left(original_message, 100), '...') ELSE coalesce(original_message, '') END) FROM s WHERE k <= 3
UNION ALL SELECT 4, i, 0, CASE reason WHEN 'NULL_AQI' THEN concat(share, ' of all dead letters lack an index value')
          WHEN 'IMPOSSIBLE_GPS' THEN concat(shown, ' positions are not in the city')
          ELSE concat(shown, ' messages are ahead of the clock') END
          FROM p WHERE g = 1 AND reason IN ('NULL_AQI', 'IMPOSSIBLE_GPS', 'FUTURE_TIMESTAMP')
UNION ALL SELECT * FROM (VALUES (1, 0, 0, 'By reason'), (2, 0, 0, 'By topic'), (3, 0, 0, 'Samples'), (4, 0, 0, 'Remarks')) AS titles)
SELECT CAST(section AS INTEGER) AS section, CAST(position AS INTEGER) AS position, CAST(detail AS INTEGER) AS detail, line FROM every""")
def dlq_report_lines(spark, sf):
    """The whole report but for the error messages of its samples, which are tested apart."""
    return quality.report_lines(dead(spark, sf)).where((F.col("section") != 3) | (F.col("detail") != 1))


# ---- serving -------------------------------------------------------------------------------

CUT = "2024-01-20 00:00:00"


def archive_and_topic(spark, sf):
    """A finished view of the windows before a cut, and a running view of all windows."""
    from sensorloom.sources.tables import archive_rows

    meters = shape(spark, sf, "meters")
    archive = archive_rows(rollups.ward_rollup(meters.where(F.col("ts") < F.lit(CUT)), width=WIDE))
    running = rollups.ward_running(meters, ["ts", "event_id"], width=WIDE)
    layer = F.expr("CASE event_id % 4 WHEN 0 THEN 'SPEED' WHEN 1 THEN NULL WHEN 2 THEN 'nan' ELSE '' END")
    topic = running.select(
        F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss.000'Z'").alias("window_start"),
        F.date_format("window_end", "yyyy-MM-dd'T'HH:mm:ss.000'Z'").alias("window_end"),
        "ward_id", "date", "total_kwh_consumed", "avg_power_factor", "peak_voltage",
        layer.alias("source_layer"), F.col("event_id").alias("offset"),
    )
    return archive, topic


_IST = "strftime({} + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S.000+05:30')"
_VIEWS = f""",
b AS ({_ROLLUP.replace('FROM meters', f"FROM meters WHERE ts < TIMESTAMP '{CUT}'")}),
running AS ({_RUNNING}),
s AS (SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, ward_id,
             strftime(window_start, '%Y-%m-%d') AS date, arg_max(total_kwh_consumed, event_id) AS total_kwh_consumed,
             arg_max(avg_power_factor, event_id) AS avg_power_factor, arg_max(peak_voltage, event_id) AS peak_voltage,
             'SPEED' AS source_layer FROM running GROUP BY window_start, ward_id),
both_views AS (SELECT * FROM b UNION ALL SELECT * FROM s),
merged AS (SELECT {_IST.format('window_start')} AS window_start, {_IST.format('window_end')} AS window_end, ward_id, date,
                  {rounded('total_kwh_consumed', 4)} AS total_kwh_consumed, {rounded('avg_power_factor', 4)} AS avg_power_factor,
                  {rounded('peak_voltage', 4)} AS peak_voltage, source_layer FROM both_views)"""


def _rounded_view(df):
    return df.select(
        "window_start", "window_end", "ward_id", "date",
        *[round_half_up(c, 4).alias(c) for c in ("total_kwh_consumed", "avg_power_factor", "peak_voltage")],
        "source_layer",
    )


@query("serving_merge_both", check_views("meters") + _VIEWS + "SELECT * FROM merged")
def serving_merge_both(spark, sf):
    return _rounded_view(serving.merge_views(*archive_and_topic(spark, sf), ["offset"]))


@query("serving_merge_batch_wins", check_views("meters") + _VIEWS + """
SELECT * FROM merged QUALIFY row_number() OVER (PARTITION BY ward_id, window_start
    ORDER BY CASE source_layer WHEN 'BATCH' THEN 0 ELSE 1 END) = 1""")
def serving_merge_batch_wins(spark, sf):
    return _rounded_view(serving.merge_views(*archive_and_topic(spark, sf), ["offset"], mode="batch_wins"))


@query("serving_ward", check_views("meters") + _VIEWS + "SELECT * FROM merged WHERE ward_id = 'W7'")
def serving_ward(spark, sf):
    return _rounded_view(serving.ward_view(*archive_and_topic(spark, sf), "W7", ["offset"]))


@query("serving_query", check_views("meters") + _VIEWS + "SELECT * FROM merged WHERE ward_id = 'W7'")
def serving_query(spark, sf):
    """The whole way: a written, partitioned archive and a topic folder of JSON summaries, all decoded and merged, for one ward."""
    _, topic = archive_and_topic(spark, sf)
    path, folder = (f"{staging_dir(spark)}/{kind}-{uuid.uuid4().hex}" for kind in ("archive", "topic"))
    batch = rollups.ward_rollup(shape(spark, sf, "meters").where(F.col("ts") < F.lit(CUT)), width=WIDE)
    batch.write.partitionBy("ward_id", "date").parquet(path)
    body = F.to_json(F.struct(*[c for c in topic.columns if c != "offset"]))
    offsets.write_topic(topic.select(
        F.col("ward_id").alias("key"), body.alias("value"), F.lit("ward_energy_summary").alias("topic"),
        F.expr("cast(substring(ward_id, 2) as int) % 2").alias("partition"), "offset", F.lit(None).cast("timestamp").alias("timestamp")), folder, 8)
    return _rounded_view(serving.query_ward(spark, path, folder, "W7", total=None, order=["offset"]))


@query("layer_anchor", check_views("meters") + _VIEWS + """,
p AS (SELECT ward_id, window_start, total_kwh_consumed, source_layer FROM merged)
SELECT * FROM p UNION
SELECT ward_id, max(window_start), arg_max(total_kwh_consumed, window_start), 'SPEED' FROM p
WHERE source_layer = 'BATCH' AND ward_id IN (SELECT ward_id FROM p WHERE source_layer = 'SPEED') GROUP BY ward_id""")
def layer_anchor(spark, sf):
    return serving.anchored_series(serving_merge_both(spark, sf))


# ---- logs ----------------------------------------------------------------------------------

@query("log_metrics", check_views("logs") + f""",
own AS (
  SELECT *, CAST(replace(big, ',', '') AS BIGINT) AS b,
    CASE form WHEN 9 THEN k % 4 WHEN 4 THEN NULL WHEN 8 THEN NULL ELSE CAST(replace(big, ',', '') AS BIGINT) END AS own_total,
    CASE WHEN form IN (0, 1, 2, 3, 11) THEN k WHEN form = 9 THEN k % 3 WHEN form = 4 THEN NULL ELSE 0 END AS own_rate
  FROM logs WHERE form <> 10),
run AS (
  SELECT *, CASE WHEN form = 8 THEN count(*) FILTER (WHERE form = 8) OVER w
                 ELSE coalesce(last_value(own_total IGNORE NULLS) OVER w, 0) END AS tot,
         coalesce(last_value(own_rate IGNORE NULLS) OVER w, 0) AS rt FROM own
  WINDOW w AS (PARTITION BY process ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT process, event_id, tot AS total, rt AS rate,
       CASE WHEN form = 0 THEN k % 7 WHEN form IN (1, 11) THEN 0 END AS errors,
       CASE WHEN form = 1 THEN k % 11 WHEN form IN (0, 11) THEN 0 END AS null_aqi,
       CASE form WHEN 2 THEN greatest(k - 1, 0) WHEN 3 THEN 0 WHEN 4 THEN b END AS lag,
       CASE WHEN form = 5 THEN k END AS invalid, CASE WHEN form = 5 THEN k END AS dlq_sent,
       CASE WHEN form = 7 THEN k END AS enriched, CASE WHEN form = 7 THEN k % 5 END AS unenriched,
       CASE WHEN form = 9 THEN k END AS stage, CASE WHEN form = 9 THEN k % 4 + 2 END AS tasks,
       CASE WHEN form = 5 THEN {rounded('k * 100.0 / greatest(1, tot)', 1)} END AS invalid_percent,
       CASE WHEN form = 9 THEN {rounded('tot * 100.0 / greatest(1, k % 4 + 2)', 0)} END AS stage_percent
FROM run""")
def log_metrics(spark, sf):
    lines = shape(spark, sf, "logs").select("process", "ts", "event_id", "line")
    return logs.log_metrics(lines, order=["ts", "event_id"], slice_width="2 days").drop("ts", "family")


@query("log_families", check_views("logs") + """
SELECT process, count(*) AS n FROM logs WHERE form <> 10 GROUP BY process""")
def log_families(spark, sf):
    return logs.parse_lines(shape(spark, sf, "logs")).groupBy("process").agg(F.count("*").alias("n"))


@query("pruned_view_scan", check_views("meters") + f""",
b AS ({_ROLLUP})
SELECT ward_id, strftime(window_start, '%Y-%m-%dT%H:%M:%S.000Z') AS window_start,
       strftime(window_end, '%Y-%m-%dT%H:%M:%S.000Z') AS window_end, date, total_kwh_consumed FROM b WHERE ward_id = 'W3'""")
def pruned_view_scan(spark, sf):
    """A written archive by ward and day, of which one ward's folders are read."""
    from sensorloom.sources.tables import archive_rows, ward_archive

    path = f"{staging_dir(spark)}/archive-{uuid.uuid4().hex}"
    tumbling_rollup(spark, sf).write.partitionBy("ward_id", "date").parquet(path)
    archive = filters.all_present(ward_archive(spark, path, "W3"), ["window_start"])
    return archive_rows(archive).select("ward_id", "window_start", "window_end", "date", "total_kwh_consumed")
