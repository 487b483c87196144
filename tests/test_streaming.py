"""Streams against the batch operators on the same rows, late rows, and restarts."""

import json
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from sensorloom import schemas
from sensorloom.adapters import dimension, shape
from sensorloom.operators import incidents, proximity, quality, rollups
from sensorloom.sources import topics
from sensorloom.streaming import jobs, processors
from sensorloom.streaming.progress import ProgressLog

SENTINEL = "2031-01-01 00:00:00"


def as_files(df, path, files=4, start=0):
    """Write rows as several files in event order, with increasing modification times."""
    rows = df.orderBy("event_id").toArrow()
    os.makedirs(path, exist_ok=True)
    step = -(-rows.num_rows // files)
    for i in range(files):
        part = rows.slice(i * step, step)
        # Out of order within a file: the operators have to sort.
        part = part.take(list(range(part.num_rows))[::-1])
        name = os.path.join(path, f"part-{start + i:03d}.parquet")
        pq.write_table(part, name, coerce_timestamps="us")
        os.utime(name, (1_700_000_000 + start + i,) * 2)


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def sentinel(df, **values):
    """One row far in the future, so that the watermark passes every real row."""
    row = {f.name: None for f in df.schema.fields} | {"event_id": 10**9} | values
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    one = df.sparkSession.createDataFrame([tuple(row[f.name] for f in schema)], schema)
    return df.unionByName(one.withColumn("ts", F.to_timestamp(F.lit(SENTINEL))))


def finish(df, tmp_path, mode="append"):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    q = df.writeStream.format("parquet").outputMode(mode).option("path", out).option(
        "checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None
    return df.sparkSession.read.schema(df.schema).parquet(out)


def same(a, b, columns):
    def rows(df):
        return sorted(map(str, df.select(*columns).collect()))

    assert rows(a) == rows(b)


COMMON = ["incident_id", "incident_type", "severity", "key_id", "event_timestamp", "threshold", "description"]


def test_aqi_stream_equals_batch(spark, tmp_path):
    air = shape(spark, SF_SMALL, "air").cache()
    as_files(sentinel(air, sensor_id="END", aqi=999.0, zone="Z"), str(tmp_path / "in"))
    got = finish(processors.aqi_emergency_stream(
        stream(spark, str(tmp_path / "in"), air.schema).withWatermark("ts", "30 seconds"), pause="2 days"), tmp_path)
    want = incidents.aqi_emergency(air, pause="2 days")
    assert want.count() > 20
    same(got.where("key_id <> 'END'"), want, COMMON + ["aqi_value", "zone"])


def test_gridlock_stream_equals_batch(spark, tmp_path):
    signals = shape(spark, SF_SMALL, "signals").cache()
    as_files(sentinel(signals, junction_id="END"), str(tmp_path / "in"))
    got = finish(processors.gridlock_stream(
        stream(spark, str(tmp_path / "in"), signals.schema).withWatermark("ts", "30 seconds"),
        threshold=40.0, pause="1 day"), tmp_path)
    want = incidents.gridlock(signals, threshold=40.0, pause="1 day")
    assert want.count() > 10
    same(got, want, COMMON + ["wait_times", "average_wait_sec", "vehicle_count", "signal_phase"])


def test_bunching_stream_equals_batch(spark, tmp_path):
    buses = shape(spark, SF_SMALL, "bus").cache()
    as_files(sentinel(buses, route_id="END", bus_id="B", lat=1.0, lon=1.0), str(tmp_path / "in"))
    got = finish(processors.bus_bunching_stream(
        stream(spark, str(tmp_path / "in"), buses.schema).withWatermark("ts", "30 seconds"),
        distance=800.0, pause="1 day"), tmp_path)
    want = proximity.bus_bunching(buses, distance=800.0, pause="1 day")
    assert want.count() > 10
    same(got.drop("threshold"), want.drop("threshold"),
         [c for c in COMMON if c != "threshold"] + ["bus_id_1", "bus_id_2", "distance_metres", "duration_seconds",
                                                    "bus_1_position", "bus_2_position"])


def test_arrival_order_folds_each_batch(spark, tmp_path):
    air = shape(spark, SF_SMALL, "air").cache()
    as_files(air, str(tmp_path / "in"), files=3)
    got = finish(processors.aqi_emergency_stream(
        stream(spark, str(tmp_path / "in"), air.schema).withWatermark("ts", "30 seconds"),
        pause="2 days", order="arrival"), tmp_path)
    # The files are in time order and each batch is sorted, so arrival order is time order here.
    same(got, incidents.aqi_emergency(air, pause="2 days"), COMMON)


def envelope_of(rows):
    return [
        (None, json.dumps(body) if isinstance(body, dict) else body, topic, 0, i, None)
        for i, (topic, body) in enumerate(rows)
    ]


def write_envelope(spark, rows, path, n):
    df = spark.createDataFrame(envelope_of(rows), schemas.ENVELOPE).withColumn("offset", F.col("offset") + n * 1000)
    df.coalesce(1).write.mode("append").parquet(path)


def reading(ts, kwh, ward="W1", meter="M1"):
    return ("smart_meters", {"meter_id": meter, "ward_id": ward, "kwh_reading": kwh, "voltage": 230.0 + kwh / 100,
                             "power_factor": 0.9, "timestamp": f"2026-01-01T{ts}Z"})


def run_energy(spark, tmp_path):
    env = topics.stream_topics(spark, ["smart_meters"], path=str(tmp_path / "in"), per_trigger=1)
    for q in jobs.ward_energy(env, str(tmp_path / "archive"), str(tmp_path / "ck"), available_now=True,
                              path=str(tmp_path / "topic")):
        q.awaitTermination(240)
        assert q.exception() is None


def test_ward_energy_two_sinks_late_rows_and_restart(spark, tmp_path):
    src = str(tmp_path / "in")
    write_envelope(spark, [reading("00:00:00.000", 100.0), reading("00:14:59.999", 104.5), reading("01:00:00.000", 110.0)], src, 0)
    run_energy(spark, tmp_path)
    # 44 minutes late is inside the delay. Then the watermark moves on, and a late row is dropped.
    write_envelope(spark, [reading("00:16:00.000", 105.0), reading("00:20:00.000", 106.0)], src, 1)
    run_energy(spark, tmp_path)
    write_envelope(spark, [reading("06:00:00.000", 150.0)], src, 2)
    run_energy(spark, tmp_path)
    write_envelope(spark, [reading("00:21:00.000", 900.0), reading("12:00:00.000", 160.0)], src, 3)
    run_energy(spark, tmp_path)
    archive = spark.read.schema(schemas.WARD_SUMMARY).parquet(str(tmp_path / "archive"))
    got = {(str(r.window_start), r.total_kwh_consumed) for r in archive.collect()}
    assert got == {("2026-01-01 00:00:00", 4.5), ("2026-01-01 00:15:00", 1.0), ("2026-01-01 01:00:00", 0.0),
                   ("2026-01-01 06:00:00", 0.0)}
    assert sorted(os.listdir(tmp_path / "archive" / "ward_id=W1"))[-1] == "date=2026-01-01"
    live = spark.read.parquet(str(tmp_path / "topic"))
    last = live.select("key", F.from_json("value", schemas.WARD_SUMMARY).alias("d"), "offset").select("key", "d.*", "offset")
    newest = last.groupBy("key", "window_start").agg(F.max_by("total_kwh_consumed", "offset").alias("t"))
    assert {(str(r.window_start), r.t) for r in newest.collect()} >= {("2026-01-01 00:00:00", 4.5), ("2026-01-01 00:15:00", 1.0)}


def test_ward_speed_changes_and_final_rows(spark, tmp_path):
    src = str(tmp_path / "in")
    write_envelope(spark, [reading("00:00:00.000", 100.0), reading("00:14:59.999", 104.128)], src, 0)
    write_envelope(spark, [reading("06:00:00.000", 150.0)], src, 1)
    env = topics.stream_topics(spark, ["smart_meters"], path=src, per_trigger=1)
    for q in jobs.ward_speed(env, str(tmp_path / "ck"), available_now=True, path=str(tmp_path / "topic")):
        q.awaitTermination(240)
        assert q.exception() is None
    rows = spark.read.parquet(str(tmp_path / "topic")).select("emission", F.from_json("value", schemas.WARD_SUMMARY).alias("d")).select("emission", "d.*")
    got = {(r.emission, str(r.window_start)[11:16], round(r.total_kwh_consumed, 6), r.source_layer) for r in rows.collect()}
    assert got == {("change", "00:00", 4.128, "SPEED"), ("change", "06:00", 0.0, "SPEED"), ("final", "00:00", 4.128, "SPEED")}


def test_advisory_stream_equals_batch(spark, tmp_path):
    air = shape(spark, SF_SMALL, "air").where("ts < '2024-01-03'").cache()
    profile = dimension(spark, SF_SMALL, "profile").cache()
    as_files(sentinel(air, zone="Z0", aqi=10.0), str(tmp_path / "in"), files=2)
    got = finish(rollups.sliding_advisory_stream(
        stream(spark, str(tmp_path / "in"), air.schema).withWatermark("ts", "15 minutes"), profile), tmp_path)
    want = rollups.sliding_advisory(air, profile)
    assert want.count() > 50
    same(got, want, want.columns)


def test_dead_letters_and_progress(spark, tmp_path):
    envelope = shape(spark, SF_SMALL, "envelope").cache()
    envelope.drop("event_id").select("key", "value", "topic", "partition", "offset", "timestamp").coalesce(2).write.parquet(
        str(tmp_path / "in"))
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        env = topics.stream_topics(spark, list(schemas.WIRE), path=str(tmp_path / "in"), per_trigger=1)
        q = jobs.route_dead_letters(env, str(tmp_path / "ck"), available_now=True, path=str(tmp_path / "dlq"))
        q.awaitTermination(240)
        assert q.exception() is None
    finally:
        import time

        deadline = time.monotonic() + 20
        while log.totals("dead_letter_router", "validation").get("validated") != 1000 and time.monotonic() < deadline:
            time.sleep(0.2)
        spark.streams.removeListener(log)
    dead = quality.dead_letters(quality.validate(envelope))
    out = spark.read.parquet(str(tmp_path / "dlq"))
    assert out.count() == dead.count() > 0
    assert {r.key for r in out.select("key").distinct().collect()} == {
        r.error_reason for r in dead.select("error_reason").distinct().collect()}
    totals = log.totals("dead_letter_router", "validation")
    assert totals == {"validated": 1000, "invalid": dead.count()}


def test_enrichment_job(spark, tmp_path):
    schedule = spark.createDataFrame(
        [("R1", "S1", 1, "06:00:00", "Line", "Depot", "UP"), ("R1", "S2", 2, "06:08:00", "Line", "Depot", "UP")],
        schemas.ROUTE_SCHEDULE)
    bus = {"bus_id": "B1", "lat": 19.0, "lon": 72.8, "speed_kmh": 1.0, "occupancy_pct": 5}
    rows = [("bus_gps", bus | {"route_id": "R1", "timestamp": "2026-01-01T06:05:00.000Z"}),
            ("bus_gps", bus | {"route_id": "R1", "timestamp": "2026-01-01T09:00:00.000Z"}),
            ("bus_gps", bus | {"route_id": "R9", "timestamp": "2026-01-01T06:05:00.000Z"})]
    write_envelope(spark, rows, str(tmp_path / "in"), 0)
    env = topics.stream_topics(spark, ["bus_gps"], path=str(tmp_path / "in"))
    jobs.enrich_routes(env, schedule, str(tmp_path / "ck"), available_now=True, path=str(tmp_path / "out")).awaitTermination(120)
    got = [json.loads(r.value) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("offset").collect()]
    assert [(g["route_name"], g["scheduled_arrival_time"]) for g in got] == [
        ("Line", "06:08:00"), ("Line", "06:00:00"), ("UNKNOWN_ROUTE", "N/A")]
    assert all("enrichment_timestamp" in g for g in got)


def test_incident_job_and_independent_readers(spark, tmp_path):
    def air(ts, aqi):
        return ("air_quality", {"sensor_id": "S1", "zone": "Z1", "pm25": 1.0, "pm10": 1.0, "no2": 1.0, "aqi": aqi,
                                "timestamp": f"2026-01-01T{ts}Z"})

    def wait(ts, w):
        return ("traffic_signals", {"junction_id": "J1", "zone": "Z1", "vehicle_count": 3, "avg_wait_sec": w,
                                    "signal_phase": "RED", "timestamp": f"2026-01-01T{ts}Z"})

    def bus(b, ts, lat):
        return ("enriched_bus_gps", {"bus_id": b, "route_id": "R1", "lat": lat, "lon": 72.8, "speed_kmh": 1.0,
                                     "occupancy_pct": 1, "timestamp": f"2026-01-01T{ts}Z"})

    rows = [air("00:00:00.000", 300.0), air("00:00:10.000", 300.1), air("00:02:10.000", 400.0), air("00:02:10.001", 400.0),
            wait("00:00:00.000", 181.0), wait("00:01:00.000", 180.5), wait("00:02:00.000", 200.0),
            bus("B1", "00:00:00.000", 19.0), bus("B2", "00:00:00.000", 19.001), bus("B1", "00:05:00.000", 19.0),
            bus("B2", "00:05:01.000", 19.001),
            air("12:00:00.000", 1.0), wait("12:00:00.000", 1.0), bus("B1", "12:00:00.000", 19.3)]
    write_envelope(spark, rows, str(tmp_path / "in"), 0)
    env = topics.stream_topics(spark, ["air_quality", "traffic_signals", "enriched_bus_gps"], path=str(tmp_path / "in"))
    for q in jobs.detect_incidents(env, str(tmp_path / "ck"), available_now=True, path=str(tmp_path / "out")):
        q.awaitTermination(240)
        assert q.exception() is None
    got = sorted((b["incident_type"], b["key_id"], b["event_timestamp"][11:23])
                 for b in (json.loads(r.value) for r in spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == [("AQI_EMERGENCY", "S1", "00:00:10.000"), ("AQI_EMERGENCY", "S1", "00:02:10.001"),
                   ("BUS_BUNCHING", "R1", "00:05:01.000"), ("TRAFFIC_GRIDLOCK", "J1", "00:02:00.000")]


def test_zone_dashboard_complete_mode(spark, tmp_path):
    rows = [("traffic_signals", {"junction_id": "J1", "zone": z, "vehicle_count": v, "avg_wait_sec": w,
                                 "signal_phase": "RED", "timestamp": "2026-01-01T00:00:00.000Z"})
            for z, v, w in [("A", 4, 200.0), ("A", None, 10.0), (None, 2, None)]]
    write_envelope(spark, rows, str(tmp_path / "in"), 0)
    env = topics.stream_topics(spark, ["traffic_signals"], path=str(tmp_path / "in"))
    seen = []
    q = jobs.zone_dashboard(env, str(tmp_path / "ck"), lambda df, i: seen.extend(df.collect()), available_now=True)
    q.awaitTermination(120)
    got = {r.zone: (r.events, r.avg_vehicle_count, r.avg_wait_sec, r.max_wait_sec, r.gridlock_count) for r in seen}
    assert got == {"A": (2, 2.0, 105.0, 200.0, 1), "unknown": (1, 2.0, 0.0, 0.0, 0)}


def test_ward_running_stream_has_a_row_for_every_event(spark, tmp_path):
    meters = shape(spark, SF_SMALL, "meters").where("ts < '2024-01-08'").cache()
    far = {"meter_id": "END", "ward_id": "END", "kwh_reading": 1.0, "power_factor": 1.0, "voltage": 1.0}
    as_files(sentinel(meters, **far), str(tmp_path / "in"), files=3)
    got = finish(processors.ward_running_stream(
        stream(spark, str(tmp_path / "in"), meters.schema).withWatermark("ts", "45 minutes"), width="6 hours"), tmp_path).where("ward_id <> 'END'")
    want = rollups.ward_running(meters, ["ts", "event_id"], width="6 hours")
    figures = ["ward_id", "window_start", "window_end", "date", "event_id", "round(total_kwh_consumed, 6) AS t", "round(avg_power_factor, 9) AS p",
               "peak_voltage", "source_layer"]
    assert want.count() > 100
    same(got.where("NOT final").selectExpr(*figures), want.selectExpr(*figures), ["*"])
    last = want.groupBy("ward_id", "window_start").agg(F.max_by("total_kwh_consumed", F.struct("ts", "event_id")).alias("t"))
    same(got.where("final").selectExpr("ward_id", "window_start", "round(total_kwh_consumed, 6) AS t"),
         last.selectExpr("ward_id", "window_start", "round(t, 6) AS t"), ["*"])


def test_lag_of_a_paused_reader_is_what_it_has_not_read(spark, tmp_path):
    from sensorloom.sources import offsets
    from sensorloom.streaming import lag

    src, ck = str(tmp_path / "in"), str(tmp_path / "ck")

    def add(*spans):
        rows = [(None, "{}", t, p, o, None) for t, p, a, b in spans for o in range(a, b)]
        offsets.write_topic(spark.createDataFrame(rows, schemas.ENVELOPE), src, 1)

    def read():
        q = topics.stream_topics(spark, ["a", "b"], path=src, per_trigger=1).writeStream.format("noop").option(
            "checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None

    def behind():
        return {(r.topic, r.partition): r.lag for r in lag.folder_lag(spark, ck, src).where("partition IS NOT NULL").collect()}

    add(("a", 0, 0, 10), ("b", 0, 0, 4))
    assert behind() == {("a", 0): 10, ("b", 0): 4}
    read()
    assert behind() == {("a", 0): 0, ("b", 0): 0}
    add(("a", 0, 10, 17))
    add(("a", 1, 0, 5), ("a", 0, 17, 18))
    assert behind() == {("a", 0): 8, ("a", 1): 5, ("b", 0): 0}
    assert lag.folder_lag(spark, ck, src, ["a"]).where("partition IS NULL").first().lag == 13
    read()
    assert set(behind().values()) == {0}


def test_broker_positions_from_a_checkpoint(spark, tmp_path):
    from sensorloom.streaming import lag

    for part, name, text in (("commits", "3", 'v1\n{"nextBatchWatermarkMs":0}'), ("commits", "12", 'v1\n{"nextBatchWatermarkMs":0}'),
                             ("offsets", "12", 'v1\n{"batchWatermarkMs":0,"batchTimestampMs":1,"conf":{"a":"b"}}\n{"t":{"0":40,"1":7},"u":{"0":1}}'),
                             ("offsets", "13", 'v1\n{"batchWatermarkMs":0}\n{"t":{"0":99,"1":99}}')):
        (tmp_path / part).mkdir(exist_ok=True)
        (tmp_path / part / name).write_text(text)
    heads = spark.createDataFrame([("t", 0, 50), ("t", 1, 7), ("u", 0, 1), ("u", 1, 3)], "topic STRING, partition INT, high LONG")
    got = {(r.topic, r.partition): r.lag for r in lag.broker_lag(spark, str(tmp_path), heads).where("partition IS NOT NULL").collect()}
    assert got == {("t", 0): 10, ("t", 1): 0, ("u", 0): 0, ("u", 1): 3}
    assert lag.broker_positions(spark, str(tmp_path / "none")).count() == 0


def test_run_for_stops_queries(spark, tmp_path):
    write_envelope(spark, [reading("00:00:00.000", 1.0)], str(tmp_path / "in"), 0)
    env = topics.stream_topics(spark, ["smart_meters"], path=str(tmp_path / "in"))
    queries = [env.writeStream.format("noop").option("checkpointLocation", str(tmp_path / f"ck{i}")).start() for i in range(2)]
    jobs.run_for(queries, 3)
    assert not any(q.isActive for q in queries)
