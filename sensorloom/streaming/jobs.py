"""The streaming jobs: decode, watermark, operate, write.

Each takes an envelope stream (from a broker or from files) and starts its queries. A query has its
own checkpoint, so queries on one topic are independent readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom import schemas
from sensorloom.functions.times import TIME_OF_DAY
from sensorloom.operators import incidents, joins, quality, rollups
from sensorloom.sinks import relational, topics as out
from sensorloom.sources.topics import decode
from sensorloom.streaming import processors

# How late rows may be.
METER_DELAY = "45 minutes"
AIR_DELAY = "15 minutes"
INCIDENT_DELAY = "30 seconds"

METERS, AIR, SIGNALS, BUSES = "smart_meters", "air_quality", "traffic_signals", "bus_gps"
ENRICHED = "enriched_bus_gps"
ENERGY, ADVISORIES, INCIDENTS, DEAD = "ward_energy_summary", "health_advisories", "incidents", "dlq"


def timed(envelope: DataFrame, topic: str, schema: str, delay: str, fallback: bool = False) -> DataFrame:
    """Decoded rows of one topic with `ts`, a watermark on it, and an id that orders equal times."""
    rows = envelope.where(F.col("topic") == topic)
    opened = decode(rows, schema, "ts", ["partition", "offset"], record_time_fallback=fallback)
    return opened.withColumn(
        "event_id", F.col("partition").cast("bigint") * F.lit(1 << 48) + F.col("offset")
    ).withWatermark("ts", delay)


def ward_energy(envelope: DataFrame, archive: str, checkpoint: str, width: str = "15 minutes",
                delay: str = METER_DELAY, available_now: bool = False, **topic) -> tuple[StreamingQuery, StreamingQuery]:
    """Ward rollup to two sinks: every change to the topic, finished windows to the archive."""
    rollup = rollups.ward_rollup(timed(envelope, METERS, schemas.SMART_METERS, delay), width=width)
    messages = out.to_envelope(rollup, "ward_id")
    live = out.write_topic(messages, ENERGY, f"{checkpoint}/topic", "update", name="ward_energy_topic",
                           available_now=available_now, **topic)
    final = out.write_archive(rollup, archive, f"{checkpoint}/archive", name="ward_energy_archive",
                              available_now=available_now)
    return live, final


def ward_speed(envelope: DataFrame, checkpoint: str, width: str = "15 minutes", delay: str = METER_DELAY,
               available_now: bool = False, **topic) -> tuple[StreamingQuery, StreamingQuery]:
    """The same windows as they stand (SPEED layer, unrounded): a row at each change, and one more when a window ends."""
    rollup = rollups.ward_rollup(timed(envelope, METERS, schemas.SMART_METERS, delay), width=width, layer="SPEED", rounding=False)
    messages = out.to_envelope(rollup, "ward_id")

    def start(part: str, mode: str) -> StreamingQuery:
        target = dict(topic)
        if target.get("path"):
            target["path"] = f"{target['path']}/emission={part}"
        return out.write_topic(messages, ENERGY, f"{checkpoint}/{part}", mode, name=f"ward_speed_{part}",
                               available_now=available_now, **target)

    return start("change", "update"), start("final", "append")


def ward_speed_events(envelope: DataFrame, checkpoint: str, width: str = "15 minutes", delay: str = METER_DELAY,
                      available_now: bool = False, **topic) -> StreamingQuery:
    """One row for every event and one when a window ends, in one query."""
    rows = processors.ward_running_stream(timed(envelope, METERS, schemas.SMART_METERS, delay), width=width)
    return out.write_topic(out.to_envelope(rows, "ward_id"), ENERGY, checkpoint, "append", name="ward_speed_events",
                           available_now=available_now, **topic)


def health_advisories(envelope: DataFrame, profile: DataFrame, checkpoint: str, delay: str = AIR_DELAY,
                      available_now: bool = False, **topic) -> StreamingQuery:
    air = timed(envelope, AIR, schemas.AIR_QUALITY, delay)
    messages = out.to_envelope(rollups.sliding_advisory_stream(air, profile), "zone")
    return out.write_topic(messages, ADVISORIES, checkpoint, "update", name="health_advisories",
                           available_now=available_now, **topic)


def enrich_routes(envelope: DataFrame, schedule: DataFrame, checkpoint: str, zone: str = "UTC",
                  available_now: bool = False, **topic) -> StreamingQuery:
    """Bus positions with route metadata and the next scheduled time; stateless, append."""
    buses = decode(envelope.where(F.col("topic") == BUSES), schemas.BUS_GPS, "ts")
    now = F.date_format(F.from_utc_timestamp("ts", zone), TIME_OF_DAY)
    enriched = joins.enrich_route(buses, joins.nest_schedule(schedule), now)
    seen = enriched.observe(
        "enrichment", F.count("*").alias("processed"), F.count_if(F.col("matched")).alias("enriched"),
        F.count_if(~F.col("matched")).alias("unenriched"),
    )
    messages = out.to_envelope(
        seen.withColumn("enrichment_timestamp", F.current_timestamp()).drop("ts", "date", "matched"), "route_id"
    )
    return out.write_topic(messages, ENRICHED, checkpoint, "append", name="route_enrichment",
                           available_now=available_now, **topic)


def route_dead_letters(envelope: DataFrame, checkpoint: str, available_now: bool = False, **topic) -> StreamingQuery:
    validated = quality.validate(envelope).observe(
        "validation", F.count("*").alias("validated"), F.count_if(F.size("errors") > 0).alias("invalid")
    )
    messages = quality.dead_letter_messages(quality.dead_letters(validated))
    return out.write_topic(messages, DEAD, checkpoint, "append", name="dead_letter_router",
                           available_now=available_now, **topic)


def detect_incidents(envelope: DataFrame, checkpoint: str, delay: str = INCIDENT_DELAY, order: str = "event_time",
                     bus_topic: str = ENRICHED, aqi: dict | None = None, gridlock: dict | None = None,
                     bunching: dict | None = None, available_now: bool = False, **topic) -> list[StreamingQuery]:
    """Three detectors on one incident topic, each its own query.

    A query of its own per detector keeps their watermarks apart: a quiet feed does not hold back
    the alerts of the others.
    """
    air = timed(envelope, AIR, schemas.AIR_QUALITY, delay, fallback=True)
    signals = timed(envelope, SIGNALS, schemas.TRAFFIC_SIGNALS, delay, fallback=True)
    buses = timed(envelope, bus_topic, schemas.BUS_GPS, delay, fallback=True)
    alerts = {
        "aqi_emergency": processors.aqi_emergency_stream(air, order=order, **(aqi or {})),
        "gridlock": processors.gridlock_stream(signals, order=order, **(gridlock or {})),
        "bus_bunching": processors.bus_bunching_stream(buses, order=order, **(bunching or {})),
    }
    started = []
    for name, rows in alerts.items():
        feed = incidents.as_incidents(rows).withColumn("alert_timestamp", F.current_timestamp())
        target = dict(topic)
        if target.get("path"):
            target["path"] = f"{target['path']}/detector={name}"
        started.append(out.write_topic(out.to_envelope(feed), INCIDENTS, f"{checkpoint}/{name}", "append",
                                       name=name, available_now=available_now, **target))
    return started


def ingest_tables(envelope: DataFrame, write, checkpoint: str, streams: list[str] | None = None, commit=None,
                  available_now: bool = False) -> StreamingQuery:
    """Relational ingest of several topics in one query, each row once; the log of batches lies beside the checkpoint."""
    put = relational.ingest_batch(write, streams, commit, log=f"{checkpoint}-batches")
    writer = envelope.writeStream.foreachBatch(put).option(
        "checkpointLocation", checkpoint
    ).queryName("relational_ingest")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def zone_dashboard(envelope: DataFrame, checkpoint: str, sink, per_zone_window: str | None = None,
                   available_now: bool = False) -> StreamingQuery:
    """Traffic figures per zone; `sink(df, batch_id)` receives the full table after each batch."""
    signals = timed(envelope, SIGNALS, schemas.TRAFFIC_SIGNALS, INCIDENT_DELAY, fallback=True)
    window = F.window("ts", per_zone_window) if per_zone_window else None
    writer = rollups.zone_stats(signals, window=window).writeStream.outputMode("complete").foreachBatch(
        sink
    ).option("checkpointLocation", checkpoint).queryName("zone_dashboard")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_for(queries: list[StreamingQuery], seconds: float) -> None:
    """Let queries run for a time, then stop them; a failure of one is raised."""
    import time

    end = time.monotonic() + seconds
    try:
        for q in queries:
            q.awaitTermination(max(0.01, end - time.monotonic()))
    finally:
        for q in queries:
            q.stop()
