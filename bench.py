"""Time the headline queries and streams; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "tumbling_rollup", "tumbling_running", "sliding_advisory", "zone_stats", "route_enrich", "stream_static_enrich",
    "decode_telemetry", "dlq_route", "validation_stats", "consecutive_breach", "dwell_episodes", "cumulative_count",
    "alert_cooldown", "aqi_emergency", "gridlock", "proximity_pairs", "bus_bunching", "serving_merge_both",
    "tail_per_partition", "log_metrics",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def streams(spark, folder: str) -> dict:
    """Available-now streams over the events table: name -> (query that starts it)."""
    from sensorloom.adapters import dimension, shape
    from sensorloom.operators import rollups
    from sensorloom.streaming import processors

    def source(name: str):
        path = f"{folder}/{name}"
        rows = shape(spark, SF_DIR, name)
        rows.repartitionByRange(8, "event_id").write.parquet(path)
        return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(path)

    air, signals, buses, meters = (source(n) for n in ("air", "signals", "bus", "meters"))
    profile = dimension(spark, SF_DIR, "profile")
    return {
        "stream_ward_energy": (rollups.ward_rollup(meters.withWatermark("ts", "45 minutes"), width="6 hours"), "update"),
        "stream_advisory": (rollups.sliding_advisory_stream(air.withWatermark("ts", "15 minutes"), profile), "update"),
        "stream_aqi_emergency": (processors.aqi_emergency_stream(air.withWatermark("ts", "30 seconds")), "append"),
        "stream_gridlock": (processors.gridlock_stream(signals.withWatermark("ts", "30 seconds"), threshold=60.0), "append"),
        "stream_bunching": (processors.bus_bunching_stream(buses.withWatermark("ts", "30 seconds"), distance=500.0), "append"),
    }


def main() -> None:
    from sensorloom.plans import catalog
    from sensorloom.session import build

    spark = build("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog()
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    queries["zone_stats"].run(spark, SF_DIR).collect()

    def complete(name):
        # Building counts: some queries stage an intermediate result while they are built.
        queries[name].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        times[name] = min(timed(lambda: complete(name)) for _ in range(2))
    rates = {name: round(rows / t) for name, t in times.items()}
    if os.environ.get("BENCH_STREAMS", "1") == "1":
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        for name, (df, mode) in streams(spark, folder).items():
            def run(df=df, mode=mode, name=name):
                df.writeStream.format("noop").outputMode(mode).option(
                    "checkpointLocation", f"{folder}/ck-{name}").trigger(availableNow=True).start().awaitTermination()

            times[name] = timed(run)
            rates[name] = round(rows / times[name])
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "events_per_sec": rates, "events": rows, "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
