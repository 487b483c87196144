"""Aggregations. All of them combine on the map side, so a hot group costs no more than others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.times import event_date, micros
from sensorloom.functions.values import advisory_level, round_half_up, safe_ratio


def ward_rollup(df: DataFrame, ts: str = "ts", ward: str = "ward_id", kwh: str = "kwh_reading",
                power_factor: str = "power_factor", voltage: str = "voltage",
                width: str = "15 minutes", layer: str = "BATCH", per_meter: str | None = None,
                rounding: bool = True) -> DataFrame:
    """Tumbling energy rollup by (window, ward, date); batch and streaming.

    Consumption is the spread of the cumulative readings in the window, as specified over all
    meters of the ward. `per_meter` names the meter column for the spread per meter, summed
    (batch only: two aggregations).
    """
    rows = df.withColumn("date", event_date(ts)).groupBy(F.window(ts, width), F.col(ward), F.col("date"))
    if per_meter is None:
        agg = rows.agg(
            (F.max(kwh) - F.min(kwh)).alias("total_kwh_consumed"),
            F.avg(power_factor).alias("avg_power_factor"),
            F.max(voltage).alias("peak_voltage"),
        )
    else:
        meters = df.withColumn("date", event_date(ts)).groupBy(
            F.window(ts, width), F.col(ward), F.col("date"), F.col(per_meter)
        ).agg(
            (F.max(kwh) - F.min(kwh)).alias("spread"),
            F.sum(power_factor).alias("pf_sum"), F.count(power_factor).alias("pf_n"),
            F.max(voltage).alias("v"),
        )
        agg = meters.groupBy("window", ward, "date").agg(
            F.sum("spread").alias("total_kwh_consumed"),
            (F.sum("pf_sum") / F.nullif(F.sum("pf_n"), F.lit(0))).alias("avg_power_factor"),
            F.max("v").alias("peak_voltage"),
        )
    r = round_half_up if rounding else (lambda c, _: F.col(c))
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col(ward).alias("ward_id"),
        "date",
        r("total_kwh_consumed", 2).alias("total_kwh_consumed"),
        r("avg_power_factor", 3).alias("avg_power_factor"),
        r("peak_voltage", 1).alias("peak_voltage"),
        F.lit(layer).alias("source_layer"),
    )


def ward_running(df: DataFrame, order: list[str], ts: str = "ts", ward: str = "ward_id",
                 kwh: str = "kwh_reading", power_factor: str = "power_factor",
                 voltage: str = "voltage", width: str = "15 minutes") -> DataFrame:
    """The rollup as it stood after every single event (unrounded, SPEED layer).

    The sort group is one ward in one window, so a hot ward is spread over its windows.
    """
    framed = df.where(
        F.col(ward).isNotNull() & F.col(kwh).isNotNull() & F.col(power_factor).isNotNull()
        & F.col(voltage).isNotNull() & F.col(ts).isNotNull()
    ).withColumn("window", F.window(ts, width))
    w = Window.partitionBy("window", ward).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return framed.select(
        *order,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col(ward).alias("ward_id"),
        event_date(F.col("window.start")).alias("date"),
        (F.max(kwh).over(w) - F.min(kwh).over(w)).alias("total_kwh_consumed"),
        F.avg(power_factor).over(w).alias("avg_power_factor"),
        F.max(voltage).over(w).alias("peak_voltage"),
        F.lit("SPEED").alias("source_layer"),
    )


ADVISORY_MEASURES = ("aqi", "pm25", "pm10", "no2")


def settled(mean: str) -> Column:
    """A mean without the last digits, which depend on the order in which its sums met; limits compare this."""
    return F.round(mean, 9)


def advisory_select(means: DataFrame, threshold: float = 150.0) -> DataFrame:
    """HAVING, rounding and banding on the unrounded means `avg_<measure>`."""
    kept = means.where(settled("avg_aqi") > threshold)
    return kept.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "zone", "zone_name", "population", "num_schools", "num_hospitals",
        *[round_half_up(f"avg_{m}", 1).alias(f"rolling_avg_{m}") for m in ADVISORY_MEASURES],
        advisory_level(settled("avg_aqi")).alias("advisory_level"),
    )


PROFILE_COLUMNS = ["zone", "zone_name", "population", "num_schools", "num_hospitals"]


def sliding_advisory(air: DataFrame, profile: DataFrame, ts: str = "ts",
                     width: str = "10 minutes", slide: str = "1 minute",
                     threshold: float = 150.0) -> DataFrame:
    """Sliding means by zone, joined to the zone profile (batch form).

    Rows are first summed into panes one slide long; only panes are copied into the windows that
    cover them. The profile joins after the last aggregation, on (window, zone) rows.
    """
    panes_per_window = micros(width) // micros(slide)
    if panes_per_window * micros(slide) != micros(width):
        raise ValueError("the slide must divide the window")
    sums = []
    for m in ADVISORY_MEASURES:
        sums += [F.sum(m).alias(f"sum_{m}"), F.count(m).alias(f"n_{m}")]
    panes = air.where(F.col("aqi").isNotNull()).groupBy("zone", F.window(ts, slide).alias("pane")).agg(*sums)
    steps = F.explode(F.sequence(F.lit(0), F.lit(panes_per_window - 1))).alias("step")
    start = F.timestamp_micros(
        F.unix_micros("pane.start") - F.col("step").cast("bigint") * F.lit(micros(slide))
    )
    copies = panes.select("*", steps).withColumn(
        "window",
        F.struct(start.alias("start"),
                 F.timestamp_micros(F.unix_micros(start) + F.lit(micros(width))).alias("end")),
    )
    means = copies.groupBy("window", "zone").agg(*[
        (F.sum(f"sum_{m}") / F.nullif(F.sum(f"n_{m}"), F.lit(0))).alias(f"avg_{m}")
        for m in ADVISORY_MEASURES
    ])
    hot = means.where(settled("avg_aqi") > threshold)
    return advisory_select(hot.join(profile.select(*PROFILE_COLUMNS), "zone"), threshold)


def sliding_advisory_stream(air: DataFrame, profile: DataFrame, ts: str = "ts",
                            width: str = "10 minutes", slide: str = "1 minute",
                            threshold: float = 150.0) -> DataFrame:
    """Streaming form: one stateful aggregation, grouped by the window column itself.

    Grouping by its start and end would lose the watermark, and state would never be dropped.
    """
    joined = air.where(F.col("aqi").isNotNull()).join(profile.select(*PROFILE_COLUMNS), "zone")
    means = joined.groupBy(F.window(ts, width, slide), *PROFILE_COLUMNS).agg(
        *[F.avg(m).alias(f"avg_{m}") for m in ADVISORY_MEASURES]
    )
    return advisory_select(means, threshold)


def distribution(df: DataFrame, column: str, missing: str, out: str | None = None) -> DataFrame:
    """Count and share per value, most frequent first; ties in name order.

    The share's window runs over the finished counts, one row per distinct value.
    """
    out = out or column
    counts = df.groupBy(F.coalesce(F.col(column), F.lit(missing)).alias(out)).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(
        out, "n", round_half_up(F.col("n") / total * 100, 2).alias("percent")
    ).orderBy(F.desc("n"), out)


def zone_stats(df: DataFrame, zone: str = "zone", vehicles: str = "vehicle_count",
               wait: str = "avg_wait_sec", threshold: float = 180.0,
               window: Column | None = None) -> DataFrame:
    """Traffic figures per zone; a missing number counts as 0, a missing zone as 'unknown'.

    `window` (for example an hourly window) adds a time key. Batch and streaming.
    """
    v, w = F.coalesce(F.col(vehicles), F.lit(0)), F.coalesce(F.col(wait), F.lit(0.0))
    keys = [F.coalesce(F.col(zone), F.lit("unknown")).alias("zone")]
    if window is not None:
        keys.insert(0, window.alias("window"))
    grouped = df.groupBy(*keys).agg(
        F.count("*").alias("events"),
        round_half_up(F.avg(v), 1).alias("avg_vehicle_count"),
        round_half_up(F.avg(w), 1).alias("avg_wait_sec"),
        F.greatest(F.lit(0.0), F.max(w)).alias("max_wait_sec"),
        F.count_if(w > threshold).alias("gridlock_count"),
    )
    return grouped


def breach_counts(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.agg(
        F.count("*").alias("events_processed"),
        F.count_if(F.coalesce(F.col(column), F.lit(0.0)) > threshold).alias("breaches"),
    )


def lag_report(heads: DataFrame, committed: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """Lag per partition, and a total row (null partition) per group of the other keys."""
    from sensorloom.operators.joins import offsets_against_heads

    lag = offsets_against_heads(heads, committed, keys).withColumn(
        "lag", F.greatest(F.lit(0), F.col("high") - F.col("committed"))
    )
    outer = [k for k in keys if k != partition]
    return lag.groupingSets([[*outer, partition], outer], *outer, partition).agg(
        F.sum("committed").alias("committed"), F.sum("high").alias("high"), F.sum("lag").alias("lag")
    )


def partition_heads(df: DataFrame, keys: list[str], offset: str = "offset") -> DataFrame:
    """Earliest offset, next offset and their distance for each partition."""
    return df.groupBy(*keys).agg(
        F.min(offset).alias("earliest"), (F.max(offset) + 1).alias("high")
    ).withColumn("messages", F.col("high") - F.col("earliest"))


def partition_stats(df: DataFrame, topic: str = "topic", partition: str = "partition",
                    offset: str = "offset") -> DataFrame:
    """Per partition and, with a null partition, per topic."""
    per = partition_heads(df, [topic, partition], offset)
    return per.groupingSets([[topic, partition], [topic]], topic, partition).agg(
        F.count("*").alias("partitions"), F.min("earliest").alias("earliest"),
        F.max("high").alias("latest"), F.sum("messages").alias("messages"),
    )


def hit_rate(df: DataFrame, matched: str = "matched") -> DataFrame:
    return df.agg(
        F.count("*").alias("processed"),
        F.count_if(F.col(matched)).alias("enriched"),
        F.count_if(~F.col(matched)).alias("unenriched"),
    ).withColumn(
        "join_rate", round_half_up(safe_ratio(F.col("enriched") * 100.0, "processed"), 1)
    )


def feed_quality(air: DataFrame, aqi: str = "aqi", spike: float = 300.0) -> DataFrame:
    """Rows sent, missing readings with their share, and spikes."""
    return air.agg(
        F.count("*").alias("sent"),
        F.count_if(F.col(aqi).isNull()).alias("null_aqi"),
        F.count_if(F.col(aqi) > spike).alias("spikes"),
    ).withColumn("null_percent", round_half_up(safe_ratio(F.col("null_aqi") * 100.0, "sent"), 1))


def throughput(df: DataFrame, ts: str = "ts", key: str | None = None) -> DataFrame:
    """Records per second of the covered time span (at least one second)."""
    grouped = df.groupBy(key) if key else df.groupBy()
    span = (F.unix_millis(F.max(ts)) - F.unix_millis(F.min(ts))) / 1000.0
    return grouped.agg(
        F.count("*").alias("records"), span.alias("elapsed_sec")
    ).withColumn("records_per_sec", round_half_up(safe_ratio("records", "elapsed_sec"), 6))


def latency_stats(df: DataFrame, event_time: str, processed_time: str, key: str | None = None) -> DataFrame:
    """Mean and largest delay from event to processing, in milliseconds."""
    grouped = df.groupBy(key) if key else df.groupBy()
    delay = F.unix_millis(processed_time) - F.unix_millis(event_time)
    return grouped.agg(
        F.count("*").alias("events_processed"),
        round_half_up(F.avg(delay), 3).alias("avg_latency_ms"),
        F.max(delay).alias("max_latency_ms"),
    )


def distinct_keys(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Number of distinct values per column; `approximate` is the form a stream supports.

    Exact counts de-duplicate per column on the map side; there is no expand-and-sort of all rows
    for every column at once.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    parts = [df.select(c).distinct().agg(F.count(c).alias(c)) for c in columns]
    pairs = [p.select(F.lit(c).alias("key"), F.col(c).alias("n")) for c, p in zip(columns, parts)]
    out = pairs[0]
    for p in pairs[1:]:
        out = out.union(p)
    return out


def calendar_rollup(summary: DataFrame, start: str = "window_start", ward: str = "ward_id",
                    kwh: str = "total_kwh_consumed") -> DataFrame:
    """Weekly and monthly totals per ward over the archived windows."""
    dated = summary.select(
        ward, kwh, "peak_voltage",
        F.date_trunc("month", start).alias("month"), F.date_trunc("week", start).alias("week"),
    )
    weekly = dated.groupBy(ward, "month", "week").agg(
        F.sum(kwh).alias("kwh"), F.max("peak_voltage").alias("peak"), F.count("*").alias("windows")
    )
    return weekly.groupingSets([[ward, "month", "week"], [ward, "month"]], ward, "month", "week").agg(
        round_half_up(F.sum("kwh"), 2).alias("total_kwh_consumed"),
        F.max("peak").alias("peak_voltage"), F.sum("windows").alias("windows"),
    )


def distinct_sketches(df: DataFrame, column: str, keys: list[str], ts: str = "ts", width: str = "1 hour", detail: int = 14) -> DataFrame:
    """Mergeable sketches of a column's distinct values: (keys, window_start, date, sketch BINARY), one small row per window.

    Kept in an archive they give the number of distinct values of any span of windows (`distinct_over`) without the rows.
    `detail` is the logarithm of a sketch's size: at 14 the error is under 1 % in two of three cases. Null values do not
    count; a window without values has no row.
    """
    start = F.window(ts, width).getField("start")
    return df.where(F.col(column).isNotNull() & F.col(ts).isNotNull()).groupBy(*keys, start.alias("window_start")).agg(
        F.hll_sketch_agg(F.col(column), F.lit(detail)).alias("sketch")).withColumn("date", event_date("window_start"))


def distinct_over(sketches: DataFrame, keys: list[str], since: str | None = None, until: str | None = None) -> DataFrame:
    """(keys, distinct_values): about how many distinct values the windows from `since` on and before `until` hold together."""
    span = sketches
    if since is not None:
        span = span.where((F.col("window_start") >= F.lit(since)) & (F.col("date") >= F.lit(since[:10])))
    if until is not None:
        span = span.where((F.col("window_start") < F.lit(until)) & (F.col("date") <= F.lit(until[:10])))
    return span.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
