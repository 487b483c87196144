"""Serving: finished (archive) and in-progress (topic) views of the same windows, as one view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.times import render_in_zone
from sensorloom.functions.values import null_like_to

SUMMARY = ["ward_id", "date", "total_kwh_consumed", "avg_power_factor", "peak_voltage"]


def _bounds(df: DataFrame, zone: str, suffix: str) -> DataFrame:
    return df.withColumn("window_start", render_in_zone("window_start", zone, suffix)).withColumn(
        "window_end", render_in_zone("window_end", zone, suffix)
    )


def merge_views(archive: DataFrame, topic: DataFrame, order: list[str], mode: str = "both",
                layer_from: str = "source", keys: list[str] | None = None,
                zone: str = "Asia/Kolkata", suffix: str = "+05:30") -> DataFrame:
    """One row per window and layer slot (`both`), or per window with archive rows first
    (`batch_wins`); the newest topic row (by `order`) wins within a slot.

    A row's slot is the side it came from; `layer_from='record'` uses its own tag instead. The
    choice is a max over (priority, order), combined on the map side.
    """
    keys = keys or ["ward_id"]
    cols = ["window_start", "window_end", *SUMMARY, "source_layer"]
    a = archive.select(
        *cols, F.lit("BATCH").alias("slot"), *[F.lit(None).cast(topic.schema[c].dataType).alias(c) for c in order]
    )
    tagged = topic.withColumn("source_layer", null_like_to("source_layer", "SPEED"))
    s = tagged.select(*cols, F.lit("SPEED").alias("slot"), *order)
    both = _bounds(a.unionByName(s), zone, suffix).where(F.col("window_start") != "")
    if layer_from == "record":
        both = both.withColumn("slot", F.when(F.col("source_layer") == "BATCH", "BATCH").otherwise("SPEED"))
    group = [*keys, "window_start"] + (["slot"] if mode == "both" else [])
    values = [c for c in both.columns if c not in group and c not in order]
    # Archive rows carry no order; the whole row breaks ties so the result does not vary.
    priority = F.struct((F.col("slot") == "BATCH").cast("int"), *order, *values)
    best = both.groupBy(*group).agg(F.max_by(F.struct(*values), priority).alias("_r"))
    return best.select(*group, "_r.*").select(*cols, "slot").orderBy(
        "window_start", F.when(F.col("source_layer") == "BATCH", 0).otherwise(1), *keys
    )


def ward_view(archive: DataFrame, topic: DataFrame, ward: str, order: list[str], **options) -> DataFrame:
    """The merged view of one ward; both filters reach their scans."""
    return merge_views(
        archive.where(F.col("ward_id") == ward), topic.where(F.col("ward_id") == ward), order, **options
    )


def summary_rows(envelope: DataFrame) -> DataFrame:
    """Ward summaries from their JSON messages, with the record's coordinates; bounds stay text."""
    body = ("window_start STRING, window_end STRING, ward_id STRING, date STRING, total_kwh_consumed DOUBLE, "
            "avg_power_factor DOUBLE, peak_voltage DOUBLE, source_layer STRING")
    return envelope.select("partition", "offset", "timestamp", F.from_json("value", body).alias("d")).select(
        "partition", "offset", "timestamp", "d.*").where(F.col("window_start").isNotNull())


def query_ward(spark: SparkSession, archive: str, topic: DataFrame | str, ward: str, total: int | None = 10_000,
               order: list[str] | None = None, name: str = "ward_energy_summary", **options) -> DataFrame:
    """The serving view of one ward: its folders of the archive at a path, and about `total` newest topic records.

    The archive scan is pruned to the ward; of the topic only the tail is decoded, and of a topic folder only the files of
    the tail are opened. Without a `total` the whole topic is. Options are those of `merge_views`.
    """
    from sensorloom.sources.offsets import tail_of
    from sensorloom.sources.tables import archive_rows, ward_archive
    from sensorloom.sources.topics import scan_topics, tail_total

    if isinstance(topic, str):
        newest = scan_topics(spark, [name], path=topic) if total is None else tail_of(spark, topic, [name], total=total)
    else:
        newest = topic if total is None else tail_total(topic, total)
    return ward_view(archive_rows(ward_archive(spark, archive)), summary_rows(newest), ward,
                     order or ["timestamp", "offset"], **options)


def anchored_series(merged: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Chart series: the last BATCH point is repeated as the first SPEED point of its key.

    Only keys that have both layers get an anchor. Distinct rows.
    """
    keys = keys or ["ward_id"]
    points = merged.select(*keys, "window_start", "total_kwh_consumed", "source_layer")
    ends = points.groupBy(*keys).agg(
        F.max_by(
            F.struct("window_start", "total_kwh_consumed"),
            F.when(F.col("source_layer") == "BATCH", F.struct("window_start", "total_kwh_consumed")),
        ).alias("_last"),
        F.count_if(F.col("source_layer") == "BATCH").alias("_b"),
        F.count_if(F.col("source_layer") == "SPEED").alias("_s"),
    ).where((F.col("_b") > 0) & (F.col("_s") > 0))
    anchors = ends.select(*keys, "_last.*", F.lit("SPEED").alias("source_layer"))
    layers = points.where(F.col("source_layer").isin("BATCH", "SPEED"))
    return layers.unionByName(anchors).dropDuplicates()
