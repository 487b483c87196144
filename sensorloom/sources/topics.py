"""Topics: reading them as streams or as bounded tables, decoding, and looking at their tails.

A topic is read from a broker when `bootstrap` is given, and otherwise from files of envelope rows
(see `schemas.ENVELOPE`), which have the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom import schemas
from sensorloom.functions.times import event_date, parse_iso


def broker_options(bootstrap: str, topics: list[str], starting: str = "latest") -> dict[str, str]:
    """Options of a broker source that tolerates expired offsets; `starting` may be JSON of offsets by partition (see `offsets`)."""
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }


def _with_text(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp",
    )


def stream_topics(spark: SparkSession, topics: list[str], bootstrap: str | None = None,
                  path: str | None = None, starting: str = "latest", fmt: str = "parquet",
                  per_trigger: int | None = None) -> DataFrame:
    """Unbounded reader of one or several topics.

    `per_trigger` bounds a micro-batch: records from a broker, files from a folder. Two readers of
    one topic are independent as long as each has its own checkpoint.
    """
    if bootstrap:
        options = broker_options(bootstrap, topics, starting)
        if per_trigger:
            options["maxOffsetsPerTrigger"] = str(per_trigger)
        return _with_text(spark.readStream.format("kafka").options(**options).load())
    reader = spark.readStream.schema(schemas.ENVELOPE).format(fmt)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path).where(F.col("topic").isin(topics))


def scan_topics(spark: SparkSession, topics: list[str], bootstrap: str | None = None,
                path: str | None = None, starting: str = "earliest", fmt: str = "parquet") -> DataFrame:
    """Everything that is in the topics now, as a bounded table."""
    if bootstrap:
        return _with_text(spark.read.format("kafka").options(**broker_options(bootstrap, topics, starting)).load())
    return spark.read.schema(schemas.ENVELOPE).format(fmt).load(path).where(F.col("topic").isin(topics))


def select_topics(envelope: DataFrame, topics: list[str]) -> DataFrame:
    return envelope.where(F.col("topic").isin(topics))


def decode(envelope: DataFrame, schema: str, ts: str = "event_timestamp", keep: list[str] | None = None,
           record_time_fallback: bool = False) -> DataFrame:
    """JSON value to declared columns, plus event time and date. Unreadable JSON gives nulls."""
    body = F.from_json(F.col("value").cast("string"), T.StructType.fromDDL(schema)).alias("data")
    opened = envelope.select(*(keep or []), F.col("timestamp").alias("_record_time"), body)
    opened = opened.select(*(keep or []), "_record_time", "data.*")
    fallback = "_record_time" if record_time_fallback else None
    return opened.withColumn(ts, parse_iso("timestamp", fallback)).drop("_record_time").withColumn(
        "date", event_date(ts)
    )


def tail(envelope: DataFrame, n: int = 10_000, keys: list[str] | None = None,
         offset: str = "offset") -> DataFrame:
    """Records among the last n offsets of each partition.

    Like seeking to head - n, this counts offsets, so gaps left by compaction shorten the result.
    Heads are one row per partition; nothing is sorted.
    """
    keys = keys or ["topic", "partition"]
    heads = envelope.groupBy(*keys).agg((F.max(offset) + 1).alias("_high"))
    return envelope.join(heads, keys).where(F.col(offset) >= F.col("_high") - n).drop("_high")


def tail_total(envelope: DataFrame, total: int, topic: str = "topic",
               offset: str = "offset") -> DataFrame:
    """About `total` newest records of a topic: max(total // partitions, 1) from each partition."""
    heads = envelope.groupBy(topic, "partition").agg((F.max(offset) + 1).alias("_high"))
    share = F.greatest(F.floor(F.lit(total) / F.count("*").over(Window.partitionBy(topic))), F.lit(1))
    keys, bounds = [topic, "partition"], heads.withColumn("_each", share)
    return envelope.join(bounds, keys).where(
        F.col(offset) >= F.col("_high") - F.col("_each")
    ).drop("_high", "_each")


def capped(envelope: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """First n records in partition and offset order (top-n per task, then merged)."""
    return envelope.orderBy(*(order or ["partition", "offset"])).limit(n)
