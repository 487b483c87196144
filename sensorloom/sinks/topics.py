"""Writing rows to topics, archives and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery



def to_envelope(df: DataFrame, key: str | None = None, columns: list[str] | None = None,
                topic: str | None = None) -> DataFrame:
    """Rows as keyed JSON messages; without a key the key is null."""
    body = F.to_json(F.struct(*(columns or df.columns))).alias("value")
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    out = [k.alias("key"), body]
    if topic:
        out.append(F.lit(topic).alias("topic"))
    return df.select(*out)


def write_topic(messages: DataFrame, topic: str, checkpoint: str, mode: str = "update",
                bootstrap: str | None = None, path: str | None = None, name: str | None = None,
                available_now: bool = False) -> StreamingQuery:
    """Stream messages to a broker topic, or to a folder of envelope files when there is none.

    The folder is written per micro-batch under its batch number, so a batch that is repeated after
    a failure replaces its own files.
    """
    writer = messages.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    if bootstrap:
        return writer.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).start()

    def put(batch: DataFrame, batch_id: int) -> None:
        row = batch.select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
            F.lit(topic).alias("topic"),
            F.spark_partition_id().cast("int").alias("partition"),
            # Unique and increasing within a partition across batches.
            (F.lit(batch_id).cast("bigint") * F.lit(1 << 33)
             + F.monotonically_increasing_id() % F.lit(1 << 33)).alias("offset"),
            F.current_timestamp().alias("timestamp"),
        )
        row.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return writer.foreachBatch(put).start()


def write_archive(df: DataFrame, path: str, checkpoint: str, partitions: list[str] | None = None,
                  name: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Append finished windows to Parquet, by ward and date unless told otherwise."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    ).partitionBy(*(partitions or ["ward_id", "date"]))
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_text_report(lines: DataFrame, path: str, line: str = "line", order: list[str] | None = None) -> None:
    """One text file, in order; for reports of bounded size."""
    ordered = lines.orderBy(*(order or ["position"]))
    ordered.select(F.col(line).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_json_summary(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


