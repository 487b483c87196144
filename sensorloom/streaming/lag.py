"""How far running queries are behind, from the positions in their checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.operators.rollups import lag_report
from sensorloom.sources.offsets import offset_index

POSITION = "topic STRING, partition INT, committed BIGINT"


def last_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """Number of the last batch that a query has finished; none before its first."""
    commits = f"{checkpoint}/commits"
    target = spark._jvm.org.apache.hadoop.fs.Path(commits)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    names = spark.read.text(commits).select(F.col("_metadata.file_name").alias("name"))
    return names.where("name RLIKE '^[0-9]+$'").agg(F.max(F.col("name").cast("long"))).first()[0]


def broker_positions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(topic, partition, committed) of a query on broker topics: one past what it has finished."""
    batch = last_batch(spark, checkpoint)
    if batch is None:
        return spark.createDataFrame([], POSITION)
    ends = spark.read.text(f"{checkpoint}/offsets/{batch}").select(
        F.from_json("value", "map<string, map<string, bigint>>", {"mode": "PERMISSIVE"}).alias("t"))
    return ends.select(F.explode("t").alias("topic", "p")).where("p IS NOT NULL").select("topic", F.explode("p").alias("partition", "committed")).select(
        "topic", F.col("partition").cast("int").alias("partition"), "committed").where("partition IS NOT NULL")


def folder_positions(spark: SparkSession, checkpoint: str, path: str) -> DataFrame:
    """The same for a query on a topic folder: what the files of its finished batches reach, by the folder's index."""
    batch = last_batch(spark, checkpoint)
    if batch is None:
        return spark.createDataFrame([], POSITION)
    seen = spark.read.text(f"{checkpoint}/sources/*/*").where(F.col("value").startswith("{")).select(
        F.from_json("value", "path STRING, batchId BIGINT").alias("s")).where(F.col("s.batchId") <= batch).select(
        F.element_at(F.split("s.path", "/"), -1).alias("file")).distinct()
    return offset_index(spark, path).join(seen, "file", "left_semi").groupBy("topic", "partition").agg((F.max("most") + 1).alias("committed"))


def folder_lag(spark: SparkSession, checkpoint: str, path: str, topics: list[str] | None = None) -> DataFrame:
    """Records that a query on a topic folder has not read yet: by partition, and in all with a null partition.

    The query may be running, paused or gone. Files are read whole, so a partition is behind by the offsets of its unread
    files; a partition not read at all is behind by its newest offset and one.
    """
    heads = offset_index(spark, path).groupBy("topic", "partition").agg((F.max("most") + 1).alias("high"))
    if topics:
        heads = heads.where(F.col("topic").isin(topics))
    return lag_report(heads, folder_positions(spark, checkpoint, path), ["topic", "partition"], "partition")


def broker_lag(spark: SparkSession, checkpoint: str, heads: DataFrame) -> DataFrame:
    """Records that a query on broker topics has not read yet; `heads` has (topic, partition, high)."""
    return lag_report(heads, broker_positions(spark, checkpoint), ["topic", "partition"], "partition")
