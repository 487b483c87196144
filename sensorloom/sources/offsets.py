"""Topics kept as files, with an index of the offsets in each file.

A tail of such a topic looks into the index, which has a row for each file and partition, and opens only the
files that hold offsets of the tail. The index is a table beside the data; files that were added since are taken in
when it is next used.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom import schemas

INDEX = "_offsets"  # a name that readers of the folder pass over
INDEX_ROW = "file STRING, path STRING, topic STRING, partition INT, least BIGINT, most BIGINT"
FEW = 64  # partitions whose bounds go into the scan's filter one by one


def write_topic(envelope: DataFrame, path: str, files: int | None = None) -> None:
    """Add records to a topic folder, `files` files with records of a partition in offset order."""
    order = ["topic", "partition", "offset"]
    dealt = envelope.repartitionByRange(files, *order) if files else envelope.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode("append").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def offset_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, path, topic, partition, least, most) of all files of a topic folder, brought up to date.

    Only topic, partition and offset of files not yet in the index are read. Two sessions may add the same
    file; its rows are then equal, and one of them is returned.
    """
    place = f"{path}/{INDEX}"
    files = {f.rpartition("/")[2]: f for f in spark.read.schema(schemas.ENVELOPE).parquet(path).inputFiles()}
    known = set()
    if _exists(spark, place):
        known = {r.file for r in spark.read.schema(INDEX_ROW).parquet(place).select("file").distinct().collect()}
    fresh = [f for name, f in sorted(files.items()) if name not in known]
    if fresh:
        spark.read.schema(schemas.ENVELOPE).parquet(*fresh).select(
            F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("path"), "topic", "partition", "offset"
        ).groupBy("file", "path", "topic", "partition").agg(
            F.min("offset").alias("least"), F.max("offset").alias("most")).coalesce(1).write.mode("append").parquet(place)
    return spark.read.schema(INDEX_ROW).parquet(place).distinct()


def tail_bounds(index: DataFrame, topics: list[str], n: int | None = None, total: int | None = None) -> DataFrame:
    """(topic, partition, low): the last `n` offsets of each partition, or its share of about `total` of its topic."""
    heads = index.where(F.col("topic").isin(topics)).groupBy("topic", "partition").agg((F.max("most") + 1).alias("high"))
    if n is None:
        shares = heads.groupBy("topic").agg(F.greatest(F.floor(F.lit(total) / F.count("*")), F.lit(1)).alias("n"))
        heads = heads.join(shares, "topic")
    else:
        heads = heads.withColumn("n", F.lit(n))
    return heads.select("topic", "partition", (F.col("high") - F.col("n")).alias("low"))


def tail_of(spark: SparkSession, path: str, topics: list[str], n: int | None = None, total: int | None = None) -> DataFrame:
    """Newest records of topics in a folder: the last `n` offsets of each partition, or about `total` of each topic.

    Files come from the index, so what is read does not grow with the topic. The bounds are in the scan's filter; they
    also reach row groups within a file. Offsets count as in `topics.tail`. A topic without records gives no rows.
    """
    if (n is None) == (total is None):
        raise ValueError("give either n or total")
    index = offset_index(spark, path)
    bounds = tail_bounds(index, topics, n, total)
    # A row for each partition and file of the tail: as many as partitions and what they hold in n offsets.
    chosen = index.join(bounds, ["topic", "partition"]).where(F.col("most") >= F.col("low")).select(
        "path", "topic", "partition", "low").collect()
    if not chosen:
        return spark.createDataFrame([], schemas.ENVELOPE)
    lows = {(r.topic, r.partition): r.low for r in chosen}
    rows = spark.read.schema(schemas.ENVELOPE).parquet(*sorted({r.path for r in chosen}))
    rows = rows.where(F.col("topic").isin(topics) & (F.col("offset") >= min(lows.values())))
    if len(lows) <= FEW:
        own = [(F.col("topic") == t) & (F.col("partition") == p) & (F.col("offset") >= low) for (t, p), low in sorted(lows.items())]
        return rows.where(reduce(or_, own))
    return rows.join(bounds, ["topic", "partition"]).where(F.col("offset") >= F.col("low")).drop("low").select(*rows.columns)


def starting_offsets(lows: dict[tuple[str, int], int]) -> str:
    """A broker source's `startingOffsets`: where to begin in each partition."""
    by_topic: dict[str, dict[str, int]] = {}
    for (topic, partition), low in sorted(lows.items()):
        by_topic.setdefault(topic, {})[str(partition)] = max(0, low)
    return json.dumps(by_topic)


def broker_tail(heads: dict[tuple[str, int], int], n: int) -> str:
    """`startingOffsets` of the last `n` offsets of each partition, from one past each partition's newest offset."""
    return starting_offsets({place: high - n for place, high in heads.items()})
