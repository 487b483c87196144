"""Helpers that the corpus operators share: tables, staged results, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.sources.staging import staging_dir


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Compute now, keep in the shared folder, go on from the written table.

    Lineage ends here: later steps read the table whichever executors are lost, and values such as row
    numbers are the same for every reader. Shuffle files of the job are of no use then, so Spark is told to remove them.
    """
    path = f"{staging_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs that begin in here leave no shuffle files behind once they have ended."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def discard(df: DataFrame) -> None:
    """Delete a table that `staged` wrote, once all that was made from it is itself written."""
    spark, path = df.sparkSession, getattr(df, "_staged_at", None)
    if path:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def numbered(df: DataFrame, name: str = "row") -> DataFrame:
    """A staged copy with a unique number per row, so that rows that repeat can be told apart."""
    return staged(df.withColumn(name, F.monotonically_increasing_id()))


def free_name(df: DataFrame, name: str = "row") -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of `df` by name, whatever characters the names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph: edges (a, b) of BIGINT -> (node, root), root the smallest node.

    Alternating large and small stars. Every round is two aggregations and two joins over the edges. What a join
    reads is staged, so both its sides are exchanges and adaptive execution can split a crowded node; only the
    number of edges and their checksum reach the driver. Nodes without an edge are
    not listed. An empty edge table gives an empty result. The result is staged.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _checksum(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct())
        discard(least)
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = staged(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _checksum(after)
        for old in (edges, large, least):
            discard(old)
        edges = after
        if state == before:
            break
    out = staged(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
    discard(edges)
    return out


def _checksum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    return row[0], row[1]
