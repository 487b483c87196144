"""Intermediate results that several parts of a plan read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Folders of single-machine sessions that name none.
_LOCAL: dict[str, str] = {}


def staging_dir(spark: SparkSession) -> str:
    """The shared folder in `spark.checkpoint.dir`.

    Where it is unset a single-machine session gets a folder of its own; on a cluster that would be one folder per
    machine, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = spark.sparkContext.applicationId
        if own not in _LOCAL:
            _LOCAL[own] = tempfile.mkdtemp(prefix="sensorloom-")
        folder = _LOCAL[own]
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute once, write to the shared folder, and go on from the written table.

    For results that are costly to compute, small beside their input and read more than once. The
    written table outlives lost executors, reads back only the columns a reader needs, and its
    size is known to the planner. The job runs when a query is built, and the table stays until the
    folder's owner clears it, as a query may run at any later time. A streaming DataFrame comes back as it is.
    """
    if df.isStreaming:
        return df
    path = f"{staging_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
