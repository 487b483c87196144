"""Relational ingest: one table per stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom import schemas
from sensorloom.functions.times import parse_iso
from sensorloom.functions.values import first_non_empty
from sensorloom.sinks.batch_log import BatchLog
from sensorloom.sources.staging import staging_dir

_INCIDENT_WIRE = (
    "incident_id STRING, incident_type STRING, severity STRING, description STRING, "
    "sensor_id STRING, junction_id STRING, route_id STRING, event_timestamp STRING, timestamp STRING"
)


def project(envelope: DataFrame, stream: str, ingest_time: Column | None = None) -> DataFrame:
    """Rows of one stream's topic in the columns of its table.

    A missing event time becomes the time of ingest. Readings without an index are left out, and
    so are messages that are not JSON.
    """
    _, columns = schemas.RELATIONAL[stream]
    wire = schemas.WIRE.get(stream, _INCIDENT_WIRE)
    body = F.from_json("value", T.StructType.fromDDL(wire))
    # Keys are null for text that is not a JSON object.
    readable = F.json_object_keys("value").isNotNull()
    rows = envelope.where((F.col("topic") == stream) & readable).select(body.alias("d")).select("d.*")
    now = F.current_timestamp() if ingest_time is None else ingest_time
    text = F.nullif("timestamp", F.lit(""))
    if stream == "incidents":
        text = F.coalesce(text, F.nullif("event_timestamp", F.lit("")))
        rows = rows.withColumn("key_id", first_non_empty("sensor_id", "junction_id", "route_id"))
    if stream == "air_quality":
        rows = rows.where(F.col("aqi").isNotNull())
    rows = rows.withColumn("timestamp", F.coalesce(parse_iso(text), now))
    return rows.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(columns).fields
    ])


def jdbc_writer(url: str, properties: dict[str, str] | None = None) -> Callable[[DataFrame, str], None]:
    def write(df: DataFrame, table: str) -> None:
        df.write.jdbc(url, table, mode="append", properties=properties or {})

    return write


def ingest_batch(write: Callable[[DataFrame, str], None], streams: list[str] | None = None,
                 commit: Callable[[int, dict[str, str]], None] | None = None, log: str | None = None):
    """A `foreachBatch` function that splits a multi-topic batch over its tables, each row once.

    Without `commit` a write-ahead log does it. First the rows of all tables are kept in the folder `log`, and an entry
    says that they are whole; from then on a repeated batch inserts these rows, times of ingest included. Then `write(rows, table)`
    is called for each table that has no entry of this batch yet, and its entry is made. A batch with a last entry is passed over. A
    table counts as written when `write` returns; a database that may have taken rows although `write` failed needs `commit`. Give
    every query a folder of its own; by default it is one in the session's shared folder.

    With `commit`, `write` gets the name of a staging table of this batch, which it must overwrite, and `commit(batch_id, {staging:
    table})` is called once at the end: it inserts from all staging tables and records the batch in one transaction
    of the database, and does nothing for a batch that is on record.
    """
    tables = {s: schemas.RELATIONAL[s][0] for s in streams or list(schemas.RELATIONAL)}

    def with_log(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        book = BatchLog(spark, log or f"{staging_dir(spark)}/relational-ingest")
        if book.has(f"{batch_id}-done"):
            return
        if not book.has(f"{batch_id}-kept"):
            batch.persist()
            try:
                for stream, table in tables.items():
                    book.keep(project(batch, stream), f"{batch_id}/{table}")
            finally:
                batch.unpersist()
            book.record(f"{batch_id}-kept")
        for table in tables.values():
            if not book.has(f"{batch_id}-{table}"):
                write(book.kept(f"{batch_id}/{table}"), table)
                book.record(f"{batch_id}-{table}")
        book.record(f"{batch_id}-done")
        book.forget(str(batch_id))

    def with_commit(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            staged = {}
            for stream, table in tables.items():
                place = f"{table}_batch_{batch_id}"
                write(project(batch, stream), place)
                staged[place] = table
            commit(batch_id, staged)
        finally:
            batch.unpersist()

    return with_commit if commit else with_log
