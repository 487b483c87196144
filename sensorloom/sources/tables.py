"""Static and archived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.functions.times import format_iso


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headed CSV with declared types; nothing is inferred, so there is no extra pass."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def zone_profile(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.ZONE_PROFILE)


def route_schedule(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.ROUTE_SCHEDULE)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a static or streaming DataFrame available to SQL text."""
    df.createOrReplaceTempView(name)
    return df


def ward_archive(spark: SparkSession, path: str, ward: str | None = None) -> DataFrame:
    """Archived ward summaries; a ward selects its folder (partition pruning)."""
    df = spark.read.schema(schemas.WARD_SUMMARY).parquet(path)
    return df if ward is None else df.where(F.col("ward_id") == ward)


def archive_rows(archive: DataFrame) -> DataFrame:
    """Archive rows in the form the serving merge takes: bounds as ISO text, date filled in."""
    date = F.col("date") if "date" in archive.columns else F.lit(None).cast("string")
    bounds = archive.withColumn("window_start", format_iso(F.date_trunc("second", "window_start"))).withColumn(
        "window_end", format_iso(F.date_trunc("second", "window_end"))
    )
    return bounds.withColumn("date", F.coalesce(date, F.substring("window_start", 1, 10)))
