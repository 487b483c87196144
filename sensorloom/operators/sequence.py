"""Operators on the order of events within a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.operators.slices import CARRY, SLICE, add_slice, carry_rows, join_summary, ordering, running_number

DEFAULT_SLICE = "6 hours"


def consecutive_breach(df: DataFrame, keys: list[str], order: list[str], value: str,
                       threshold: float, n: int = 3, ts: str = "ts",
                       slice_width: str = DEFAULT_SLICE) -> DataFrame:
    """Rows at which the last n values of the key, this one included, all exceed the threshold.

    A missing value counts as 0. Adds `recent` (the n values, oldest first) and `recent_mean`.
    """
    rows = add_slice(df, ts, slice_width).withColumn("_v", F.coalesce(F.col(value), F.lit(0.0)))
    carried = carry_rows(rows, keys, order, n - 1)
    frame = Window.partitionBy(*keys, SLICE).orderBy(*ordering(order)).rowsBetween(1 - n, 0)
    flagged = carried.select(
        "*",
        F.count("*").over(frame).alias("_n"),
        F.min("_v").over(frame).alias("_low"),
        F.collect_list("_v").over(frame).alias("recent"),
    )
    kept = flagged.where(~F.col(CARRY) & (F.col("_n") == n) & (F.col("_low") > threshold))
    mean = F.aggregate("recent", F.lit(0.0), lambda acc, v: acc + v) / n
    return kept.withColumn("recent_mean", mean).drop(SLICE, CARRY, "_v", "_n", "_low")


def dwell_episodes(df: DataFrame, keys: list[str], order: list[str], condition, ts: str = "ts",
                   slice_width: str = DEFAULT_SLICE) -> DataFrame:
    """Longest runs of rows with `condition` true, one output row per run.

    Runs are cut per slice first. Only runs that touch the border of a slice are then joined up,
    at most two per (key, slice).
    """
    rows = add_slice(df, ts, slice_width).select(
        *keys, SLICE, *order, F.coalesce(condition, F.lit(False)).alias("_on"), F.col(ts).alias("_ts")
    )
    w = Window.partitionBy(*keys, SLICE).orderBy(*ordering(order))
    cut = rows.withColumn(
        "_brk", F.count_if(~F.col("_on")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("_brks", F.count_if(~F.col("_on")).over(Window.partitionBy(*keys, SLICE)))
    pieces = cut.groupBy(*keys, SLICE, "_brk").agg(
        F.max("_brks").alias("_brks"), F.count_if("_on").alias("_rows"),
        F.min(F.when(F.col("_on"), F.col("_ts"))).alias("_start"),
        F.max(F.when(F.col("_on"), F.col("_ts"))).alias("_end"),
    )
    inner = pieces.where((F.col("_brk") > 0) & (F.col("_brk") < F.col("_brks")) & (F.col("_rows") > 0))
    # Border pieces stay in even when they hold no rows of the run: they separate their neighbours.
    border = pieces.where((F.col("_brk") == 0) | (F.col("_brk") == F.col("_brks")))
    by_key = Window.partitionBy(*keys).orderBy(SLICE, "_brk")
    starts = (F.col("_brk") > 0) | (F.col("_rows") == 0) | (F.coalesce(F.lag("_rows").over(by_key), F.lit(0)) == 0)
    joined = border.withColumn("_new", starts.cast("int")).withColumn(
        "_run", F.sum("_new").over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    ).where(F.col("_rows") > 0).groupBy(*keys, "_run").agg(
        F.sum("_rows").alias("_rows"), F.min("_start").alias("_start"), F.max("_end").alias("_end")
    )
    return inner.select(*keys, "_start", "_end", "_rows").unionByName(
        joined.select(*keys, "_start", "_end", "_rows")
    ).select(
        *keys, F.col("_start").alias("first_seen"), F.col("_end").alias("last_seen"),
        F.col("_rows").alias("observations"),
        ((F.unix_millis("_end") - F.unix_millis("_start")) / 1000.0).alias("duration_sec"),
    )


def samples_per_group(df: DataFrame, keys: list[str], order: list[str], n: int = 3) -> DataFrame:
    """First n rows per key. Spark cuts each task to n rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*ordering(order))
    return df.withColumn("sample", F.row_number().over(w)).where(F.col("sample") <= n)


def last_position(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Most recent values per key, combined on the map side."""
    newest = F.max_by(F.struct(*order, *columns), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(newest).select(*keys, "_last.*")


def cumulative_count(df: DataFrame, keys: list[str], order: list[str], ts: str = "ts",
                     slice_width: str = DEFAULT_SLICE, out: str = "total") -> DataFrame:
    return running_number(add_slice(df, ts, slice_width), keys, order, out).drop(SLICE)


def elapsed_in_series(df: DataFrame, keys: list[str], ts: str = "ts", out: str = "elapsed_sec") -> DataFrame:
    """Whole seconds since the first point of the series.

    Aggregate and join, not a window: the first times are one row per series, and a hot series
    stays spread over all tasks.
    """
    first = df.groupBy(*keys).agg(F.min(ts).alias("_first"))
    seconds = (F.unix_millis(ts) - F.unix_millis("_first")) / 1000.0
    return join_summary(df, first, keys).withColumn(out, F.round(seconds, 0).cast("bigint")).drop("_first")


def latest_record(df: DataFrame, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """The newest row, over all or per key."""
    keys = keys or []
    newest = F.max_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(newest).select(*keys, "_r.*")


def impute_from_neighbours(df: DataFrame, keys: list[str], value: str, ts: str = "ts",
                           range_width: str = "10 minutes", slice_width: str = DEFAULT_SLICE,
                           out: str = "imputed") -> DataFrame:
    """Fill a missing value with the mean of the key's values in the time before it.

    A row also takes part in the following slice when it is within reach of it, so the frame never
    needs the whole key.
    """
    from sensorloom.functions.times import micros

    reach, width = micros(range_width), micros(slice_width)
    if reach > width:
        raise ValueError("the range must not exceed the slice")
    us = F.unix_micros(ts)
    sliced = add_slice(df, ts, slice_width).withColumn("_us", us)
    near_end = F.pmod(us, F.lit(width)) >= F.lit(width - reach)
    copies = sliced.where(near_end & F.col(value).isNotNull()).withColumn(SLICE, F.col(SLICE) + 1)
    rows = sliced.withColumn(CARRY, F.lit(False)).unionByName(copies.withColumn(CARRY, F.lit(True)))
    frame = Window.partitionBy(*keys, SLICE).orderBy("_us").rangeBetween(-reach, 0)
    mean = F.avg(value).over(frame)
    return rows.withColumn(out, F.coalesce(F.col(value), mean)).where(~F.col(CARRY)).drop(SLICE, CARRY, "_us")
