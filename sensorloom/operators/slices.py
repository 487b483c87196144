"""Running a key's ordered work in time slices instead of in one task.

A window partitioned by an entity sends every row of that entity to one task. When one entity
may hold a large part of the data, that task sets the run time. Here rows are grouped by (key,
slice of time); what must cross a slice border travels as a few rows per (key, slice):

* `carry_rows` copies the last n rows before a slice into it, for frames that look back n rows
  (or forward, with `reverse`);
* `slice_prefix` sums per-slice totals, for counts from the beginning.

Only per-slice summaries are ever ordered by key alone, so the largest single group has as many
rows as the time span has slices.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.times import micros, slice_number

SLICE = "_slice"
CARRY = "_carry"


def add_slice(df: DataFrame, ts: str, width: str) -> DataFrame:
    return df.withColumn(SLICE, slice_number(ts, micros(width)))


def ordering(order: list[str], reverse: bool = False):
    return [F.col(c).desc() if reverse else F.col(c).asc() for c in order]


def join_summary(df: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """Add a summary's columns to the rows of its keys. Null keys and null slices meet too, as in a window."""
    right = summary.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in summary.columns if c not in keys])
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return df.join(right, on).drop(*[f"_of_{k}" for k in keys])


def carry_rows(df: DataFrame, keys: list[str], order: list[str], n: int,
               reverse: bool = False) -> DataFrame:
    """`df` (with its slice column) plus, in each slice, the n rows before it, flagged `_carry`.

    The ranking keeps n rows per group and is cut down before its shuffle. If a slice holds fewer
    than n rows the ones before it fill up, because the border rows of all slices are ordered
    together.
    """
    columns = df.columns
    toward = ordering(order, not reverse)
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy(*toward))
    ).where(F.col("_rank") <= n).drop("_rank")
    by_key = Window.partitionBy(*keys).orderBy(*ordering([SLICE, *order], reverse))
    before = F.collect_list(F.struct(*columns)).over(by_key.rowsBetween(-n, -1))
    new_slice = F.lag(SLICE).over(by_key)
    entering = ranked.withColumn("_before", before).withColumn("_last", new_slice).where(
        F.col("_last").isNull() | (F.col("_last") != F.col(SLICE))
    ).select(F.col(SLICE).alias("_into"), F.explode("_before").alias("_row"))
    copies = entering.select(
        *[F.col("_into").alias(SLICE) if c == SLICE else F.col("_row")[c].alias(c) for c in columns],
        F.lit(True).alias(CARRY),
    )
    return df.withColumn(CARRY, F.lit(False)).unionByName(copies)


def slice_prefix(summary: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Totals of all earlier slices for each (key, slice); `sums` maps total -> output name."""
    w = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(
        *keys, SLICE,
        *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(out) for c, out in sums.items()],
    )


def running_number(df: DataFrame, keys: list[str], order: list[str], out: str = "n") -> DataFrame:
    """Position of each row among the rows of its key (1, 2, ...); needs the slice column."""
    counts = df.groupBy(*keys, SLICE).agg(F.count("*").alias("_rows"))
    offsets = slice_prefix(counts, keys, {"_rows": "_offset"})
    w = Window.partitionBy(*keys, SLICE).orderBy(*ordering(order))
    return join_summary(df, offsets, [*keys, SLICE]).withColumn(
        out, F.row_number().over(w) + F.col("_offset")
    ).drop("_offset")


def running_last(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str]) -> DataFrame:
    """Latest non-null value so far (this row included) of each column: source -> output name.

    Needs the slice column. What earlier slices leave behind is one row per (key, slice).
    """
    newest = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_end_{out}")
        for c, out in columns.items()
    ]
    ends = df.groupBy(*keys, SLICE).agg(*newest)
    by_key = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    left = ends.select(
        *keys, SLICE,
        *[F.last(f"_end_{out}", ignorenulls=True).over(by_key).alias(f"_left_{out}")
          for out in columns.values()],
    )
    w = Window.partitionBy(*keys, SLICE).orderBy(*ordering(order)).rowsBetween(Window.unboundedPreceding, 0)
    joined = join_summary(df, left, [*keys, SLICE])
    return joined.select(
        *df.columns,
        *[F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_left_{out}")).alias(out)
          for c, out in columns.items()],
    )


def neighbour_keys(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add `_prev` and `_next`: the order columns (as a struct) of the key's row before and after.

    Needs the slice column. Rows at a slice border find theirs in a summary, one row per slice.
    """
    place = F.struct(*order)
    ends = df.groupBy(*keys, SLICE).agg(F.min(place).alias("_lo"), F.max(place).alias("_hi"))
    by_key = Window.partitionBy(*keys).orderBy(SLICE)
    around = ends.select(
        *keys, SLICE, F.lag("_hi").over(by_key).alias("_before"), F.lead("_lo").over(by_key).alias("_after")
    )
    w = Window.partitionBy(*keys, SLICE).orderBy(*ordering(order))
    return join_summary(df, around, [*keys, SLICE]).select(
        *df.columns,
        F.coalesce(F.lag(place).over(w), F.col("_before")).alias("_prev"),
        F.coalesce(F.lead(place).over(w), F.col("_after")).alias("_next"),
    )
