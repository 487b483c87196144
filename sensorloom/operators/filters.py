"""Row predicates and row-level clean-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.values import advisory_level, null_like_to


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def all_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows in which every listed column has a value; zero and empty text are values."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def above(column: str, threshold: float) -> Column:
    """Strictly above; a value equal to the threshold is no breach."""
    return F.col(column) > F.lit(threshold)


def classify(df: DataFrame, column: str, out: str = "advisory_level") -> DataFrame:
    return df.withColumn(out, advisory_level(column))


def default_layer(df: DataFrame, column: str = "source_layer", default: str = "SPEED") -> DataFrame:
    return df.withColumn(column, null_like_to(column, default))


def topic_catalog(df: DataFrame, topic: str = "topic", prefix: str | None = None,
                  internal_prefix: str = "__") -> DataFrame:
    """Distinct topic names in order, without the broker's internal ones."""
    names = df.select(topic).where(~F.startswith(F.col(topic), F.lit(internal_prefix))).distinct()
    flagged = names.withColumn(
        "selected",
        F.startswith(F.col(topic), F.lit(prefix)) if prefix else F.lit(True),
    )
    return flagged.orderBy(topic)
