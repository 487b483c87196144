"""Register of the ready-made queries: name, Spark query, and check SQL where there is one."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.session import prepare


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    check: str | None


QUERIES: dict[str, Query] = {}


def zoneless(df: DataFrame) -> DataFrame:
    """Top-level TIMESTAMP columns as TIMESTAMP_NTZ, the form an ANSI engine returns."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def query(name: str, check: str | None = None):
    if check is not None:
        # A reserved word in the check engine.
        check = re.sub(r"\boffset\b", '"offset"', check)

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zoneless(build(prepare(spark), sf_dir))

        run.__doc__ = build.__doc__
        run.__name__ = name
        QUERIES[name] = Query(run, check)
        return build

    return register


def rounded(expression: str, places: int) -> str:
    """Check-SQL text of `round_half_up`."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 9)), {places}) AS DOUBLE)"
