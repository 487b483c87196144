"""Metrics from the periodic status lines that streaming processes print."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.values import round_half_up, safe_ratio
from sensorloom.operators.sequence import DEFAULT_SLICE
from sensorloom.sources.staging import materialize
from sensorloom.operators.slices import SLICE, add_slice, join_summary, running_last, slice_prefix

# A line is read as fields: numbers with a label before them, and numbers with a unit after them.
_LABELLED = r"([a-z][a-z ]*)[:=]\s*(-?\d[\d,]*)(?![\d.]*%)"
_COUNTED = r"(\d[\d,]*)\s*(/?[a-z][a-z/]*)"
_BAR = r"\[stage\s.*"

# The families in matching order. A line is of the first whose word it holds and whose fields it has, and the
# family's numbers are those fields; a name that begins with a digit sign is a unit, the others are ends of labels.
FAMILIES = {
    "producer": ((), ("progress|status", "#events|#sent"), {
        "total": "progress|status", "rate": "#evt/s|#evts/s|#/s", "errors": "errors", "null_aqi": "null aqi"}),
    "priority_consumer": (("high_priority",), ("processed", "rate", "lag"), {"total": "processed", "rate": "rate", "lag": "lag"}),
    "standard_consumer": (("standard",), ("processed", "rate"), {"total": "processed", "rate": "rate", "lag": "total lag"}),
    "lag": (("lag: total=",), ("total",), {"lag": "total"}),
    "dlq_router": (("dlq router", "dlq status"), ("validated", "invalid"), {
        "total": "validated", "invalid": "invalid", "dlq_sent": "dlq sent"}),
    "dlq_report": (("collected", "sampled"), ("#dlq|#records",), {"total": "#dlq|#records"}),
    "enrichment": (("enrichment",), ("#processed", "enriched|joined", "unenriched|misses"), {
        "total": "#processed", "enriched": "enriched|joined", "unenriched": "unenriched|misses"}),
    "incident": (("incident_type", "aqi_emergency", "traffic_gridlock", "bus_bunching"), (), {}),
    # A progress bar has four numbers and no labels.
    "stage": (("[stage",), ("@4",), {"stage": "@1", "total": "@2", "rate": "@3", "tasks": "@4"}),
}

NUMBERS = ["total", "rate", "errors", "null_aqi", "lag", "invalid", "dlq_sent", "enriched",
           "unenriched", "stage", "tasks"]


def _named(name: str):
    return lambda label: (label == name) | label.endswith(f" {name}")


def _field(names: str) -> Column:
    """Text of the first field of these names, null if the line has none."""
    found = []
    for name in names.split("|"):
        if name.startswith("@"):
            found.append(F.get("_bar", F.lit(int(name[1:]) - 1)))
        elif name.startswith("#"):
            at = F.array_position("_units", F.lit(name[1:]))
            found.append(F.when(at > 0, F.get("_counts", (at - 1).cast("int"))))
        else:
            at = F.array_position(F.transform("_labels", _named(name)), True)
            found.append(F.when(at > 0, F.get("_values", (at - 1).cast("int"))))
    return F.coalesce(*found)


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add `family` and the numbers of the first family that a line belongs to; drop other lines."""
    fields = F.struct(
        F.lower(line).alias("_low"),
        F.transform(F.regexp_extract_all(F.lower(line), F.lit(_LABELLED), F.lit(1)), F.trim).alias("_labels"),
        F.regexp_extract_all(F.lower(line), F.lit(_LABELLED), F.lit(2)).alias("_values"),
        F.regexp_extract_all(F.lower(line), F.lit(_COUNTED), F.lit(1)).alias("_counts"),
        F.regexp_extract_all(F.lower(line), F.lit(_COUNTED), F.lit(2)).alias("_units"),
        F.regexp_extract_all(F.regexp_extract(F.lower(line), _BAR, 0), F.lit(r"(\d+)"), F.lit(1)).alias("_bar"))
    # One-element explodes: what is above them does not match a line's patterns again.
    read = lines.where(F.col(line).isNotNull()).select("*", F.explode(F.array(fields)).alias("_f")).select(*lines.columns, "_f.*")
    family = F.lit(None).cast("string")
    for name, (words, needed, _) in reversed(FAMILIES.items()):
        hit = F.lit(True)
        if words:
            hit = reduce(or_, [F.col("_low").contains(w) for w in words])
        for names in needed:
            hit = hit & _field(names).isNotNull()
        family = F.when(hit, F.lit(name)).otherwise(family)
    found = read.select("*", F.explode(F.array(family)).alias("family")).where(F.col("family").isNotNull())

    def value(number: str) -> Column:
        own = [F.when(F.col("family") == name, _field(fields[number])) for name, (_, _, fields) in FAMILIES.items() if number in fields]
        return F.replace(F.coalesce(*own), F.lit(","), F.lit("")).cast("bigint")

    out = found.select(*lines.columns, "family", *[value(n).alias(n) for n in NUMBERS])
    # Numbers a family always has, even when the line leaves them out; -1 is an unknown lag.
    for number, family in (("errors", "producer"), ("null_aqi", "producer"), ("lag", "standard_consumer"),
                           ("dlq_sent", "dlq_router")):
        out = out.withColumn(number, F.when(F.col("family") == family, F.coalesce(number, F.lit(0)))
                             .otherwise(F.col(number)))
    return out.withColumn("lag", F.when(F.col("lag").isNotNull(), F.greatest("lag", F.lit(0))))


def log_metrics(lines: DataFrame, key: str = "process", order: list[str] | None = None,
                ts: str = "ts", slice_width: str = DEFAULT_SLICE) -> DataFrame:
    """One metric row per status line, in the process's order.

    A lag line repeats the last known total and rate; an incident line counts one up from the last
    total. Both look back without bound, so they run over time slices.
    """
    order = order or [ts]
    # The patterns are the cost, and the numbers are read several times below.
    numbers = materialize(parse_lines(lines).select(key, *dict.fromkeys([ts, *order]), "family", *NUMBERS))
    parsed = add_slice(numbers, ts, slice_width).withColumn("_one", (F.col("family") == "incident").cast("bigint"))
    by_slice = parsed.groupBy(key, SLICE).agg(F.sum("_one").alias("_ones"))
    earlier = slice_prefix(by_slice, [key], {"_ones": "_before"})
    w = Window.partitionBy(key, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counted = join_summary(parsed, earlier, [key, SLICE]).withColumn(
        "_incidents", F.sum("_one").over(w) + F.col("_before")
    ).drop("_before")
    own = counted.withColumn("_base", F.col("total") - F.col("_incidents")).withColumn(
        "_rate", F.when(F.col("family") != "lag", F.coalesce("rate", F.lit(0)))
    )
    known = running_last(own, [key], order, {"_base": "_last_base", "_rate": "_last_rate"})
    # Without an own total so far, incidents count from zero.
    total = F.coalesce("total", F.coalesce("_last_base", F.lit(0)) + F.col("_incidents"))
    return known.select(
        key, *[c for c in order if c != key], "family",
        total.alias("total"), F.coalesce("_last_rate", F.lit(0)).alias("rate"),
        *[c for c in NUMBERS if c not in ("total", "rate")],
        F.when(F.col("family") == "dlq_router",
               round_half_up(safe_ratio(F.col("invalid") * 100.0, total), 1)).alias("invalid_percent"),
        F.when(F.col("family") == "stage",
               round_half_up(safe_ratio(total * 100.0, "tasks"), 0)).alias("stage_percent"),
    )
