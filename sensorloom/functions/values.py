"""Small scalar expressions on numbers and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NULL_LIKE = ["", "nan", "none", "null"]


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def round_half_up(column, places: int) -> Column:
    """Round half away from zero.

    The inner rounding removes the last digits of a double sum, which depend on the order in
    which partial sums met, so a tie rounds the same way however the data was partitioned.
    """
    return F.round(F.round(_c(column), 9), places)


def safe_ratio(numerator, denominator) -> Column:
    """numerator / max(1, denominator)."""
    return _c(numerator) / F.greatest(F.lit(1), _c(denominator))


def clamp(column, low=None, high=None) -> Column:
    out = _c(column)
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return out


def pair_key(a, b, separator: str = "|") -> Column:
    """One key for an unordered pair."""
    return F.concat_ws(separator, F.least(_c(a), _c(b)), F.greatest(_c(a), _c(b)))


def split_pair(column, separator: str = "|") -> Column:
    return F.split(_c(column), f"\\Q{separator}\\E", 2)


def first_non_empty(*columns) -> Column:
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in columns])


def null_like_to(column, default: str) -> Column:
    """Replace null and the texts that stand for it by `default`."""
    c = _c(column)
    return F.when(F.coalesce(F.lower(c), F.lit("")).isin(NULL_LIKE), F.lit(default)).otherwise(c)


def preview(column, limit: int, mark: str = "...") -> Column:
    c = _c(column)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(mark))).otherwise(c)


def percent_bar(percent, per_block: int = 2, block: str = "█") -> Column:
    return F.repeat(F.lit(block), F.floor(_c(percent) / per_block).cast("int"))


def advisory_level(aqi) -> Column:
    """Severity band of a mean index that already exceeded the advisory threshold."""
    c = _c(aqi)
    return (
        F.when(c > 300, F.lit("HAZARDOUS"))
        .when(c > 200, F.lit("VERY_UNHEALTHY"))
        .otherwise(F.lit("UNHEALTHY"))
    )
