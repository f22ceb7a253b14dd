"""Derived labels: weather categories, seasons, release year, period text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Temperature category upper bounds (exclusive, degrees C) and
# the label for anything at or above the last bound.
TEMP_BOUNDS = [(5.0, "cold"), (15.0, "cool"), (25.0, "warm")]
TEMP_TOP = "hot"
TEMP_UNKNOWN = "unknown"
# Rain threshold in mm (strictly greater means rainy).
RAIN_MM = 1.0
# Months of each (northern-hemisphere) season.
SEASON_MONTHS = [
    ("Winter", (12, 1, 2)),
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
]
SEASON_REST = "Autumn"


def temp_category(temp: Column, strict: bool = False) -> Column:
    """Label a daily mean temperature.

    A missing value reaches the comparison chain as NaN in the original
    pipeline and therefore falls through to the top label; ``strict=True``
    gives the evident intent instead (``unknown``).
    """
    expr = F.when(temp.isNull(), F.lit(TEMP_UNKNOWN if strict else TEMP_TOP))
    for bound, label in TEMP_BOUNDS:
        expr = expr.when(temp < bound, label)
    return expr.otherwise(TEMP_TOP)


def is_rainy(precipitation: Column) -> Column:
    return F.coalesce(precipitation > F.lit(RAIN_MM), F.lit(False))


def season(month: Column) -> Column:
    expr = None
    for name, months in SEASON_MONTHS:
        cond = month.isin(*months)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(SEASON_REST)


def release_year(release_date: Column) -> Column:
    """First four characters as an integer; NULL/empty/garbage gives NULL."""
    return F.substring(release_date, 1, 4).try_cast("int")


def period_label(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
