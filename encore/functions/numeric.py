"""Exact, engine-independent numeric expressions.

Three rounding rules appear in the workload:

* SQL ``ROUND(x, k)`` on a double: half away from zero on ``x * 10^k``.
  ``sql_round`` writes it as ``round(x * 10^k, 0) / 10^k`` so the scaled value
  is formed by one IEEE multiply, as the SQL engine does.
* pandas / numpy ``.round(k)``: ``rint(x * 10^k) / 10^k`` (half to even on
  the scaled binary value). ``half_even`` writes exactly that.
* Python ``round(x, k)``: by the exact binary value, ``decimal_round``.

Sums of 2-decimal measures are taken as decimals (exact, so independent of
partitioning and summation order) and turned into a double only at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTES_DECIMAL = "decimal(18,2)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sql_round(col, k: int) -> Column:
    scale = float(10 ** k)
    return F.round(_c(col) * F.lit(scale), 0) / F.lit(scale)


def half_even(col, k: int) -> Column:
    scale = float(10 ** k)
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale)


def decimal_round(col, k: int) -> Column:
    """Rounds a double by its exact binary value, halves to even (Python's ``round``).

    Whether ``x`` lies over or under the middle ``odd / (2 * 10^k)`` of its two
    candidates shows in the sign of ``x * 2 * 10^k - odd``. Multiplied in one step
    the product would be rounded; the leading 24 bits of ``x`` (its value as a
    float) and the rest are multiplied apart, and both products are exact.
    """
    x, scale = _c(col), F.lit(float(10 ** k))
    low = F.floor(x * scale).cast("double")
    odd = low * F.lit(2.0) + F.lit(1.0)
    head = x.cast("float").cast("double")
    over = (head * scale * F.lit(2.0) - odd) + (x - head) * scale * F.lit(2.0)
    up = F.when(over == 0.0, F.abs(low % F.lit(2.0))).when(over > 0.0, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(x.isNotNull(), (low + up) / scale)


def exact_sum(col) -> Column:
    """Decimal sum of a measure with at most two decimals (partial-aggregates)."""
    return F.sum(_c(col).cast(MINUTES_DECIMAL))


def exact_mean(col) -> Column:
    """``AVG`` of a 2-decimal measure: decimal sum over non-null count, as double."""
    return exact_sum(col).cast("double") / F.count(_c(col)).cast("double")


def mean_half_even(values, k_in: int, k_out: int) -> Column:
    """Mean of values carrying ``k_in`` decimals, rounded half-even to ``k_out``.

    Computed on integers (units of 10^-k_in), so the result does not depend on
    the order in which a distributed aggregation adds the values. Requires
    ``k_out >= k_in``.
    """
    units = F.sum(F.round(_c(values) * F.lit(float(10 ** k_in)), 0).cast("long"))
    n = F.count(_c(values)).cast("long")
    num = units * F.lit(10 ** (k_out - k_in))
    rem = ((num % n) + n) % n
    quo = (num - rem) / n  # exact: num - rem is a multiple of n
    twice = rem * F.lit(2)
    rounded = (F.when(twice > n, quo + 1)
                .when((twice == n) & (F.abs(quo) % 2 == 1), quo + 1)
                .otherwise(quo))
    return F.when(n > 0, rounded / F.lit(float(10 ** k_out)))
