"""Calendar columns of a play and the fixed orderings used by reports.

``played_at`` is kept as TIMESTAMP_NTZ holding UTC wall-clock time, so every
derived column is independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

# Weekday names Monday..Sunday and season names in calendar order.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
SEASONS = ["Winter", "Spring", "Summer", "Autumn"]


def utc_wall_clock(col: Column, dtype) -> Column:
    """A raw timestamp of any supported type as UTC wall-clock TIMESTAMP_NTZ."""
    if isinstance(dtype, TimestampNTZType):
        return col
    if isinstance(dtype, TimestampType):
        return _instant_in_utc(col)
    text = F.trim(col if isinstance(dtype, StringType) else col.cast("string"))
    # seconds without a zone, or with Z: the wall clock as it stands
    n = F.length(text)
    plain = (F.substring(text, 17, 1) == ":") & ((n == 19) | ((n == 20) & text.endswith("Z")))
    as_is = F.when(plain, F.substring(text, 1, 19).try_cast("timestamp_ntz"))
    # text without a zone is UTC; with one it names an instant whatever the session's zone
    zoned = text.rlike(r"(?i)([0-9:.]\s*(Z|UTC|GMT)|[Tt ][0-9:.]+\s*[+-][0-9]{1,2}(:?[0-9]{2})?)$")
    parsed = F.try_to_timestamp(F.when(zoned, text).when(text.contains(":"), F.concat(text, F.lit("Z")))
                                .otherwise(F.concat(text, F.lit(" 00:00:00Z"))))
    unread = F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("timestamp")
    return F.coalesce(as_is, _instant_in_utc(F.coalesce(parsed, F.when(text.isNotNull(), unread))))


def _instant_in_utc(ts: Column) -> Column:
    """The UTC wall clock of an instant, by its microseconds: a way through local
    time would merge instants where clocks are set back."""
    seconds = (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(zero, zero, zero, seconds)


def calendar_columns(ts: Column) -> dict[str, Column]:
    return {
        "date": F.to_date(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "month_name": F.date_format(ts, "MMM"),
        "week": F.weekofyear(ts),
        "day_of_week": F.date_format(ts, "EEEE"),
        "hour": F.hour(ts),
        "is_weekend": F.weekday(ts) >= 5,
    }


def rank_of(col: Column, values: list[str]) -> Column:
    """1-based position of ``col`` in a fixed list (0 when absent)."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), col)
