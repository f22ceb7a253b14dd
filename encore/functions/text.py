"""String normalisation used by the clean step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace).
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")

# Platform string (lower-cased, stripped) -> platform group.
# Anything else, including the "unknown" placeholder, maps to "other".
PLATFORM_GROUPS = {
    "android": "mobile",
    "ios": "mobile",
    "web_player": "web",
    "desktop": "desktop",
    "partner": "other",
}
PLATFORM_DEFAULT = "other"
MISSING_TEXT = "unknown"


def strip(col: Column) -> Column:
    """Both-ends trim of every character in ``WHITESPACE`` (no regex)."""
    return F.btrim(col, F.lit(WHITESPACE))


def normalise_country(col: Column) -> Column:
    return strip(F.upper(F.coalesce(col, F.lit(MISSING_TEXT))))


def normalise_platform(col: Column) -> Column:
    return strip(F.lower(F.coalesce(col, F.lit(MISSING_TEXT))))


def platform_group(platform: Column) -> Column:
    expr = None
    for key, group in PLATFORM_GROUPS.items():
        expr = (F.when(platform == key, group) if expr is None
                else expr.when(platform == key, group))
    return expr.otherwise(PLATFORM_DEFAULT)


def last_uri_segment(uri: Column) -> Column:
    """``a:b:c`` -> ``c``; NULL stays NULL."""
    return F.element_at(F.split(uri, ":"), -1)
