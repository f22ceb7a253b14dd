"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from encore.functions import calendar, labels, numeric, text

__all__ = ["calendar", "labels", "numeric", "text"]
