"""encore — listening-history analytics on Spark.

Layers:
  sources/    raw export reader, landed-JSON parsers, test-table adapters, warehouse IO
  functions/  column expressions (normalisation, calendar, labels, exact rounding)
  operators/  clean, dense keys, star build, features, weather, checks, manifests
  plans/      the named queries, their registry and DuckDB oracle texts
  streaming/  incremental ingest of landed export files
"""

from encore.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
