"""changeflow — medallion change-data analytics as PySpark DataFrame operators.

Layers:
  sources/    table readers, derived change logs, file ingestion with rescue
  operators/  quality rules, SCD1/SCD2 apply, merge, snapshots, layout
  functions/  Column-returning helpers (PII masks, JSON paths)
  streaming/  Structured Streaming jobs (windows, dedup, fan-out)
  plans/      silver/gold/governance/monitoring compositions and the query registry
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
