"""Stockmap: medical-stock distribution analytics as lazy Spark DataFrame functions.

Sub-packages
  functions/  column expressions (haversine, dates, ids)
  plans/      physical-plan choices that Spark has no single operator for (nearest site)
  operators/  conform, validate, derive supply tables, coverage metrics, monitoring
  sources/    CSV / TSV / JSON-matrix readers, publish, manifest, lake reads
  streaming/  incremental file flows, keyed upsert, event payloads and batches
"""

__version__ = "0.1.0"
