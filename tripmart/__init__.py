"""tripmart: trip-record ETL and analytics expressed as Spark DataFrame plans.

Layout:
  sources/    scans: month files, the driver-table trip view, contracts, fingerprints, dimensions
  operators/  row rules, unit conversion, outlier bounds, fact build, mart, metrics, explorer
  functions/  reusable Column expressions (units, percent delta, redaction, filters)
  plans/      end-to-end plans: the monthly publish job, dashboard read models, the query registry
  streaming/  Structured Streaming path with the same row rules and sliding-window aggregates
"""

__all__ = ["session"]
