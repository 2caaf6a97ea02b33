"""tarmac — flight-delay analytics as Spark DataFrame, ML and Structured Streaming jobs.

Layout:
  functions/  column expressions (dates, features, tiers, JSON/URI helpers)
  sources/    readers and sinks (test tables, flights view, CSV landing, registry, model store)
  operators/  DataFrame operators (encoding, quality, profile, split, metrics, registry, scoring, drift)
  plans/      the batch jobs and the query catalog used by ``__spark_entry__``
  streaming/  Structured Streaming variants (landing directory, scoring capture, daily monitor)
"""

__version__ = "0.1.0"
