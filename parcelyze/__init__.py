"""parcelyze: order-fulfilment operations analytics as Spark DataFrame jobs.

Layers
------
sources    raw tables (CSV ingest with explicit schemas, test-data adapter)
functions  shared column expressions (SLA rules, guarded ratios, formatting)
operators  star schema, analytics, data quality, statistics, forecast, findings, reports
plans      query registry, DuckDB oracle SQL, the batch pipeline job
llm        optional: operators for language-model corpora (nothing else imports it)
"""

__all__ = ["session"]
