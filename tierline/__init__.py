"""tierline: bronze/silver/gold data pipelines on PySpark DataFrames, SQL and
Structured Streaming.

Layout:
  sources/    readers of the input tables, JSON landing folders and feeds
  functions/  column expressions shared by the jobs
  operators/  expectations, keyed upserts (SCD1/SCD2), sampling, deletes
  plans/      the datasets themselves (sales, fraud, sensors, seed, ingest)
  streaming/  append tables, incremental upsert flows, streaming checks
  tables.py   versioned publish / read of materialized datasets
"""

from tierline.session import build_session, work_root

__all__ = ["build_session", "work_root"]
