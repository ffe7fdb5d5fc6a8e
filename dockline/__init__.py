"""dockline: bike-share availability analytics as Spark DataFrame / SQL /
Structured Streaming / Spark ML jobs.

Sub-packages
------------
functions   column-expression builders (schemas, quality rules, geo, time)
sources     driver tables, derived domain views, message/bronze sources & sinks
operators   parse, merge (upserts), alerts, analytics, recommender, demand models
plans       the query registry (``queries()``) and DuckDB oracle SQL
streaming   the foreachBatch ingest pipeline (availableNow, idempotent epochs)
"""

__all__ = ["settings", "session"]
