"""snapmart: snapshot data marts on Spark.

Landed JSON feeds -> typed RAW tables (set-based upsert with row-by-row MERGE semantics) ->
staging models -> a star schema of one team dimension and two facts -> column checks.

Entry points: ``snapmart.plans.jobs`` (load_feed, build), ``snapmart.streaming.ingest``
(stream_upsert), ``snapmart.plans.sql_views`` (register_models) and ``python -m snapmart``.
"""
