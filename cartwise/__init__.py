"""cartwise: abandoned-basket analytics expressed as Spark DataFrame plans.

Layout
------
- ``specs``      declared source tables (columns, key, target types)
- ``sources``    readers: delimited text, Parquet, catalogue, driver-table adapter
- ``functions``  column-level helpers (lenient coercion, export text formatting)
- ``operators``  reusable relational operators (one-row-per-key, insert-if-absent,
                 pair counting, top-k-per-group threshold, league points,
                 nearest qualifying ancestor, load metrics)
- ``plans``      the prepared tables, analytic views, reports and the job runner
- ``sinks``      CSV report writer and master/detail text export
- ``streaming``  micro-batch ingest with first-batch-wins semantics
"""

__all__ = ["specs", "session"]
