"""freshcat: monthly "new arrivals" datasets from a versioned catalogue, on Spark.

Every operator is a plain function ``DataFrame -> DataFrame`` built from the public
DataFrame API, so Catalyst sees one declarative plan end to end (no UDFs).

Layout:

* ``sources``   scans (with empty fallback, typed CSV lookups) and sinks
  (partitioned CSV, named export, partition registration, read-back audit)
* ``functions`` column expressions: time zone shifts, month ranges, defaults,
  JSON schema of the album structure, calendars
* ``operators`` reusable frame operators: filters, snowflake joins, track explode,
  album rollup, first-per-key dedup, top-k, backfill month selection
* ``plans``     the composite jobs (album dimension, new-arrivals fact, corner job,
  all corners in one job) and their mapping onto the driver's star schema
* ``streaming`` incremental (available-now) runner for the corner job
"""

from freshcat.session import get_session

__all__ = ["get_session"]
