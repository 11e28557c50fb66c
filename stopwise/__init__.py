"""stopwise: public-transport position and timetable analytics on Spark.

Sub-packages:
  sources    - landing-folder snapshots, feed decoding, GTFS static tables, position streams
  functions  - column helpers (local time columns, keys, geodesics, hot-key-safe running scans)
  operators  - DataFrame -> DataFrame building blocks (ingest, trips, arrivals, merge, transforms)
  sinks      - NDJSON dump, lake table, JDBC table, latest-position table
  streaming  - Structured Streaming versions of the stateful operators
  plans      - the registered queries and their SQL oracles
"""

__version__ = "0.1.0"
