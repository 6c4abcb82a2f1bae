"""farebox — a Spark-native lakehouse for trip-style event data.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark's own expressions, so Catalyst sees one declarative plan end to end:
filters reach the Parquet scan, aggregations run partial + final, and joins
are planned (and re-planned by AQE) from their keys.

Layout
------
``functions``   column-expression helpers (no actions)
``sources``     driver-table adapter, drifting monthly landing files, layer scans
``operators``   cleaning, aggregates, data quality, upsert / change sets, snapshots
``sinks``       partitioned writes and catalog registration
``plans``       layer jobs and the registered queries
``streaming``   file-arrival ingestion with Structured Streaming
"""

from farebox.config import TripColumns, DateWindow

__all__ = ["TripColumns", "DateWindow"]
__version__ = "0.1.0"
