"""courtline: box-score analytics and point-in-time features as Spark DataFrame plans.

Layout
------
functions/  column expressions (safe casts, season labels, scoring, array slopes)
sources/    readers for parquet / csv / json documents, date spines, the driver-table adapter
operators/  ETL, quality reports, as-of and range joins, upserts, partitioned sinks
plans/      point-in-time features, analytical reads, exports, the registered query catalog
streaming/  Structured Streaming landing, dedup, upsert and rest-day maintenance
"""

__version__ = "0.1.0"
