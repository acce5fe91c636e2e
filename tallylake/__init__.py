"""Transaction analytics on Spark: ingestion, rollups and reports."""
