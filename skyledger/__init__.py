"""Observation ingest, enrichment and reporting expressed as Spark DataFrame jobs."""
