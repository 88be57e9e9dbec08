"""Declarative ingestion, data quality and training-data preparation as Spark jobs."""
