"""Incremental versions of ingestion, duplicate removal and running counts."""
