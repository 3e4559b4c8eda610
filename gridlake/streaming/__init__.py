"""Incremental form of the ingestion job."""
