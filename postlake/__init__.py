"""Ingest, curate, deduplicate, publish, page and report on streams of community posts with Spark."""
