"""Layered table and stream operators for Spark: ingest, merge, history, quality, analytics."""
