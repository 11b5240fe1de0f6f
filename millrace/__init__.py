"""Ingestion, change-data-capture, streaming and event-log analytics on PySpark."""

__version__ = "0.1.0"
