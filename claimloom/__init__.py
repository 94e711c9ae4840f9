"""Claims analytics on Spark: incremental loads, curation, series, documents, triage models."""

__version__ = "0.1.0"
