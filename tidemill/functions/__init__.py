"""Functions of the ingestion engine."""
