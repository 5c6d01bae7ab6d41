"""Sources of the ingestion engine."""
