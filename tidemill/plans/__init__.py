"""Plans of the ingestion engine."""
