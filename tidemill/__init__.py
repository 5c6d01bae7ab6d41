"""A PySpark-native, config-driven ingestion and analytics engine."""
