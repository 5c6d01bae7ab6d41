"""Operators of the ingestion engine."""
