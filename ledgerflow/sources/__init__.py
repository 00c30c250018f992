"""Schemas, text ingest, layered tables and atomic publication."""
