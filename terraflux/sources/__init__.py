"""Catalog, ingest, stage tables and exports."""
