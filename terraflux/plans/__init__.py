"""Registered queries, the tables derived for them, and their DuckDB equivalents."""
