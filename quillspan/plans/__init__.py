"""Whole runs put together from operators, and the registered queries with their DuckDB equivalents."""
