"""Operators over passages, claims and relations; every table carries ``document_id`` and an explicit order column."""
