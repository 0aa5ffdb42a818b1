"""Readers: plain texts, request bodies, tables of documents, corpus batches; run configuration."""
