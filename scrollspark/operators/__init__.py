"""Operators over the corpus tables: schema, store, ingest, status, profile, OCR work, scoring, search."""
