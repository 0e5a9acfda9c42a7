"""Spark-first engine for building and analysing a corpus of scientific papers."""
