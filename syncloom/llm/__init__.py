"""Operators for large text corpora; nothing outside this package and ``corpus_pipeline.py`` imports it."""
