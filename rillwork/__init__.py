"""Streaming enrichment of keyed JSON messages, as PySpark DataFrame functions."""
