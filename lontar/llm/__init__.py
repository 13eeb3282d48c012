"""Operators of a training-data pipeline: deduplication, tokenisation, scoring, search and mixing."""
