"""Training-data operators: deduplication, filtering, formatting and mixing of text corpora."""
