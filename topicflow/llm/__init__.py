"""Training-data operators: scoring, filtering, deduplication, mixing and token files."""
