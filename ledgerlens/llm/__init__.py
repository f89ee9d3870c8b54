"""Training-data operators: scoring, deduplication, packing, filtering, search, mixing, tagging and token files."""
