"""Training-data operators: deduplication, filtering, scoring, mixing and sharding of document tables."""
