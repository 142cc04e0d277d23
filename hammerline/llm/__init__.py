"""Training-data operators: deduplication, quality, privacy, tokens, packing and sharding of documents."""
