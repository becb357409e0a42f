"""Training-data operators: tokenising, filters, near-duplicates, packing, sharding, search."""
