"""Training-data operators: tokenising, deduplication, extraction, filters, search, packing."""
