"""Training-data operators: filters, near-duplicates, tokens, archives, packing."""
