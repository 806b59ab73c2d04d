"""Training-data operators: tokens, neighbours, extraction, quality, packing, toxicity, near-duplicates, archives, secrets."""
