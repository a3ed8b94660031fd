"""Training-data operators: cleaning, deduplication, mixing, tokenizing."""
