"""Training-data operators: near-duplicate removal, packing, search, formatting, scoring and tokenising."""
