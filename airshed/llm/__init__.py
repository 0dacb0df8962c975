"""Training-data operators: near-dedup, decontamination, tokenization and filters."""
