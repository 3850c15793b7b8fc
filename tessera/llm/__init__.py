"""Training-data operators: decontamination, near-duplicates, mixing, shards, extraction, scoring."""
